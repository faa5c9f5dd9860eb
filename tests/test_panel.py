import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import bootstrap, contrast, coverage, dims, index, levels
from plumbline.operators import panel as P

GOLDEN = [("A", "x", 1, 10.0), ("B", "x", 1, 20.0), ("A", "x", 2, 12.0), ("B", "x", 2, 20.0), ("C", "x", 2, 30.0), ("B", "x", 3, 25.0), ("C", "x", 3, 30.0)]


def cells_of(spark, rows):
    df = spark.createDataFrame(rows, "outlet string, item string, ord int, price double").withColumn("price", F.col("price").cast("decimal(10,2)"))
    return P.cells(P.PanelSpec().of(df))


def random_rows(seed, outlets=8, items=3, periods=7):
    rng = random.Random(seed)
    return [(f"o{o}", f"i{i}", t, round(rng.uniform(5, 50), 2)) for o in range(outlets) for i in range(items) for t in range(periods) if rng.random() < 0.7]


def test_golden_index(spark):
    cells = cells_of(spark, GOLDEN)
    links = P.links(cells)
    assert links.count() == 4
    rows = {r.ord: r["index"] for r in index.chained_index(links, cells, cells.select("ord").distinct(), [], 1, 1).collect()}
    assert rows[1] == 100 and rows[3] == pytest.approx(100 * math.sqrt(1.5))
    assert index.chained_change(links, [], 1, 1).first().change == pytest.approx(math.sqrt(1.5) - 1)
    assert index.chained_change(links, [], 30, 10).first().change is None


@pytest.mark.parametrize("seed", [1, 2])
def test_links_equal_self_join(spark, seed):
    cells = cells_of(spark, random_rows(seed))
    key = lambda df: sorted((r.outlet, r.item, r.ord, round(r.log_rel, 12)) for r in df.collect())
    assert key(P.links(cells)) == key(P.links_by_join(cells))


def test_batch_links_cover_successors(spark):
    cells = cells_of(spark, random_rows(3))
    every = {(r.outlet, r.item, r.ord) for r in P.links(cells).collect()}
    assert {(r.outlet, r.item, r.ord) for r in P.links_of_batch(cells, [3]).collect()} == {x for x in every if x[2] in (3, 4)}
    assert {x.ord for x in P.links_of_batch(cells, [3], with_successors=False).collect()} == {3}


def test_constant_panel_stays_at_100_and_carries_flat(spark):
    rows = [(o, "x", t, 7.0) for o in "abc" for t in (1, 2, 4)]
    cells = cells_of(spark, rows)
    calendar = spark.range(1, 5).select(F.col("id").cast("int").alias("ord"))
    got = [r["index"] for r in index.chained_index(P.links(cells), cells, calendar, [], 1, 1).orderBy("ord").collect()]
    assert got == [100, 100, 100, 100]


def test_group_without_a_price_at_base_is_blank_there(spark):
    cells = cells_of(spark, [("a", "x", 1, 5.0), ("a", "x", 2, 6.0), ("b", "y", 2, 6.0), ("b", "y", 3, 6.0)])
    got = {(r.item, r.ord): r["index"] for r in index.chained_index(P.links(cells), cells, cells.select("ord").distinct(), ["item"], 1, 1).collect()}
    assert got["y", 1] is None and got["x", 1] == 100 and got["y", 3] == 100 and got["x", 3] == pytest.approx(120)


def test_time_reversal_negates(spark):
    rows = random_rows(4)
    forward = {(r.outlet, r.item, r.ord): r.log_rel for r in P.links(cells_of(spark, rows)).collect()}
    back = {(r.outlet, r.item, -r.ord + 1): r.log_rel for r in P.links(cells_of(spark, [(o, i, -t, p) for o, i, t, p in rows])).collect()}
    assert forward.keys() == back.keys()
    assert all(forward[k] == pytest.approx(-back[k]) for k in forward)


def test_bootstrap_doesnt_depend_on_partitions(spark):
    links = P.links(cells_of(spark, random_rows(5)))
    get = lambda: {(r.item, r.ord): (round(r.low, 9), round(r.high, 9), r.replicas) for r in bootstrap.interval(links, 20).collect()}
    one = get()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    two = get()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert one == two and one


def plain_mix(x):
    s = (x * 747796405 + 2891336453) % 2**32
    w = (((s >> ((s >> 28) + 4)) ^ s) * 277803737) % 2**32
    return (w >> 22) ^ w


def plain_draws(stream, n, replica):
    a = plain_mix((stream + replica) % 2**32)
    return [plain_mix(a ^ plain_mix((d + 0x9E3779B9) % 2**32)) * n >> 32 for d in range(n)]


def test_draws_equal_plain_version(monkeypatch):
    for draws in (1 << 20, 7):
        monkeypatch.setattr(bootstrap, "DRAWS", draws)
        counts = bootstrap.draw_counts(4294967290, 23, 3, 11)
        assert (counts.sum(1) == 23).all()
        assert counts.tolist() == [[plain_draws(4294967290, 23, r).count(o) for o in range(23)] for r in range(3, 11)]


def test_replicas_spread_over_tasks_whatever_their_bytes(spark, monkeypatch):
    """Few bytes stand for many draws: Spark must not merge the slices into one task. Smaller slices give the same interval."""
    links = spark.createDataFrame([(f"o{o}", item, t, o / 9 + t) for item in "abc" for o in range(9) for t in (1, 2)], "outlet string, item string, ord int, log_rel double")
    sums = bootstrap._summed(links, bootstrap.REPLICAS, bootstrap.SEED)[0]
    assert sums.select(F.spark_partition_id()).distinct().count() > 2
    get = lambda: sorted((r.item, r.ord, round(r.low, 9), round(r.high, 9), round(r.error, 9), r.replicas) for r in bootstrap.interval(links, 300).collect())
    whole = get()
    monkeypatch.setattr(bootstrap, "COUNTS", 9 * 70)
    assert get() == whole and len(whole) == 6


def test_interval_equals_plain_version_over_blocks(spark):
    """More outlets than a block has, more replicas than a slice, a null relative and a null item."""
    rng = random.Random(9)
    rows = [(f"o{o:05}", "big", t, rng.gauss(0, 1)) for o in range(bootstrap.OUTLETS + 500) for t in (2, 5) if rng.random() < 0.8]
    rows += [("o1", "small", 3, 0.5), ("o2", "small", 3, None), ("o2", "small", 4, 0.25), ("o1", None, 3, 0.5)]
    links = spark.createDataFrame(rows, "outlet string, item string, ord int, log_rel double")
    replicas = bootstrap.SLICE + 40
    got = {(r.item, r.ord): r for r in bootstrap.interval(links, replicas, log=True).collect()}
    stream = {r["item"]: r.h for r in links.filter("item is not null").select("item", bootstrap.hashed(F.lit(bootstrap.SEED), F.col("item")).alias("h")).distinct().collect()}
    assert {k for k, _ in got} == {"big", "small"}
    for item in ("big", "small"):
        roster = sorted({o for o, i, *_ in rows if i == item})
        values = {}
        for r in range(replicas):
            drawn, level = [0] * len(roster), 0.0
            for place in plain_draws(stream[item], len(roster), r):
                drawn[place] += 1
            weight = dict(zip(roster, drawn, strict=True))
            for t in sorted({t for _, i, t, _ in rows if i == item}):
                own = [(weight[o], x) for o, i, u, x in rows if i == item and u == t and x is not None]
                if n := sum(w for w, _ in own):
                    level += sum(w * x for w, x in own) / n
                    values.setdefault(t, []).append(level)
        for t, v in values.items():
            v.sort()
            at = lambda p: v[int(p * (len(v) - 1))] + (p * (len(v) - 1) % 1) * (v[min(len(v) - 1, int(p * (len(v) - 1)) + 1)] - v[int(p * (len(v) - 1))])  # noqa: B023, E731
            x = got[item, t]
            assert (x.replicas, x.low, x.high) == (len(v), pytest.approx(at(0.025)), pytest.approx(at(0.975)))
    unfolded = bootstrap.replicas_of(links, 5).groupBy("item", "ord").count().collect()
    assert {(r.item, r.ord): r["count"] for r in unfolded if r.item == "big"} == {("big", 2): 5, ("big", 5): 5}
    assert bootstrap.interval(links.limit(0), 5).count() == 0


def test_interval_read_out(spark):
    ci = spark.createDataFrame([("x", 1, 100.0, 100.0), ("x", 2, 101.0, 103.5), ("y", 1, 90.0, 95.0)], "item string, ord int, low double, high double")
    publish = spark.createDataFrame([("x", True), ("y", False)], "item string, publish boolean")
    got = {r.item: r.text for r in bootstrap.read_out(ci, publish).collect()}
    assert got == {"x": "+1.00% a +3.50%", "y": None}
    assert all(r.low is None for r in bootstrap.read_out(ci, publish, outlets_filtered=True).collect())


def test_inflation_is_blank_not_minus_one(spark):
    calendar = spark.createDataFrame([(1, 100.0), (2, None), (3, 110.0)], "ord int, deflator double")
    assert [r.inflation for r in index.inflation(calendar).orderBy("ord").collect()] == [0, None, pytest.approx(0.1)]


def test_histogram_zero_inside_null_outside(spark):
    cells = cells_of(spark, [("a", "x", 1, 6.0), ("b", "x", 1, 6.4), ("c", "x", 1, 8.0), ("d", "x", 1, 8.5)])
    got = [r.cells for r in levels.histogram(cells, 5, 11).orderBy("bin").collect()]
    assert got == [None, 2, 0, 1, 1, None, None]


def test_open_close_needs_both_ends(spark):
    cells = cells_of(spark, [("a", "x", 1, 6.0), ("a", "x", 2, 8.0), ("b", "y", 2, 9.0)])
    assert [(r.item, r.opening, r.closing, r.outlets) for r in levels.open_close(cells, ["item"], 1).collect()] == [("x", 6, 8, 1)]


def test_coverage_counts_municipalities_with_their_state(spark):
    schema = "ord int, outlet string, chain string, state string, municipality string"
    cells = spark.createDataFrame([(1, "a", "c", "s1", "m"), (1, "b", "c", "s2", "m"), (2, "a", "c", "s1", "m"), (2, "b", "c", "s2", "m")], schema)
    links = cells.filter("ord = 2 and outlet = 'a'")
    got = {r.level: (r.observed, r.matched, r.coverage) for r in coverage.coverage(links, cells).collect()}
    assert got == {"outlet": (2, 1, 0.5), "chain": (1, 1, 1.0), "municipality": (2, 1, 0.5), "state": (2, 1, 0.5)}


def test_validity_closes_globally_and_valid_at(spark):
    rows = spark.createDataFrame([("a", "2020-01-01", 1), ("b", "2020-01-01", 2), ("a", "2021-01-01", 3)], "zone string, f string, wage int").withColumn("valid_from", F.to_date("f")).drop("f")
    dim = dims.versioned(rows, {"b": "general"})
    got = {(r.zone, str(r.valid_from)): (str(r.valid_to), r.is_current, r.zone_literal) for r in dim.collect()}
    assert got["general", "2020-01-01"] == ("2020-12-31", False, "b") and got["a", "2021-01-01"][0] == "9999-12-31"
    ask = spark.createDataFrame([("a", "2020-06-01"), ("a", "2022-06-01"), ("general", "2022-01-01")], "zone string, d string").withColumn("d", F.to_date("d"))
    assert sorted((r.zone, str(r.d), r.wage) for r in dims.valid_at(ask, dim, "zone", "d").select(ask["zone"], "d", "wage").collect()) == [("a", "2020-06-01", 1), ("a", "2022-06-01", 3), ("general", "2022-01-01", None)]


def test_dimensions(spark):
    rows = spark.createDataFrame([("Pack of 6 buns (188 g)", "m", "p"), ("Loaf 280.5 g", "m", "q"), ("Loaf 280.5 g", "m", "q")], "text string, brand string, product string")
    got = {r.text: (r.pieces, float(r.grams), r.product) for r in dims.items(rows, ["text", "brand"], ["product"], "text").collect()}
    assert got == {"Pack of 6 buns (188 g)": (6, 188.0, "p"), "Loaf 280.5 g": (1, 280.5, "q")}
    wages = spark.createDataFrame([("2024", "1", "258.8", "193.78", "225.93")], "year string, month string, nominal string, real string, index string")
    assert str(dims.monthly_wages(wages).first().month_start) == "2024-01-01"
    cpi = spark.createDataFrame([("2026/08/02", "145.53100000")], "period string, value string")
    assert dims.half_monthly_cpi(cpi).first().label == "2026-08_q2"


def test_index_without_a_price_at_the_base_and_a_zero_price(spark):
    from plumbline.operators import index as I
    from plumbline.operators import panel as P

    rows = [("s", "p", o, float(price)) for o, price in ((2, 10), (3, 20), (4, 0), (5, 5))]
    cells = spark.createDataFrame(rows, "outlet string, item string, ord int, price double")
    links = P.links(cells)
    assert {r.ord: r.log_rel is None for r in links.select("ord", "log_rel").collect()}.get(5, True)
    calendar = spark.createDataFrame([(i,) for i in (1, 2, 3)], "ord int")
    got = {r.ord: r["index"] for r in I.chained_index(links.filter("ord < 4"), cells.filter("ord < 4"), calendar, [], threshold=1, floor=1).collect()}
    assert set(got) == {1, 2, 3} and got[1] is None and abs(got[3] - 200) < 1e-9


def test_contrast_equals_plain_version_from_one_join(spark):
    """Gaps, an outlet without every period, a null price, null keys; the panel meets itself without a join."""
    rows = [("a", "x", 1, 10.0), ("a", "x", 2, 11.0), ("a", "x", 3, 12.0), ("a", "y", 1, 5.0), ("a", "y", 3, 7.0), ("b", "x", 2, 4.0), ("b", "x", 3, 6.0), ("b", "y", 2, None), ("b", "y", 3, 9.0), (None, "x", 1, 2.0), (None, "x", 2, 3.0), ("c", None, 1, 8.0), ("c", None, 3, 10.0)]
    cells = spark.createDataFrame(rows, "outlet string, item string, ord int, price double")
    made = contrast.contrast(cells, None)
    assert "SortMergeJoin" not in (plan := made._jdf.queryExecution().executedPlan().toString()) and plan.count("Window ") <= 2
    got = {r.estimator: r.change for r in made.collect()}
    known = {r[:3]: r[3] for r in rows}
    pairs = [(t, p, known[o, i, t - 1]) for o, i, t, p in rows if None not in (o, i) and (o, i, t - 1) in known]
    mean = lambda x: sum(x) / len(x)
    dutot = [sum(p for u, p, _ in pairs if u == t and p is not None) / sum(z for u, _, z in pairs if u == t and z is not None) for t in (2, 3)]
    carli = [mean([p / z for u, p, z in pairs if u == t and p is not None and z is not None]) for t in (2, 3)]
    ends = [(known[o, i, 1], p) for o, i, t, p in rows if t == 3 and known.get((o, i, 1))]
    at = lambda t, own: mean([p for o, _, u, p in rows if u == t and o in own])
    expected = {
        "simple mean": at(3, ("a", "b", "c", None)) / at(1, ("a", "b", "c", None)) - 1, "balanced panel": at(3, ("a",)) / at(1, ("a",)) - 1,
        "endpoints": math.exp(mean([math.log(b / a) for a, b in ends])) - 1, "chained Dutot": math.prod(dutot) - 1, "chained Carli": math.prod(carli) - 1,
    }
    assert got == pytest.approx(expected)
    assert {r.estimator: r.change for r in contrast.contrast(cells.limit(0), None).collect()} == dict.fromkeys(expected)
