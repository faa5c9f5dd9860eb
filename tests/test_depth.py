"""Cuts from one scan, selection, state, as-of join, files by ranges, buckets and replays, each against a plain version."""

import hashlib
import json
import random
import zlib

import pytest
from pyspark.sql import functions as F

from test_panel import cells_of, random_rows

from plumbline.functions import text
from plumbline.operators import asof, cuts, index, kept_index, levels, selection
from plumbline.operators import panel as P
from plumbline.sources import files, landing, sinks
from plumbline.streaming.landing import land_batch, stream_landing

ATTRIBUTES = [(f"o{i}", f"c{i % 3}", None if i % 4 == 3 else f"s{i % 2}") for i in range(8)]


def attributed(spark, rows):
    outlets = spark.createDataFrame(ATTRIBUTES, "outlet string, chain string, state string")
    cells = cells_of(spark, rows)
    return P.star(P.links(cells), outlets, "outlet"), P.star(cells, outlets, "outlet"), outlets


def test_cuts_equal_single_indices(spark):
    links, cells, outlets = attributed(spark, random_rows(11))
    made = cuts.chained_indices(links, cells, cuts.dense(outlets, ["outlet"], "number"), ["item", "chain", "state"], 2, 1)
    got = {(r.cut, r["value"], r.ord): (r.matched, r["index"] and round(r["index"], 9)) for r in made.collect()}
    for cut, by in (("item", ["item"]), ("chain", ["chain"]), ("state", ["state"]), ("total", [])):
        for r in index.chained_index(links, cells, cells.select("ord").distinct(), by, 2, 1).collect():
            assert got.pop((cut, r[by[0]] if by else None, r.ord)) == (r.matched, r["index"] and round(r["index"], 9))
    assert not got


def test_null_relatives_are_no_match(spark):
    links = spark.createDataFrame([("a", 1, 0.5), ("b", 1, None)], "outlet string, ord int, log_rel double")
    numbers = cuts.dense(links, ["outlet"], "number")
    assert [(r.matched, r.mean_rel) for r in cuts.per_period(links, numbers, []).collect()] == [(1, 0.5)]
    assert [(r.matched, r.cells) for r in index.per_period(links, []).collect()] == [(1, 1)]


def test_dense_numbers(spark):
    rows = spark.range(40_000).select((F.col("id") % 35_000).alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"))
    numbers = [r.number for r in cuts.dense(rows, ["a"], "number").collect()]
    assert sorted(numbers) == list(range(1, 35_001))
    again = {r.a: r.number for r in cuts.dense(rows.repartition(7), ["a"], "number").collect()}
    assert again == {r.a: r.number for r in cuts.dense(rows, ["a"], "number").collect()}
    assert cuts.dense(rows, ["b"], "number").count() == 1
    marked = rows.select(F.lit(1).alias("ord"), "a")
    levels_of = {"a": ("a",)}
    bits = cuts.entity_bitmaps(marked, cuts.entity_numbers(rows.select("a"), levels_of), levels_of)
    assert bits.count() == 2 and cuts.merged(bits, []).first().n == 35_000  # more than one bitmap holds


@pytest.mark.parametrize("by", [["g"], []])
def test_selected_percentiles_equal_the_built_in(spark, by):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), round(rng.choice([5.0, rng.uniform(-50, 50), rng.gauss(10, 0.01)]), 4)) for _ in range(800)] + [("one", 7.25), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("v", F.col("v").cast("decimal(20,4)"))
    shares = {"low": 0.1, "middle": 0.5, "high": 0.9, "least": 0.0, "most": 1.0, "odd": 0.333}
    key = lambda df: {r[0] if by else 0: [round(r[n], 9) for n in shares] for r in df.collect()}
    expected = df.groupBy(*by).agg(*(F.percentile(F.col("v").cast("double"), F.lit(p)).alias(n) for n, p in shares.items()))
    assert key(selection.percentiles(selection.value_counts(df, by, "v"), by, shares)) == key(expected)
    plan = levels.price_levels(cells_of(spark, random_rows(1)), ["item"])._jdf.queryExecution().toString()
    assert "percentile" not in plan.lower()


def test_kept_index_equals_a_full_run_after_rewrites(spark, tmp_path):
    rng, by = random.Random(4), ["item", "chain"]
    rows = {(o, i, t): p for o, i, t, p in random_rows(12)}
    outlets = spark.createDataFrame(ATTRIBUTES, "outlet string, chain string, state string")
    cells = lambda: cells_of(spark, [(*k, p) for k, p in rows.items()]).select("outlet", "item", "ord", "price")
    path, changed = str(tmp_path / "state"), list(range(7))
    for _ in range(3):
        kept_index.refresh(path, cells(), outlets, by, changed)
        full = cuts.chained_indices(P.star(P.links(cells()), outlets, "outlet"), P.star(cells(), outlets, "outlet"), cuts.dense(outlets, ["outlet"], "number"), by, 1, 1)
        key = lambda df: {(r.cut, r["value"], r.ord): (r.matched, r["index"] and round(r["index"], 9)) for r in df.collect()}
        assert key(kept_index.read(spark, path, 1, 1)) == key(full) != {}
        changed = sorted(rng.sample(range(7), 2))
        for k in [k for k in rows if k[2] in changed]:
            if rng.random() < 0.4:
                del rows[k]
            else:
                rows[k] = round(rng.uniform(5, 50), 2)
    kept_index.refresh(path, cells(), outlets, by, [])


@pytest.mark.parametrize("by", [[], ["zone"]])
def test_as_of_equals_plain_version(spark, monkeypatch, by):
    monkeypatch.setattr(asof, "SPAN", 10)
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 33, rng.randint(-60, 90)]), n % 3) for n in range(400)]
    table = [(rng.choice(["a", None]), rng.choice([None, rng.randint(-40, 200)]), n if n % 9 else None, str(n)) for n in range(25)] + [("a", 33, 1, "x"), ("a", 33, 2, "x")]
    got = asof.as_of(spark.createDataFrame(rows, "zone string, at int, n int").repartition(5), spark.createDataFrame(table, "zone string, since int, wage int, name string"), "at", "since", ["wage", "name"], by).collect()
    rank = lambda t: (t[1], t[2] is not None, t[2] or 0, t[3])

    def plain(zone, at, n):
        fits = sorted((t for t in table if at is not None and t[1] is not None and t[1] <= at and (not by or t[0] == zone)), key=rank)
        return (zone, at, n, *(fits[-1][2:] if fits else (None, None)))

    assert sorted(map(tuple, got), key=str) == sorted((plain(*r) for r in rows), key=str)
    dates = spark.sql("select date'2024-03-05' at union all select date'2020-01-01'")
    known = spark.sql("select date'2024-03-01' since, 1 v union all select date'2001-01-01', 2")
    assert {str(r["at"]): r.v for r in asof.as_of(dates, known, "at", "since", ["v"]).collect()} == {"2024-03-05": 1, "2020-01-01": 2}
    assert asof.as_of(dates, known.limit(0), "at", "since", ["v"]).filter("v is null").count() == 2


def test_dictionary_of_many_words(spark):
    words = {f"word{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}": f"w{i}" for i in range(3000)}
    rows = spark.createDataFrame([("wordaaa, wordaab! wordzzz wordaaac",), ("",), (None,)], "t string")
    assert [r.t for r in rows.select(text.repair_words(F.col("t"), words).alias("t")).collect()] == ["w0, w1! wordzzz wordaaac", "", None]
    table, size = text.bucketed(words)
    sizes = [0] * size
    for w in words:
        sizes[zlib.crc32(w.encode()) % size] += 1
    assert max(sizes) < 10


@pytest.fixture
def ranged(spark):
    """Ranges of 64 bytes, so that files are cut inside lines and characters."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "64b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


CONTENTS = {
    "plain.csv": ("a,b\n" + "\n".join(f"{'é' * (i % 9)}ñ€,{i}" for i in range(90))).encode(), "feed at end.csv": b"a,b\n" + b"x,\xc3\xa9\n" * 40, "crlf.csv": "a,b\r\nü,\r\n".encode() * 30,
    "win.csv": b"a,b\n" + "“ñ”,€\n".encode("cp1252") * 50, "bad.csv": b"a,b\n" + b"\x81\xf1,x\n" * 30, "empty.csv": b"", "feeds.csv": b"\n\n\n", "long.csv": b"a" * 3_000 + b"\n" + b"b" * 50,
}


def test_files_by_ranges(spark, tmp_path, ranged):
    for name, data in CONTENTS.items():
        (tmp_path / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[-1]: r for r in files.fingerprints(spark, f"{tmp_path}/*.csv").collect()}
    sums = {r.path.rsplit("/", 1)[-1]: (r.bytes, r.crc32) for r in files.checksums(spark, f"{tmp_path}/*.csv").collect()}
    kinds = {r.path.rsplit("/", 1)[-1]: (r.encoding, bytes(r.header)) for r in landing.encodings(spark, f"{tmp_path}/*.csv").collect()}
    assert set(got) == set(sums) == set(kinds) == set(CONTENTS) - {"empty.csv"}
    for name, data in ((n, d) for n, d in CONTENTS.items() if d):
        assert (got[name].sha256, got[name].bytes, got[name].crc32) == (hashlib.sha256(data).hexdigest(), len(data), zlib.crc32(data)), name
        assert sums[name] == (len(data), zlib.crc32(data)), name
    assert [kinds[n][0] for n in ("plain.csv", "feed at end.csv", "crlf.csv", "win.csv", "bad.csv")] == ["utf-8", "utf-8", "utf-8", "cp1252", None]
    assert kinds["crlf.csv"][1] == b"a,b" and kinds["feeds.csv"][1] == b""
    rows = landing.checked_csv(spark, [f"{tmp_path}/plain.csv", f"{tmp_path}/win.csv"], ["b", "a"]).collect()
    assert len(rows) == 140 and {r.a for r in rows if r.encoding == "cp1252"} == {"“ñ”"}


def test_crc_combination():
    for a, b in ((b"", b""), (b"abc", b""), (b"", b"xyz"), (b"abc" * 999, bytes(range(256)) * 77)):
        assert files.crc_after(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_misfit_records(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a,b\n1,2\n3\n4,5,6\n"7\n7",8\n')
    rows = {r.a: r["_misfit"] for r in landing.checked_csv(spark, [f"{tmp_path}/m.csv"], ["a", "b"], misfits=True).collect()}
    assert rows == {"1": False, "3": True, "4": True, "7\n7": False}
    with pytest.raises(Exception, match="too few or too many"):
        landing.checked_csv(spark, [f"{tmp_path}/m.csv"], ["a", "b"]).collect()


def test_lineage_is_never_missing_or_shared(spark, tmp_path):
    paths = []
    for folder in ("x", "y"):
        spark.createDataFrame([(folder,)], "v string").coalesce(1).write.parquet(str(tmp_path / folder))
        part = next((tmp_path / folder).glob("*.parquet"))
        paths.append(str(part.rename(part.with_name("part.parquet"))))
    manifest = lambda *names: spark.createDataFrame([(n, f"p{i}", i, "s") for i, n in enumerate(names)], "file string, period string, attempt long, sha256 string")
    got = landing.parquet_landing(spark, paths, manifest("x/part.parquet", "y/part.parquet"))
    assert {(r.v, r["_period"]) for r in got.collect()} == {("x", "p0"), ("y", "p1")}
    with pytest.raises(ValueError, match="names that fit several"):
        landing.parquet_landing(spark, paths, manifest("part.parquet"))
    with pytest.raises(ValueError, match="no row of the manifest"):
        landing.parquet_landing(spark, paths, manifest("x/part.parquet"))
    with pytest.raises(ValueError, match="or several"):
        landing.parquet_landing(spark, paths[:1], manifest("x/part.parquet", "part.parquet"))


def test_a_batch_replayed_appends_nothing(spark, tmp_path):
    target, mark, source = (str(tmp_path / n) for n in ("out", "mark", "in"))
    for n in (1, 2):
        spark.createDataFrame([(n,)], "v int").write.mode("append").parquet(source)
        stream_landing(spark, source, "v int", target, mark, "run").awaitTermination()
    land_batch(spark.createDataFrame([(2,)], "v int"), 1, target, mark, "run")
    assert sorted(r.v for r in spark.read.parquet(target).collect()) == [1, 2]
    other = str(tmp_path / "other")
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "metadata").write_text(json.dumps({"id": "another"}))
    land_batch(spark.createDataFrame([(3,)], "v int"), 1, target, other, "run")
    assert sorted(r.v for r in spark.read.parquet(target).collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="schema"):
        sinks.append_once(spark.createDataFrame([("x",)], "v string"), target, "s", 9)


def test_replaced_periods_keep_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "p")], "v int, period string").write.partitionBy("period").parquet(path)
    for rows, schema in (([("x", "p")], "v string, period string"), ([(1, 2, "p")], "v int, w int, period string")):
        with pytest.raises(ValueError, match="schema"):
            sinks.replace_periods(spark.createDataFrame(rows, schema), path, "period", ["p"])
    assert spark.read.parquet(path).count() == 1


def test_upsert_leaves_other_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.range(500).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert sinks.upsert(one, path, ["k"], buckets=16) == {"insert": 500, "update": 0}
    seen = lambda: {str(p.relative_to(tmp_path)) for p in (tmp_path / "t").rglob("*.parquet")}
    before = seen()
    batch = spark.createDataFrame([(7, "b", 1), (9, "a", None), (None, "n", 2)], "k int, v string, w int")
    assert sinks.upsert(batch, path, ["k"]) == {"insert": 1, "update": 1}
    assert len({p.split("/")[1] for p in before - seen()}) in (1, 2) and len(before & seen()) >= 14
    rows = {r.k: (r.v, r.w) for r in sinks.upserted(spark, path).collect()}
    assert len(rows) == 501 and (rows[7], rows[None], rows[8], rows[9]) == (("b", 1), ("n", 2), ("a", None), ("a", None))
    after = seen()
    assert sinks.upsert(batch, path, ["k"]) == {"insert": 0, "update": 0} and seen() == after
    with pytest.raises(ValueError, match="repeated"):
        sinks.upsert(spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string"), path, ["k"])


def test_upsert_goes_on_from_a_whole_stage(spark, tmp_path):
    """A run that ended while buckets were replaced: its stage is applied by the next one."""
    path = str(tmp_path / "t")
    sinks.upsert(spark.createDataFrame([(1, "a"), (2, "a")], "k long, v string"), path, ["k"], buckets=4)
    staged = sinks._bucketed(spark.createDataFrame([(1, "late", "update")], "k long, v string, action string"), ["k"], 4)
    staged.unionByName(sinks._bucketed(spark.createDataFrame([(2, "a", "keep")], "k long, v string, action string"), ["k"], 4)).write.partitionBy("_bucket_of_4").parquet(f"{path}.staged")
    sinks.upsert(spark.createDataFrame([(3, "c")], "k long, v string"), path, ["k"])
    assert {r.k: r.v for r in sinks.upserted(spark, path).collect()} == {1: "late", 2: "a", 3: "c"}
    assert not landing.exists(spark, f"{path}.staged")
