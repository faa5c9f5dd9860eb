import math

import pytest
from pyspark.sql import functions as F

from plumbline.operators import gates, index, kept_index
from plumbline.plans import layers
from plumbline.sources import landing, sinks

SPEC = layers.FeedSpec(outlet=("name", "address"), outlet_attributes=("chain",), item=("sku",), item_attributes=("category",), price="price", words={"Vi?a": "Viña"}, excluded=("skip",))
COLUMNS = "name string, address string, chain string, sku string, category string, price string"


def land(spark, tmp_path, period, attempt, rows):
    folder = str(tmp_path / f"{period}-{attempt}")
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.parquet(folder)
    file = next(p for p in (tmp_path / f"{period}-{attempt}").glob("*.parquet"))
    return str(file), (file.name, period, attempt, f"s{period}{attempt}", len(rows))


def kept_item(rows):
    return next(r["value"] for r in rows if r.cut == "item")


def row(name, price, sku="x"):
    return (name, "street 1", "c", sku, "bread", price)


def test_layers_end_to_end(spark, tmp_path):
    landed = [
        land(spark, tmp_path, "2024-01_q1", 1, [row("A", "10"), row("Vi?a", "20"), row("A", "99", "skip")]),
        land(spark, tmp_path, "2024-01_q2", 1, [row("A", "12"), row("Vi?a", "20"), row("C", "30")]),
        land(spark, tmp_path, "2024-02_q1", 1, [row("Vi?a", "25"), row("C", "30")]),
    ]
    store, schema = sinks.Store(spark, str(tmp_path / "lake")), "file string, period string, attempt long, sha256 string, rows long"
    manifest = spark.createDataFrame([m for _, m in landed], schema)
    log = sinks.RunLog()
    assert layers.run_bronze(store, "prices", [p for p, _ in landed], manifest, "r1", log) == 3
    labels = layers.run_silver(store, "prices", SPEC, "", log)
    assert labels == ["2024-01_q1", "2024-01_q2", "2024-02_q1"]
    layers.run_gold(store, labels, 20, log, ["item", "chain"])
    read = lambda: store.read("silver", "cells")
    value = lambda: index.chained_index(store.read("gold", "links"), read(), read().select("ord").distinct(), [], 1, 1).agg(F.max_by("index", "ord")).first()[0]
    assert store.read("gold", "links").count() == 4 and value() == pytest.approx(100 * math.sqrt(1.5))
    assert store.read("silver", "outlets").filter("name = 'Viña'").count() == 1

    again = sinks.RunLog()
    assert layers.run_bronze(store, "prices", [p for p, _ in landed], manifest, "r2", again) == 0
    assert layers.run_silver(store, "prices", SPEC, "", again) == []

    path, entry = land(spark, tmp_path, "2024-01_q2", 2, [row("A", "20"), row("Vi?a", "20"), row("C", "30")])
    more = spark.createDataFrame([m for _, m in landed] + [entry], schema)
    third = sinks.RunLog()
    assert layers.run_bronze(store, "prices", [*(p for p, _ in landed), path], more, "r3", third) == 1
    labels = layers.run_silver(store, "prices", SPEC, "", third)
    assert labels == ["2024-01_q2"]
    layers.run_gold(store, labels, 20, third, ["item", "chain"])
    assert value() == pytest.approx(100 * math.sqrt(2) * math.sqrt(1.25))

    gold = {n: store.read("gold", n) for n in ("prices", "links", "outlets", "items", "calendar")}
    assert (gold["prices"].count(), gold["outlets"].count(), gold["items"].count(), gold["calendar"].count()) == (7, 3, 1, 3)
    star = gold["prices"].join(gold["outlets"], "outlet").join(gold["items"], "item").join(gold["calendar"].select("period_id", "ord"), "period_id")
    assert star.count() == 7 and {(r.name, r.ord - 2024 * 24, float(r.price)) for r in star.filter("name = 'A'").collect()} == {("A", 0, 10.0), ("A", 1, 20.0)}
    kept = kept_index.read(spark, store.path("gold", "index"), 1, 1).filter(F.col("ord") == 2024 * 24 + 2).collect()
    assert {(r.cut, r["value"]) for r in kept} == {("total", None), ("chain", "c"), ("item", kept_item(kept))}
    assert all(r["index"] == pytest.approx(value()) for r in kept)


def test_silver_stops_before_writing(spark, tmp_path):
    path, entry = land(spark, tmp_path, "2024-01_q1", 1, [row("A?b", "10")])
    store = sinks.Store(spark, str(tmp_path / "lake"))
    manifest = spark.createDataFrame([entry], "file string, period string, attempt long, sha256 string, rows long")
    layers.run_bronze(store, "prices", [path], manifest, "r", sinks.RunLog())
    with pytest.raises(gates.GateError, match="illegal"):
        layers.run_silver(store, "prices", SPEC, "", sinks.RunLog())
    assert not store.has("silver", "cells")


def test_bronze_reconciles(spark, tmp_path):
    path, entry = land(spark, tmp_path, "2024-01_q1", 1, [row("A", "10")])
    manifest = spark.createDataFrame([(*entry[:4], 7)], "file string, period string, attempt long, sha256 string, rows long")
    with pytest.raises(gates.GateError, match="declared"):
        layers.run_bronze(sinks.Store(spark, str(tmp_path / "lake")), "prices", [path], manifest, "r", sinks.RunLog())


def test_manifest_names_files_by_folder(spark, tmp_path):
    """Two files of one base name in two folders, both of one batch: rows declared are added up."""
    rows = spark.createDataFrame([row("A", "10"), row("B", "11")], COLUMNS)
    for folder in ("x", "y"):
        rows.coalesce(1).write.parquet(str(tmp_path / folder))
        next((tmp_path / folder).glob("*.parquet")).rename(tmp_path / folder / "same.parquet")
    manifest = spark.createDataFrame([(f"{f}/same.parquet", "2024-01_q1", 1, f, 2) for f in ("x", "y")], "file string, period string, attempt long, sha256 string, rows long")
    store, log = sinks.Store(spark, str(tmp_path / "lake")), sinks.RunLog()
    assert layers.run_bronze(store, "prices", [str(tmp_path / f / "same.parquet") for f in ("x", "y")], manifest, "r", log.part("a.")) == 1
    assert store.read("bronze", "prices").groupBy("_sha256").count().count() == 2 and log.steps == {"a.bronze.prices": {"batches": 1, "files": 2}}


def test_feed_columns_named_as_the_stars():
    with pytest.raises(ValueError, match="outlet"):
        layers.FeedSpec(outlet=("outlet",), outlet_attributes=(), item=("sku",), item_attributes=(), price="price")


def test_period_replacement_makes_its_rows_once(spark, tmp_path):
    """Rows are made once for the check and the table, and nothing of them stays beside it, not even after a refusal."""
    path, made = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(1, 7), (2, 8), (2, 9)], "ord int, x int").mapInArrow(counted, "ord int, x int")
    sinks.replace_periods(rows, path, "ord", [1, 2, 3])
    assert made.value == 3 and spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError, match="outside"):
        sinks.replace_periods(rows, path, "ord", [1])
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_upsert_makes_its_batch_once(spark, tmp_path):
    """The batch is read from what was written, and nothing of it stays behind, not even after a refusal."""
    path, made = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    new = spark.range(10).withColumn("v", F.col("id") * 2).mapInArrow(counted, "id long, v long")
    assert sinks.upsert(new, path, ["id"]) == {"insert": 10, "update": 0} and made.value == 10
    with pytest.raises(ValueError, match="repeated"):
        sinks.upsert(spark.createDataFrame([(1, 1), (1, 2)], "id long, v long"), path, ["id"])
    assert sinks.upsert(spark.createDataFrame([(1, 1), (11, 2)], "id long, v long"), path, ["id"]) == {"insert": 1, "update": 1}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"] and sinks.upserted(spark, path).count() == 11


def jobs(spark, group, run):
    """What ``run`` gives, and how many jobs the driver planned for it."""
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = run()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_sinks_leave_few_jobs_on_the_driver(spark, tmp_path):
    """A session's driver keeps each job's plan and state, so a load, a replacement and a landing take few."""
    new = spark.range(1000).withColumn("v", F.col("id") * 2)
    told, n = jobs(spark, "load", lambda: sinks.upsert(new, str(tmp_path / "t"), ["id"], 8))
    assert told == {"insert": 1000, "update": 0} and n <= 5
    _, n = jobs(spark, "replace", lambda: sinks.replace_periods(new.withColumn("ord", F.col("id") % 9), str(tmp_path / "p"), "ord", range(9)))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1000 and n <= 2
    path, entry = land(spark, tmp_path, "2024-01_q1", 1, [row("A", "10"), row("B", "12")])
    manifest = spark.createDataFrame([entry], "file string, period string, attempt long, sha256 string, rows long")
    rows, n = jobs(spark, "landing", lambda: landing.parquet_landing(spark, [path], manifest))
    assert rows.filter("_period = '2024-01_q1'").count() == 2 and n <= 6


def test_period_replacement_by_odd_names(spark, tmp_path):
    """Folders are found by the text they stand for; a row without a period is refused and leaves the table as it was."""
    path, read = str(tmp_path / "t"), lambda: {(r.ord, r.x) for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    names = ["a/b: c", "100%", "ñ=1"]
    sinks.replace_periods(spark.createDataFrame([(n, i) for i, n in enumerate(names)], "ord string, x int"), path, "ord", names)
    sinks.replace_periods(spark.createDataFrame([(names[0], 7)], "ord string, x int"), path, "ord", names[:2])
    assert read() == {(names[0], 7), (names[2], 2)}
    with pytest.raises(ValueError, match="outside"):
        sinks.replace_periods(spark.createDataFrame([(names[0], 8), (None, 9)], "ord string, x int"), path, "ord", names)
    with pytest.raises(ValueError, match="empty"):
        sinks.replace_periods(spark.createDataFrame([(names[0], 8)], "ord string, x int"), path, "ord", ["", names[0]])
    assert read() == {(names[0], 7), (names[2], 2)} and [p.name for p in tmp_path.iterdir()] == ["t"]
