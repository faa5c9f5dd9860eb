import pytest
from pyspark.sql import functions as F

from plumbline.functions import keys, periods, text
from plumbline.operators import gates
from plumbline.sources import landing, sinks, state
from plumbline.streaming.landing import stream_landing


def test_null_is_passed_over_by_the_key(spark):
    rows = spark.createDataFrame([("corner shop", None), (None, "corner shop")], "a string, b string")
    assert len({r[0] for r in rows.select(keys.key("a", "b")).collect()}) == 1
    assert gates.blank_counts(rows, ["a", "b"]).count() == 2


def test_ansi_cast_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("18.50",), ("N/D",)], "p string").select(F.col("p").cast("decimal(10,2)")).collect()


def test_gates_pass_and_fail(spark):
    df = spark.createDataFrame([("k", "x", 1), ("k", "y", -1), ("l", " ", 2)], "k string, v string, n int")
    assert [(r.attribute, r["values"]) for r in gates.several_values(df, ["k"], ["v"]).collect()] == [("v", ["x", "y"])]
    assert gates.several_values(df, ["k", "n"], ["v"]).count() == 0
    assert gates.blank_counts(df, ["k", "v"]).first().blanks == 1
    assert gates.broken(df, {"n": "n > 0"}).first().violations == 1
    assert gates.repeated_keys(df, "k").count() == 1
    gates.enforce(df.filter("n > 5"), "none")
    with pytest.raises(gates.GateError, match="positive"):
        gates.enforce(df.filter("n < 0"), "positive")
    assert gates.too_many(df, ["k"], 1).count() == 1 and gates.too_many(df, ["k"], 2).count() == 0
    assert gates.unknown_format(df, "v", ["^x$"]).count() == 2
    assert gates.malformed(df, "v", "^[xy]$").count() == 1
    assert gates.outside_vocabulary(df, "k", df.select("k").filter("k = 'k'")).first().k == "l"
    series = spark.createDataFrame([("15", "1051"), ("4", "1051")], "freq string, unit string")
    assert gates.other_series(series, {"freq": "15", "unit": "1051"}).count() == 1


def test_period_functions(spark):
    assert periods.between(spark, "2024-01", "2025-11").count() == 46
    row = spark.createDataFrame([("2024-02_q2",)], "l string").select(periods.ordinal(F.col("l")).alias("o"), periods.start(F.col("l")).alias("d")).select("o", "d", periods.label_of_ordinal(F.col("o")).alias("l"), periods.ordinal_of_date(F.col("d")).alias("p"), periods.label_of(F.col("d")).alias("m")).first()
    assert (row.o, str(row.d), row.l, row.p, row.m) == (2024 * 24 + 3, "2024-02-16", "2024-02_q2", 2024 * 24 + 3, "2024-02_q2")


def test_text_repair(spark):
    words = {"Monta?a": "Montaña", "Zapater?as": "Zapaterias"}
    rows = spark.createDataFrame([(1, "Caðada, D´amico 7"), (2, "Monta?a Alta - Zapater?as"), (3, None), (4, "Bodeg?")], "id int, t string")
    got = {r.id: r.t for r in text.canonical(rows, ["t"], words, {"t": {"Bodeg?": "Bodega"}}).collect()}
    assert got == {1: "Cañada, D'amico 7", 2: "Montaña Alta - Zapaterias", 3: None, 4: "Bodega"}
    assert [r.character for r in gates.illegal_characters(rows.filter("id = 4"), ["id"], ["t"]).collect()] == ["?"]


def test_csv_json_manifest(spark, tmp_path):
    (tmp_path / "utf.csv").write_bytes("﻿a,b\r\nMuñoz,\r\n".encode())
    (tmp_path / "win.csv").write_bytes("a,b\r\nMuñoz,“x”\r\n".encode("cp1252"))
    (tmp_path / "bad.csv").write_bytes(b"a,b\n\x81\xf1,x\n")
    paths = [str(tmp_path / n) for n in ("utf.csv", "win.csv")]
    got = sorted((r.a, r.b, r.encoding) for r in landing.checked_csv(spark, paths, ["a", "b"]).collect())
    assert got == [("Muñoz", "", "utf-8"), ("Muñoz", "“x”", "cp1252")]
    with pytest.raises(ValueError, match="neither"):
        landing.checked_csv(spark, [str(tmp_path / "bad.csv")], ["a", "b"])
    assert landing.csv_landing(spark, paths[0], ["a", "b"]).first().b == ""
    (tmp_path / "s.json").write_text('{"Series":[{"FREQ":"15","UNIT":"1051","OBSERVATIONS":[{"TIME_PERIOD":"2026/08/02","OBS_VALUE":"1.5"},{"TIME_PERIOD":"2026/08/01","OBS_VALUE":"1.4"}]}]}')
    assert landing.json_series(spark, str(tmp_path / "s.json")).count() == 2
    (tmp_path / "m.jsonl").write_text('{"period":"p","attempt":1}\n\n')
    assert landing.manifest(spark, str(tmp_path / "m.jsonl"), "period string, attempt long").count() == 1
    assert landing.manifest(spark, str(tmp_path / "none.jsonl"), "period string, attempt long").count() == 0
    found = state.fingerprints(spark, str(tmp_path / "s.json")).first()
    assert found.bytes == (tmp_path / "s.json").stat().st_size and len(found.sha256) == 64


def test_parquet_landing_carries_lineage(spark, tmp_path):
    spark.createDataFrame([("x",)], "v string").coalesce(1).write.parquet(str(tmp_path / "in"))
    name = next(p.name for p in (tmp_path / "in").glob("*.parquet"))
    manifest = spark.createDataFrame([(name, "2024-01_q1", 2, "s")], "file string, period string, attempt long, sha256 string")
    row = landing.parquet_landing(spark, [str(tmp_path / "in")], manifest).first()
    assert (row.v, row._period, row._attempt) == ("x", "2024-01_q1", 2)


def test_contract_and_cut(spark):
    df = spark.createDataFrame([("a", "c1", 1), ("b", "c2", 2)], "x string, cat string, extra int")
    assert landing.cut(df, ["x", "cat"], "cat", ["c1"]).collect() == [("a", "c1")]
    with pytest.raises(ValueError, match="missing"):
        landing.cut(df, ["x", "y"], "cat", ["c1"])
    assert landing.ordered(df.orderBy(F.desc("x"))).first().x == "a"
    assert landing.distinct_entities(df.union(df), ["x"]).count() == 2


def test_seals_and_versions(spark):
    manifest = spark.createDataFrame([("p", 1, 9, 7), ("p", 2, 10, 7), ("q", 1, 10, None), ("r", 1, 5, 1)], "period string, attempt int, bytes long, crc32 long")
    now = spark.createDataFrame([("p", 10, 8), ("q", 10, 8), ("r", 6, 1)], "period string, bytes long, crc32 long")
    assert sorted(r.period for r in state.rewritten(manifest, now).collect()) == ["p", "r"]
    registry = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "file string, version int, sha256 string")
    files = spark.createDataFrame([("a", "x"), ("b", "z")], "file string, sha256 string")
    assert sorted((r.file, r.version) for r in state.new_versions(registry, files).collect()) == [("a", 3), ("b", 1)]
    rows = spark.createDataFrame([("p", 1, "old"), ("p", 2, "new")], "period string, attempt int, v string")
    assert [r.v for r in state.current(rows, "period", "attempt").collect()] == ["new"]


def test_pending_selection_and_reconciliation(spark):
    manifest = spark.createDataFrame([("p", 1), ("p", 2), ("q", 1)], "period string, attempt int")
    table = spark.createDataFrame([("p", 1), ("p", 1)], "_p string, _a int")
    assert state.pending(manifest, table, {"period": "_p", "attempt": "_a"}).count() == 2
    assert state.pending(manifest, None, {}).count() == 3
    expected = spark.createDataFrame([("p", 2), ("q", 1)], "_p string, expected long")
    assert [(r._p, r.rows, r.expected) for r in state.unreconciled(table, expected, ["_p"]).collect()] == [("q", None, 1)]
    known = spark.createDataFrame([("2024-01_q1", 1), ("2024-01_q2", 2), ("2024-02_q1", 3)], "label string, ord int")
    late = known.filter("ord = 3")
    assert state.selected("", late, known).count() == 1 and state.selected("all", late, known).count() == 3
    assert state.selected("2024-01_q1, 2024-01_q2", late, known).count() == 2
    with pytest.raises(gates.GateError):
        state.selected("2030-01_q1", late, known)
    assert {r.label for r in state.widened(late, known).collect()} == {"2024-01_q2", "2024-02_q1"}


def test_append_is_strict(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    sinks.append(df, str(tmp_path / "t"))
    sinks.append(df, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="schema"):
        sinks.append(df.withColumn("x", F.lit(1)), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_replace_periods(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "p"), (2, "q")], "n int, period string")
    sinks.replace_periods(df, path, "period", ["p", "q"])
    new = spark.createDataFrame([(3, "q")], "n int, period string")
    sinks.replace_periods(new, path, "period", [])
    sinks.replace_periods(new, path, "period", ["q", "p"])
    sinks.replace_periods(new, path, "period", ["q", "p"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "q")]
    with pytest.raises(ValueError, match="outside"):
        sinks.replace_periods(df, path, "period", ["q"])


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    with pytest.raises(ValueError, match="empty"):
        sinks.upsert(one.limit(0), path, ["k"])
    assert sinks.upsert(one, path, ["k"]) == {"insert": 2, "update": 0}
    before = {p.name for p in (tmp_path / "t").iterdir()}
    assert sinks.upsert(one, path, ["k"]) == {"insert": 0, "update": 0}
    assert before == {p.name for p in (tmp_path / "t").iterdir()}
    two = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    assert sinks.upsert(two, path, ["k"]) == {"insert": 1, "update": 1}
    assert sorted(tuple(r) for r in sinks.upserted(spark, path).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert sinks.snapshot(sinks.upserted(spark, path), str(tmp_path / "snap"))["rows"] == 3


def test_run_log_and_store(spark, tmp_path):
    log = sinks.RunLog()
    log.note("read", rows=0)
    with pytest.raises(ValueError):
        log.note("read", rows=1)
    assert log.frame(spark).collect() == [("read", "rows", 0)]
    store = sinks.Store(spark, str(tmp_path))
    assert not store.has("silver", "x")
    spark.range(3).write.parquet(store.path("silver", "x"))
    assert store.read("silver", "x").count() == 3


def test_stream_reads_each_file_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for n in (1, 2):
        spark.createDataFrame([(n,)], "v int").write.mode("append").parquet(source)
        query = stream_landing(spark, source, "v int", target, mark, "run")
        query.awaitTermination()
    assert sorted(r.v for r in spark.read.parquet(target).collect()) == [1, 2]


def test_replace_periods_of_whole_numbers_and_dates(spark, tmp_path):
    import datetime

    rows = [(1, 2020, datetime.date(2020, 1, 1)), (2, 2021, datetime.date(2021, 1, 1))]
    df = spark.createDataFrame(rows, "v int, year int, day date")
    for column, label in (("year", "2020"), ("day", "2020-01-01")):
        path = str(tmp_path / column)
        df.write.partitionBy(column).parquet(path)
        sinks.replace_periods(df.filter("v = 1").withColumn("v", F.lit(9)), path, column, [label])
        assert sorted(r.v for r in spark.read.parquet(path).collect()) == [2, 9]


def test_upsert_keeps_columns_null_keys_and_refuses_repeated_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark.createDataFrame([(1, "a", "x"), (None, "b", "y")], "k int, v string, kept string"), path, ["k"])
    batch = spark.createDataFrame([(None, "c", 5), (2, "d", 6)], "k int, v string, more int")
    assert sinks.upsert(batch, path, ["k"]) == {"insert": 1, "update": 1}
    assert sinks.upsert(batch, path, ["k"]) == {"insert": 0, "update": 0}
    got = sorted(((r.k or 0, r.v, r.kept, r.more) for r in sinks.upserted(spark, path).collect()), key=str)
    assert got == [(0, "c", "y", 5), (1, "a", "x", None), (2, "d", None, 6)]
    with pytest.raises(ValueError, match="repeated"):
        sinks.upsert(spark.createDataFrame([(3, "a"), (3, "b")], "k int, v string"), path, ["k"])


def test_checked_csv_reads_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'b,a,extra\r\n1,"two\nlines",z\r\n')
    (tmp_path / "b.csv").write_bytes("\ufeffa,b\nñ,2\n".encode())
    (tmp_path / "c.csv").write_bytes("a,b\nñ’,3\n".encode("cp1252"))
    got = landing.checked_csv(spark, [str(tmp_path / "*.csv")], ["a", "b"]).collect()
    assert sorted(tuple(r) for r in got) == [("two\nlines", "1", "utf-8"), ("ñ", "2", "utf-8"), ("ñ’", "3", "cp1252")]
    (tmp_path / "d.csv").write_bytes(b"a,c\n1,2\n")
    with pytest.raises(ValueError, match="missing"):
        landing.checked_csv(spark, [str(tmp_path / "d.csv")], ["a", "b"])
