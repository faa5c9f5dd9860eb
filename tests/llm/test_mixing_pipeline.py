"""Mixing against a plain version, and the pipeline stage by stage against plain versions."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from plumbline.llm import mixing
from plumbline.llm.common import documents, tokenizer_file
from plumbline.llm.queries import ORACLE_SQL

SAMPLE = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Deal by weight, stop at the limit, deal the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        left, w = total - sum(full.values()), sum(weight[s] for s in rest)
        share = {s: left * weight[s] / w for s in rest}
        over = [s for s in rest if share[s] > most * sizes[s]]
        if not over:
            return {**share, **full}
        full |= {s: most * sizes[s] for s in over}


ROWS = [(i, "w " * (i % 9 + 1), "big") for i in range(300)] + [(1000 + i, "w " * 5, f"s{i % 7}") for i in range(60)] + [(2000 + i, "x\x0by z", None) for i in range(9)] + [(3000, None, "none"), (3001, "", "none"), (3002, "a" * 300_000 + " b", "é"), (3003, "a", "\U00010000"), (3003, "a", "\U00010000"), (None, "q r", "big")]


def test_mix_equals_plain_version(spark):
    df = spark.createDataFrame([(d, t, s, 0, 0) for d, t, s in ROWS], "doc_id long, text string, source string, size int, need int")
    got = mixing.mix_sizes(df).collect()
    again = mixing.mix_sizes(df.repartition(7)).collect()
    key = lambda rows: sorted((r.doc_id or -1, r["size"], r.source_size, r.target, r.taken) for r in rows)
    assert key(got) == key(again) and len(got) == len(ROWS)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in ROWS:
        sizes[s] = sizes.get(s, 0) + count(t)
    expected = plain_targets(sizes)
    assert sum(expected.values()) == pytest.approx(sum(sizes.values()))
    source = {d: s for d, _, s in ROWS}
    taken, longest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(expected[s]) and r.taken <= 3 * r["size"]
        taken[s] += r.taken
        longest[s] = max(longest[s], r["size"])
    assert all(abs(taken[s] - expected[s]) <= longest[s] * (2 if s == "\U00010000" else 1) for s in sizes)


def test_mix_equals_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{SAMPLE}/documents.parquet'")
    expected = {r[0]: r[1:] for r in c.execute(f"select doc_id, size, source_size, target, taken from ({ORACLE_SQL['op5_mixing']})").fetchall()}
    assert {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in mixing.mix_sizes(documents(spark, SAMPLE)).collect()} == expected


def test_mix_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sizes(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    silent = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix_sizes(silent).collect()] == [(0.0, 0), (0.0, 0)]


def test_mixed_documents_repeat_rows(spark):
    df = spark.createDataFrame([(d, t, s, "x") for d, t, s in ROWS], "doc_id long, text string, source string, place string")
    sizes = {(r.doc_id, r["size"]): r.taken for r in mixing.mix_sizes(df).collect()}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    counted = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for (d, n), taken in sizes.items():
        if n and d != 3003:
            assert counted.get(d, 0) == taken // n


def test_pipeline_stages(spark, tmp_path):
    docs, kept = documents(spark, SAMPLE), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SAMPLE).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs)
        assert i == 4 or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SAMPLE}/labels.parquet").collect()}
    good = {r.doc_id for r in kept[0].collect()}
    known = [d for d in labels if labels[d] is not None]
    assert sum((d in good) == (labels[d] == 1) for d in known) / len(known) > 0.93

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    before, after = {r.doc_id: r.text for r in kept[0].collect()}, {r.doc_id for r in kept[1].collect()}
    sets = {d: shingles(t) for d, t in before.items()}
    near = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert all(not (a in after and b in after) for a, b in near)
    assert all(d in after or any(d in p for p in near) for d in before)
    clean = {r.doc_id: r.text for r in kept[2].collect()}
    secret = re.compile('(?i)(token = ")[0-9a-f]{40}(")')
    assert clean == {d: secret.sub(r"\1[SECRET]\2", before[d]) for d in after}
    times = {r.doc_id: r.n for r in kept[3].groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    sizes = {r.doc_id: r.taken // r["size"] for r in mixing.mix_sizes(kept[2]).collect() if r["size"]}
    assert times == {d: n for d, n in sizes.items() if n}
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    got = sorted((r.doc_id, r.n_tokens) for r in kept[4].collect())
    assert got == sorted((d, len(library.encode(clean[d], add_special_tokens=False).ids)) for d, n in times.items() for _ in range(n))


def written_tables(spark, tmp_path, rows, labelled=True):
    """A folder with documents (extra, clashing columns too) and labels, made from the sample and odd rows."""
    base = str(tmp_path / "odd")
    sample = documents(spark, SAMPLE).select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame(rows, sample.schema)
    extra = (sample.unionByName(odd) if labelled else odd).withColumns({"key": F.lit("x"), "size": F.lit(1), "row": F.lit(2), "a.b": F.lit(3), "root": F.lit(None).cast("int")})
    extra.write.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet")
    (labels if labelled else labels.limit(0)).write.parquet(f"{base}/labels.parquet")
    return base


def test_run_on_odd_tables(spark, tmp_path):
    good = next(r.text for r in documents(spark, SAMPLE).join(spark.read.parquet(f"{SAMPLE}/labels.parquet").filter("quality = 1"), "doc_id").orderBy(F.length("text").desc()).collect() if "token" not in r.text)
    rows = [(90_001, good + " tail of its own", "en", None, None), (90_001, good + " tail of its own", "en", None, None), (90_002, None, None, None, None), (90_003, "", "en", "s", 0), (None, good[: len(good) // 3], None, "s", 1), (90_005, "word " * 60_000, "en", "s", 1)]
    base = written_tables(spark, tmp_path, rows)
    got = corpus_pipeline.run(spark, base).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{base}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in got} <= ids and len(got) > 20
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    plain_ones = [r for r in got if r.doc_id is not None and "token" not in (texts[r.doc_id] or "")]
    assert plain_ones and all(r.n_tokens == len(library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids) for r in plain_ones)


def test_run_on_empty_and_unlabelled_tables(spark, tmp_path):
    base = written_tables(spark, tmp_path, [], labelled=False)
    assert corpus_pipeline.run(spark, base).count() == 0


def test_mixed_documents_with_odd_names(spark):
    df = spark.createDataFrame([(1, "a b", "s", 5, 6), (2, None, None, None, None)], "doc_id long, text string, source string, `a.b` int, `row` int")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and {r["a.b"] for r in out.collect()} <= {5, None}
