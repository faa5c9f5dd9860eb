"""Hard negatives against a plain version, on the sample and on odd tables."""

import duckdb
import numpy as np
import pytest

from plumbline.llm import negatives
from plumbline.llm.queries import ORACLE_SQL, QUERIES

SAMPLE = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<double>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=100):
    """Every score of every anchor, sorted; rows of one width."""
    sound = [(i, v, l) for i, v, l, *_ in rows if None not in (i, v, l) and all(x is not None and np.isfinite(x) for x in v)]
    label = {k: (l + 1) % 10 if i % 7 == 0 else l for k, (i, _, l) in enumerate(sound)}
    parts = [[int(np.floor(256 * x)) for x in v] for _, v, _ in sound]
    out = []
    for a, (anchor, _, _) in enumerate(sound):
        if anchor % every:
            continue
        scored = sorted((-sum(map(int.__mul__, parts[a], p)), sound[k][0], k) for k, p in enumerate(parts))
        near = [(i, -s) for s, i, k in scored if label[k] == label[a] and i != anchor][:5]
        for positive, score in near:
            found = [(i, -s) for s, i, k in scored if label[k] != label[a] and 30 * score <= -100 * s <= 90 * score][:10]
            out += [(anchor, positive, n + 1, i, score, s) for n, (i, s) in enumerate(found)]
    return sorted(out)


def got(df, **kind):
    return sorted(tuple(r) for r in negatives.hard_negatives(df, **kind).select(*NAMES).collect())


def test_sample_equals_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view embeddings as select * from '{SAMPLE}/embeddings.parquet'")
    expected = c.execute(f"select {', '.join(NAMES)} from ({ORACLE_SQL['op13_negatives']})").fetchall()
    assert sorted(tuple(r) for r in QUERIES["op13_negatives"](spark, SAMPLE).select(*NAMES).collect()) == sorted(expected)


def test_odd_rows_equal_plain_version(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, 20).round(2).tolist(), int(rng.integers(0, 4))) for i in range(500)]
    rows += [(600 + i, rows[3][1], 1) for i in range(60)] + [(700, rows[3][1], 2)]  # a group of equal vectors, ties by id
    rows += [(800, None, 1), (900, [0.0] * 20, None), (1000, [float("nan")] * 20, 1), (1100, [float("inf")] * 20, 1), (1200, [None] * 20, 1), (None, [0.1] * 20, 1), (1300, [0.0] * 20, 3), (-100, rows[4][1], 2)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], KIND + ", score int, place int").repartition(5)
    assert got(df) == plain(rows)
    assert got(df, every=50) == plain(rows, 50)


def test_blocks_and_tasks_don_t_change_the_result(spark, monkeypatch):
    rows = [(i, [((i * 37 + j * 11) % 19 - 9) / 10 for j in range(16)], i % 3) for i in range(700)]
    expected = plain(rows)
    for size, pieces in ((2048, 1), (64, 3)):
        monkeypatch.setattr(negatives, "BLOCK", size)
        monkeypatch.setattr(negatives, "ANCHORS", size // 32)
        assert got(spark.createDataFrame(rows, KIND).repartition(pieces)) == expected


def test_widths_and_edges(spark):
    short = [(100, [1.0, 0.5], 1), (1, [1.0, 0.5, 0.25], 1), (2, [0.5], 2), (3, [], 2)]
    filled = [(i, v + [0.0] * (3 - len(v)), l) for i, v, l in short]
    assert got(spark.createDataFrame(short, KIND)) == plain(filled) != []
    assert got(spark.createDataFrame([], KIND)) == [] == got(spark.createDataFrame([(100, [1.0], 1), (1, [0.5], 2)], KIND))
    with pytest.raises(Exception, match="fit a long"):
        got(spark.createDataFrame([(100, [1e18], 1), (1, [1e18], 1)], KIND))


def test_bounds_hold_and_repeated_rows_count(spark):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-300, 300, (40, 32)) for _ in range(2))
    block = lambda p: negatives.Block({"ids": np.arange(40).tobytes(), "labels": np.zeros(40, "<i8").tobytes(), "parts": p.astype(np.int64).tobytes(), "width": 8} | dict(zip(("means", "deviations"), (x.tobytes() for x in negatives.summaries(p)), strict=True)), 32)
    exact = a @ b.T
    widths = []
    for level in range(len(negatives.LEVELS)):
        low, high = negatives.bounds(block(a), block(b), level)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).mean())
    assert widths == sorted(widths, reverse=True)
    rows = [(100, [1.0], 1), (100, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (2, [0.5], 2)]
    assert got(spark.createDataFrame(rows, KIND)) == [(100, 1, n, 2, 65536, 32768) for n in (1, 2)]
