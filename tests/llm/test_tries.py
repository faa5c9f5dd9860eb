"""The prefix trie against a plain one, on the sample and on odd tables."""

import hashlib
import random
import zlib

import duckdb
import pytest

from plumbline.llm import tries
from plumbline.llm.queries import ORACLE_SQL, QUERIES

SAMPLE = "/root/testdata/sf0.001"
KIND = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def order_key(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    return turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain(rows):
    """Every prefix as a tuple, its totals from the deepest up."""
    old = {}
    for r in sorted((r for r in rows if r[0] is not None), key=order_key):
        old.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    new = {}
    for c, turns in old.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        new[c] = tuple(old.get(base, [])[:h] + turns[h:])
    nodes, below, leaves, saved = {}, {}, {}, {}
    for c, turns in new.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    for x in nodes:
        if x:
            below.setdefault(x[:-1], []).append(x)
    for x in sorted(nodes, key=len, reverse=True):
        leaves[x] = sum(leaves[y] for y in below[x]) if x in below else 1
        saved[x] = (len(nodes[x]) - 1) * (len(x[-1][1].encode()) if x else 0) + sum(saved[y] for y in below.get(x, []))
    ends = lambda x: hashlib.sha256(",".join(str(c) for c in sorted(nodes[x]) if len(new[c]) == len(x)).encode()).hexdigest()
    return sorted(((min(m), len(x), min(nodes[x[:-1]]) if x else None, len(m), len(below.get(x, [])), leaves[x], saved[x], ends(x)) for x, m in nodes.items()), key=str)


def got(df):
    return sorted((tuple(r) for r in tries.prefix_trie(df).select(*NAMES).collect()), key=str)


def test_sample_equals_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{SAMPLE}/conversations.parquet'")
    expected = c.execute(f"select {', '.join(NAMES)} from ({ORACLE_SQL['op12_trie']})").fetchall()
    found = QUERIES["op12_trie"](spark, SAMPLE).select(*NAMES).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("bits", [16, 2])
def test_odd_conversations_equal_plain_version(spark, monkeypatch, bits):
    """Chains of prefixes, equal conversations, a long one, ties, nulls and negative ids; also with tiny chunks of depth."""
    monkeypatch.setattr(tries, "CHUNK_BITS", bits)
    rng, rows = random.Random(3), []
    for c in range(60):
        rows += [(c, t, "user", rng.choice("ab")) for t in range(rng.randint(1, 30))]
    for c in range(100, 140):  # each the start of the next
        rows += [(c, t, "user", f"é{t}") for t in range(c - 90)]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(12)]
    rows += [(300, t, "user", str(t)) for t in range(300)] + [(303, t, "user", str(t)) for t in range(299, -1, -1)]
    rows += [(-7, 1, None, None), (-7, None, "", ""), (-5, 1, "x", "y"), (-5, 1, "x", "y"), (-5, 1, "", "xy"), (None, 1, "a", "b"), (400, 0, "a" * 9, ""), (401, 0, "", "a" * 50_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], KIND + ", depth int, name string")
    assert got(df.repartition(6)) == plain(rows)


@pytest.mark.parametrize("rows", [[(6, 0, "a", "b")], [(6, t, "a", "b") for t in range(2)] + [(8, 0, "a", "b")], [(6, t, "a", str(t)) for t in range(9)], [(None, 0, "a", "b")], []])
def test_edges(spark, rows):
    assert got(spark.createDataFrame(rows, KIND)) == (plain(rows) if any(r[0] is not None for r in rows) else [])


def test_ids_are_hashed_in_pieces(spark):
    ids = [(s, c) for s in (1, 2) for c in range(s * 100_000, s * 100_000 + 30_000 // s)] + [(3, 7)]
    found = {r.s: r.ends_sha256 for r in tries.id_hashes(spark.createDataFrame(ids, "s long, conv_id long").repartition(7)).collect()}
    assert found == {s: hashlib.sha256(",".join(str(c) for k, c in ids if k == s).encode()).hexdigest() for s in (1, 2, 3)}
