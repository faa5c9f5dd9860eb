"""SimHash, near copies, components: against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from plumbline.llm import simgroups, simhash
from plumbline.llm.components import components


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def shingles(text, k):
    w = words_of(text)
    return [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []


def fingerprint(text, k=3):
    s = shingles(text, k)
    counts = [sum(xxhash.xxh64_intdigest(x.encode(), seed=42) >> i & 1 for x in s) for i in range(64)]
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(s))


def groups(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 40, 200]))) for _ in range(60)]
    texts += texts[:10] + [t + " end" for t in texts[3:30] if len(t) > 300] + [None, "", "  \n ", "A B", "a b", "x\x0by\x1cz"]
    for t in texts[:40]:
        w = t.split(" ")
        if len(w) > 100:
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "clash") for d, t in rows], "doc_id long, text string, fp int, component_id string")


def test_near_groups_equal_brute_force(spark):
    rows = corpus()
    fps = {d: fingerprint(t) for d, t in rows}
    linked = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    expected = groups(list(fps), linked)
    got = simhash.near_groups(frame(spark, rows)).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{fps[d]:016x}", expected[d]) for d in fps}


def test_near_groups_of_odd_tables(spark):
    empty = frame(spark, [])
    assert simhash.near_groups(empty).count() == 0
    got = simhash.near_groups(frame(spark, [(None, "a b c d"), (None, None), (4, "a b c d"), (4, "a b c d")])).collect()
    assert sorted((r.doc_id is None, r.component_id or 0) for r in got) == [(False, 4), (False, 4), (True, 0), (True, 4)]
    long = "word " * 300_000
    assert simhash.near_groups(frame(spark, [(1, long), (2, long + "word")])).filter("component_id = 1").count() == 2


@pytest.mark.parametrize("blocks,distance", [(3, 2), (2, 2), (1, 1), (4, 7)])
def test_links_are_all_found(spark, blocks, distance):
    rng = random.Random(blocks)
    base = [rng.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 8))) for b in base for _ in range(3)]
    points = sorted(set(base + near))
    signed = [int(np.uint64(p).astype(np.int64)) for p in points]
    classes = spark.createDataFrame([(s,) for s in signed], "fp long")
    expected = {tuple(sorted((a, b))) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= distance}
    unsign = lambda x: x % (1 << 64)
    got = {tuple(sorted((unsign(r.a), unsign(r.b)))) for r in simhash.links(classes, distance, blocks).collect()}
    assert got == expected
    spanning = [(unsign(r.a), unsign(r.b)) for r in simhash.links(classes, distance, blocks, spanning=True).collect()]
    assert groups(points, spanning) == groups(points, expected)


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.id: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys([100, *range(200, 230)], 100), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def similarity(a, b):
    a, b = set(shingles(a, 5)), set(shingles(b, 5))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_one_of_each_group_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        w = rng.choices(vocabulary, k=rng.choice([60, 150, 400]))
        rows.append(" ".join(w))
        for edits in (1, 1, 2, 12):
            x = list(w)
            for _ in range(edits):
                x[rng.randrange(len(x))] = rng.choice(vocabulary)
            rows.append(" ".join(x))
    rows += rows[:5] + [None, "", "one two"]
    docs = [(i, t) for i, t in enumerate(rows)]
    linked = [(a, b) for a, x in docs for b, y in docs if a < b and similarity(x, y) >= 0.8]
    expected = groups([d for d, _ in docs], linked)
    kept = {r.doc_id for r in simgroups.one_of_each_group(frame(spark, docs)).collect()}
    assert kept == set(expected.values())


def test_a_dense_group_leaves_one(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):
        x = list(base)
        x[rng.randrange(120)] = f"edit{i}"
        rows.append((i, " ".join(x)))
    kept = simgroups.one_of_each_group(frame(spark, rows)).collect()
    assert [r.doc_id for r in kept] == [0] and kept[0].text == rows[0][1]


def test_appended_cut_and_short_copies_are_dropped(spark):
    rng = random.Random(8)
    words = lambda k, own: [f"{own}{rng.randrange(900)}" for _ in range(k)]
    rows = []
    for i in range(120):
        w = words(rng.choice([60, 150, 400]), f"t{i % 3}x")
        k = len(w)
        changed = [w + words(k * 15 // 100, "other"), w + words(k * 20 // 100, "strange"), w + words(k * 24 // 100, "foreign"), w[: k - k * 15 // 100], w[: k - k * 19 // 100]][i % 5]
        rows += [w, changed]
        short = words(9, f"short{i}x")
        rows += [short, [*short, "more"]]
    docs = [(i, " ".join(w)) for i, w in enumerate(rows)]
    assert all(similarity(docs[i][1], docs[i + 1][1]) >= 0.8 for i in range(0, len(docs), 2))
    kept = sorted(r.doc_id for r in simgroups.one_of_each_group(frame(spark, docs)).collect())
    assert kept == list(range(0, len(docs), 2))


def test_one_of_each_group_of_odd_tables(spark):
    assert simgroups.one_of_each_group(frame(spark, [])).count() == 0
    got = simgroups.one_of_each_group(frame(spark, [(1, "a b"), (1, "a b"), (None, "a b"), (None, "z"), (2, None), (3, "")]))
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, "z"), (1, "a b"), (2, "")]
    assert got.columns == ["doc_id", "text", "fp", "component_id"]


def test_fingerprints_keep_bits_in_order():
    h = np.array([1, 1, 1 << 63], np.uint64)
    assert simhash.majority(h) == 1 and simhash.majority(np.repeat(h, 300)) == 1
