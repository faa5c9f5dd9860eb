"""Operators without SQL against plain versions: loops over characters, words, samples and pairs."""

import cmath
import math
import re
from collections import Counter
from zlib import crc32

import pytest
import xxhash

from plumbline.llm import langid, media, neighbours, quality
from plumbline.llm.common import documents

SAMPLE = "/root/testdata/sf0.001"


# ---- language: counts in dictionaries, one n-gram at a time


def plain_grams(text):
    letters = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in f" {text.lower()} "))
    for n in (1, 2, 3):
        for i in range(len(letters) - n + 1):
            h = n
            for c, m in zip(letters[i : i + n], (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), strict=False):
                h = (h ^ ord(c)) * m % 2**32
                h ^= h >> 15
            yield h % 2**16


def test_language_equals_a_plain_count(spark):
    rows = [(r.doc_id, r.text[:400] if r.text else r.text, r.lang) for r in documents(spark, SAMPLE).select("doc_id", "text", "lang").limit(120).collect()]
    rows += [(100_001, None, "en"), (100_002, "123 !", "en"), (100_003, "Straße ΣΑΣ İ", None), (100_004, "", None), (100_003, "Straße ΣΑΣ İ", None)]
    counts, docs = {}, Counter()
    for i, text, lang in rows:
        if text is not None and lang is not None and crc32(str(i).encode()) % 4 != 2:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
            docs[lang] += 1
    sizes = {x: sum(c.values()) for x, c in counts.items()}
    want = []
    for i, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            want.append((i, "und", 0.0))
            continue
        logs = {x: math.log(docs[x] / docs.total()) + sum(math.log((c[g] + 0.5) / (sizes[x] + 0.5 * 2**16)) for g in plain_grams(text)) for x, c in counts.items()}
        best = max(sorted(logs), key=logs.get)
        want.append((i, best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    got = langid.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in got) == sorted((i, x) for i, x, _ in want)
    scores = {i: s for i, _, s in want}
    assert all(r.score == pytest.approx(scores[r.doc_id], abs=1e-3) for r in got)


def test_too_many_languages_raise(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    rows = [(i, "some words", f"l{i}") for i in range(40)]
    with pytest.raises(ValueError, match="more than 3 languages"):
        langid.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


# ---- quality: every pair of inputs, no identity


def test_quality_equals_a_sum_over_pairs(spark):
    docs = documents(spark, SAMPLE).select("doc_id", "text", "n_chars").limit(60)
    model = quality.fit(docs, spark.read.parquet(f"{SAMPLE}/labels.parquet"))
    rows = [(r.doc_id, " ".join((r.text or "").split()[:80]), r.n_chars) for r in docs.collect()] + [(-1, None, None), (-2, "", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: r.score for r in quality.score(frame, model).collect()}
    for i, text, n_chars in rows:
        words = (text or "").split()
        counts = Counter(words)
        length = max(1e-9, math.sqrt(sum((1 + math.log(n)) ** 2 for n in counts.values())))
        terms = [(xxhash.xxh32_intdigest(w.lower()) % quality.WORD_INPUTS, (1 + math.log(n)) / length) for w, n in counts.items()]
        terms += [(quality.WORD_INPUTS + j, float(v)) for j, v in enumerate(quality.statistics(text or "", words, counts, n_chars))]
        raw = model.bias + sum(model.weights[a] * x for a, x in terms)
        for j, (a, x) in enumerate(terms):
            for b, y in terms[:j]:
                raw += float(model.factors[a] @ model.factors[b]) * x * y
        assert got[i] == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, raw)))), abs=1e-9)


# ---- media: a Fourier sum a bin, a scan of every point's neighbours


def plain_fingerprint(payload):
    frames = max(1, math.ceil((len(payload) - 256) / 128) + 1)
    window = [0.5 - 0.5 * math.cos(2 * math.pi * i / 255) for i in range(256)]
    turn = [cmath.exp(-2j * math.pi * k / 256) for k in range(256)]
    grid = []
    for f in range(frames):
        part = [(payload[f * 128 + i] - 128) / 128 * window[i] if f * 128 + i < len(payload) else 0.0 for i in range(256)]
        grid.append([abs(sum(x * turn[k * i % 256] for i, x in enumerate(part))) for k in range(129)])
    at = lambda f, k: grid[f][k] if 0 <= f < frames else -1.0
    found = []
    for f in range(frames):
        tops = [k for k in range(1, 128) if (v := at(f, k)) > 1e-6 and v > at(f, k - 1) and v >= at(f, k + 1) and v >= at(f - 1, k) and v > at(f + 1, k)]
        found += [(f, k) for k in sorted(sorted(tops, key=lambda k: (-round(at(f, k), 6), k))[:3])]
    codes = []
    for j, (f, k) in enumerate(found):
        codes += [(f, k << 16 | l << 8 | g - f) for g, l in found[j + 1 : j + 4] if g - f <= 32]
    return sorted(codes)


def test_fingerprints_equal_a_plain_transform(spark):
    texts = [None, "", "a", "The quick brown fox jumps over the lazy dog. " * 9, "".join(chr(97 + i * i % 26) for i in range(900)), "żółć " * 60, "x" * 640]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in media.features(media.media(frame)).collect():
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert list(zip(r.fp_time, r.fp_code, strict=True)) == plain_fingerprint(payload), r.doc_id


# ---- neighbours: components far from one


@pytest.mark.parametrize("scale", [1e-300, 1e-170, 1.0, 1e200, 1e307])
def test_cosines_of_huge_and_tiny_vectors(spark, scale):
    plain = {0: [1.0, 0.5, 0.0], 1: [0.9, 0.6, 0.1], 2: [-1.0, 0.2, 0.3], 3: [0.0, 1.0, 1.0]}
    frame = spark.createDataFrame([(i, [x * scale for x in v]) for i, v in plain.items()], "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, frame.filter("vec_id = 0")).orderBy("rank").collect()
    norm = lambda v: math.sqrt(sum(x * x for x in v))
    want = sorted(((sum(x * y for x, y in zip(plain[0], v, strict=True)) / norm(plain[0]) / norm(v), i) for i, v in plain.items() if i), reverse=True)
    assert [r.vec_id for r in got] == [i for _, i in want]
    assert [r.score for r in got] == pytest.approx([s for s, _ in want], abs=1e-12)
