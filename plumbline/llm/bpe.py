"""BPE encoding that encodes passages shared across documents once.

Texts are cut into chunks where a rolling hash of their bytes says so, so equal passages give equal
chunks wherever they stand. Chunks are known by 128 bits of hash and counted over the corpus. A chunk that occurs once is
encoded where it is, together with its neighbours of that kind; a shared one is sent, once per batch,
to the task that encodes it, and its ids are joined back to every occurrence. Where two pieces meet,
the words at the seam are encoded again, over a window that grows until both of its ends lie at
white space, where this kind of tokenizer always cuts: from there on the ids agree exactly with
those of the whole text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, bit_map, frugal, marked, small_batches, written
from plumbline.llm.wordbpe import WordEncoder, word_encoder

#: Rolling hash: window of 16 bytes; a cut where its low bits are zero, at least LEAST and at most MOST bytes apart.
CUT_BITS, LEAST, MOST = 10, 256, 8192
#: Shared chunks are known by a bit of their hash in a map of 2^23 to 2^27 bits, at least PLACES for each: 16 MB at most.
#: A chunk that only shares the bit takes the longer way, with the same result.
MAP_BITS, MOST_MAP_BITS, PLACES = 23, 27, 16

#: White space to every tokenizer and Unicode version.
SPACE = re.compile(r"[ \t-\r]")

_BYTES = np.random.default_rng(5).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def cuts(raw: bytes) -> list[int]:
    """Ends of the chunks of a text in UTF-8; never inside a character."""
    n = len(raw)
    if n <= LEAST:
        return [n] if n else []
    data = np.frombuffer(raw, np.uint8)
    h = _BYTES[data]
    factor, width = 0x9E3779B1, 1
    while width < 16:  # the hash of a window from those of its halves
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width]
        h = h + shifted * np.uint32(factor)
        factor, width = factor * factor & 0xFFFFFFFF, width * 2
    ok = (h >> np.uint32(32 - CUT_BITS)) == 0
    ok[:-1] &= (data[1:] & 0xC0) != 0x80
    ends, last = [], 0
    for at in (np.flatnonzero(ok) + 1).tolist():
        while at - last > MOST:
            last = _boundary(data, last + MOST)
            ends.append(last)
        if at - last >= LEAST and n - at >= LEAST:
            ends.append(at)
            last = at
    while n - last > MOST:
        last = _boundary(data, last + MOST)
        ends.append(last)
    return [*ends, n]


def _boundary(data: np.ndarray, at: int) -> int:
    while data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def chunks(text: str) -> list[tuple[bytes, bytes]]:
    """(128-bit hash, bytes) of each chunk in order."""
    raw, start, out = text.encode("utf-8"), 0, []
    for end in cuts(raw):
        out.append((xxhash.xxh3_128_digest(raw[start:end]), raw[start:end]))
        start = end
    return out


def place(digest: bytes) -> int:
    """What chunks are counted by: 63 bits of the hash. Chunks that differ and agree in these only count as shared."""
    return int.from_bytes(digest[:8], "little") >> 1


def _shared_map(docs: DataFrame) -> np.ndarray:
    """Bit map of the places of chunks that occur more than once, built in pages by Spark."""

    def hashes(batches: Batches) -> Batches:
        for batch in batches:
            found = [place(h) for t in batch.column("text").to_pylist() if t for h, _ in chunks(t)]
            h, n = np.unique(np.array(found, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n, pa.int64())], names=["h", "n"])

    counted = written(docs.select("text").mapInArrow(frugal(hashes), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h"), "repeated")
    return bit_map(counted, PLACES, MAP_BITS, MOST_MAP_BITS)


class Seams:
    """Joins the ids of pieces of one text; a piece is (ids, text of its first and last fragment, their numbers of ids)."""

    def __init__(self, encoder: WordEncoder):
        self.encoder, self.ids, self.open = encoder, [], ""

    @staticmethod
    def fragments(text: str) -> tuple[str, str] | None:
        """What stands before the first and after the last white space; None if there is no white space."""
        first = SPACE.search(text)
        if first is None:
            return None
        return text[: first.start()], text[max(map(text.rfind, " \t\n\v\f\r")) + 1 :]

    def add(self, ids: bytes, head: str, tail: str | None, n_head: int, n_tail: int) -> None:
        if tail is None:  # no white space: the window goes on
            self.open += head
            return
        if self.open:
            self.ids += self.encoder.encode([self.open + head])
        elif n_head:
            self.ids.append(ids[: n_head * self.encoder.dtype.itemsize])
        self.ids.append(ids[n_head * self.encoder.dtype.itemsize : len(ids) - n_tail * self.encoder.dtype.itemsize])
        self.open = tail

    def end(self) -> bytes:
        out = b"".join([*self.ids, *self.encoder.encode([self.open] if self.open else [])])
        self.ids, self.open = [], ""
        return out


def encoded_pieces(encoder: WordEncoder, texts: list[str]) -> Iterator[tuple[bytes, str, str | None, int, int]]:
    """For each text what ``Seams.add`` takes."""
    ends = [Seams.fragments(t) for t in texts]
    flat = [x for t, e in zip(texts, ends, strict=True) for x in ([t, *e] if e else [])]
    got = iter(encoder.encode(flat))
    for text, e in zip(texts, ends, strict=True):
        if e is None:
            yield b"", text, None, 0, 0
        else:
            ids, head, tail = next(got), next(got), next(got)
            yield ids, e[0], e[1], len(head) // encoder.dtype.itemsize, len(tail) // encoder.dtype.itemsize


PIECE = [("uid", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int32()), ("h", pa.binary()), ("text", pa.string()), ("raw", pa.binary()), ("head", pa.string()), ("tail", pa.string()), ("n_head", pa.int32()), ("n_tail", pa.int32())]
PIECE_SCHEMA = "uid long, doc_id long, seq int, h binary, text string, raw binary, head string, tail string, n_head int, n_tail int"

Finish = Callable[[WordEncoder, bytes], tuple]


def ids_of(encoder: WordEncoder, raw: bytes) -> tuple:
    """The ids themselves."""
    return len(raw) // encoder.dtype.itemsize, encoder.ids(raw).astype(np.int32)


def digest_of(encoder: WordEncoder, raw: bytes) -> tuple:
    """Checksums of the ids and of the text that they decode to."""
    ids = encoder.ids(raw)
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(encoder.decode(raw).encode("utf-8")).hexdigest()


RESULTS: dict[str, tuple[Finish, list]] = {
    "ids": (ids_of, [("n_tokens", pa.int64(), "long"), ("ids", pa.list_(pa.int32()), "array<int>")]),
    "digests": (digest_of, [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")]),
}


def encode(docs: DataFrame, tokenizer: str, result: str = "ids") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens and the ``ids``, or the ``digests`` of ids and decoded text.

    Equal to the library's ``encode(text, add_special_tokens=False)`` without truncation or padding.
    Null texts are empty and have no ids. Repeated rows are rows of their own; an empty table gives
    an empty table; extra columns are ignored.
    """
    small_batches(docs.sparkSession)
    finish, columns = RESULTS[result]
    names, kinds = [c[0] for c in columns], [c[1] for c in columns]
    made = ", ".join(f"{c[0]} {c[2]}" for c in columns)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(_shared_map(docs))

    def tokenized(batches: Batches) -> Batches:
        encoder, bits = word_encoder(tokenizer), shared.value
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            whole, loose, sent = [], [], set()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                uid += 1
                cut = chunks(text or "")
                common = marked(bits, np.array([place(h) for h, _ in cut], np.int64)).tolist()
                cut = [(*c, known) for c, known in zip(cut, common, strict=True)]
                if not any(c[2] for c in cut):
                    whole.append((uid, doc_id, text or ""))
                    continue
                seq = 0
                for i, (h, raw, common) in enumerate(cut):
                    if common:
                        loose.append((uid, doc_id, seq, h, None if h in sent else raw.decode("utf-8")))
                        sent.add(h)
                        seq += 1
                    elif i and not cut[i - 1][2]:
                        loose[-1] = (*loose[-1][:4], loose[-1][4] + raw.decode("utf-8"))
                    else:
                        loose.append((uid, doc_id, seq, None, raw.decode("utf-8")))
                        seq += 1
            ready = [finish(encoder, raw) for raw in encoder.encode([w[2] for w in whole])]
            own = encoded_pieces(encoder, [x[4] for x in loose if x[3] is None])
            rows = [(*w[:2], *[None] * 8, *r) for w, r in zip(whole, ready, strict=True)]
            rows += [(*x[:3], None, None, *next(own), *[None] * len(names)) if x[3] is None else (*x, *[None] * (5 + len(names))) for x in loose]
            if rows:
                yield _batch(rows, [*PIECE, *zip(names, kinds, strict=True)])

    pieces = written(docs.mapInArrow(frugal(tokenized), f"{PIECE_SCHEMA}, {made}"), "pieces")

    def encoded(batches: Batches) -> Batches:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            rows = [(h, *p) for h, p in zip(batch.column("h").to_pylist(), encoded_pieces(encoder, batch.column("text").to_pylist()), strict=True)]
            yield _batch(rows, [PIECE[3], *PIECE[5:]])

    sent = pieces.filter("h is not null")
    once = written(sent.filter("text is not null").groupBy("h").agg(F.min("text").alias("text")).mapInArrow(frugal(encoded), "h binary, raw binary, head string, tail string, n_head int, n_tail int"), "shared")
    parts = ["uid", "doc_id", "seq", "raw", "head", "tail", "n_head", "n_tail"]
    joined = sent.select("uid", "doc_id", "seq", "h").join(once, "h").select(parts).unionByName(pieces.filter("h is null and seq is not null").select(parts))

    def repaired(batches: Batches) -> Batches:
        encoder = word_encoder(tokenizer)
        seams, last, out = Seams(encoder), None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in parts), strict=True):
                if last is not None and last[0] != row[0]:
                    out.append((last[1], *finish(encoder, seams.end())))
                last = row[:2]
                seams.add(*row[3:])
            if out:
                yield _batch(out, [PIECE[1], *zip(names, kinds, strict=True)])
                out = []
        if last is not None:
            yield _batch([(last[1], *finish(encoder, seams.end()))], [PIECE[1], *zip(names, kinds, strict=True)])

    mended = joined.repartition("uid").sortWithinPartitions("uid", "seq").mapInArrow(frugal(repaired), f"doc_id long, {made}")
    return pieces.filter("h is null and seq is null").select("doc_id", *names).unionByName(mended)


def _batch(rows: list[tuple], columns: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(columns)], names=[c[0] for c in columns])
