"""Media columns: 8-bit WAV files in a binary column, with spectral-peak pair fingerprints read from them."""

from __future__ import annotations

import hashlib
import io
import struct
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, shared_path, small_batches

UNIT = 64
RATE = 8000
FRAME, HOP = 256, 128
#: Frames transformed at a time, so a long file needs bounded memory.
BLOCK = 4096
#: Peaks kept per frame, partners per peak, and the farthest partner in frames.
PEAKS, FAN, REACH = 3, 3, 32


def pack(payload: bytes) -> bytes:
    """A mono WAV file whose unsigned 8-bit samples are the bytes, zero-filled to a positive multiple of 64."""
    payload += bytes(-len(payload) % UNIT or (0 if payload else UNIT))
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(RATE)
        f.writeframes(payload)
    return out.getvalue()


def unpack(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as f:
        return f.readframes(f.getnframes())


def _magnitudes(samples: np.ndarray, first: int, last: int) -> np.ndarray:
    """Short-time spectrum of the frames first..last-1; frames past the end are zero-filled."""
    need = samples[first * HOP : (last - 1) * HOP + FRAME]
    padded = np.zeros((last - 1 - first) * HOP + FRAME)
    padded[: len(need)] = (need.astype(np.float64) - 128) / 128
    frames = np.lib.stride_tricks.sliding_window_view(padded, FRAME)[::HOP]
    return np.abs(np.fft.rfft(frames * np.hanning(FRAME), axis=1))


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Time and frequency bin of the strongest local maxima of the spectrogram, in time order."""
    n = max(1, -(-(len(samples) - FRAME) // HOP) + 1)
    times, bins = [], []
    for first in range(0, n, BLOCK):
        last = min(n, first + BLOCK)
        lo, hi = max(0, first - 1), min(n, last + 1)  # a frame on either side, to compare with
        m = _magnitudes(samples, lo, hi)
        side = np.full((1, m.shape[1]), -1.0)
        m = np.concatenate([side] * (lo == first) + [m] + [side] * (hi == last))
        mid = m[1:-1, 1:-1]
        top = (mid > m[1:-1, :-2]) & (mid >= m[1:-1, 2:]) & (mid >= m[:-2, 1:-1]) & (mid > m[2:, 1:-1]) & (mid > 1e-6)
        strength = np.where(top, np.round(mid, 6), 0.0)
        best = np.argsort(-strength, axis=1, kind="stable")[:, :PEAKS]
        best.sort(axis=1)
        rows = np.repeat(np.arange(first, last), best.shape[1])
        kept = np.take_along_axis(strength, best, 1).ravel() > 0
        times.append(rows[kept])
        bins.append(best.ravel()[kept] + 1)
    return np.concatenate(times), np.concatenate(bins)


def pairs(times: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each peak with the next ones in reach: its time, and both bins and the distance in one code."""
    at, codes = [], []
    for step in range(1, FAN + 1):
        gap = times[step:] - times[:-step]
        ok = gap <= REACH
        at.append(times[:-step][ok])
        codes.append((bins[:-step][ok] << 16 | bins[step:][ok] << 8 | gap[ok]))
    at, codes = np.concatenate(at), np.concatenate(codes)
    order = np.lexsort((codes, at))
    return at[order].astype(np.int32), codes[order].astype(np.int32)


def media(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, media)``: each text's UTF-8 as a WAV file in a binary column.

    A null text is an empty one, and an empty one is 64 zero samples. Repeated rows stay; an empty
    table gives an empty table; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            raw = [(t or "").encode("utf-8") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(r) for r in raw], pa.int64()), pa.array(map(pack, raw), pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def stored(docs: DataFrame) -> DataFrame:
    """The table of ``media``, written as Parquet to the shared folder and read back."""
    spark = docs.sparkSession
    path = shared_path(spark, "media")
    made = media(docs)
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def features(stored: DataFrame) -> DataFrame:
    """What is read back from a media column: sizes, checksums and the fingerprint arrays.

    ``fp_time`` holds frame numbers and ``fp_code`` the peak pair that starts there; ``feature`` is
    their count and digest. A file without a peak has empty arrays. A null file is an empty text's.
    """
    small_batches(stored.sparkSession)
    names = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "fp_time": pa.list_(pa.int32()), "fp_code": pa.list_(pa.int32())}

    def read(data: bytes) -> tuple:
        payload = unpack(data)
        at, codes = pairs(*peaks(np.frombuffer(payload, np.uint8)))
        digest = hashlib.md5(at.astype("<i4").tobytes() + codes.astype("<i4").tobytes()).hexdigest()
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), f"{len(codes)}:{digest}", at, codes

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = [read(x if x is not None else pack(b"")) for x in batch.column("media").to_pylist()]
            cols = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(c, t) for c, t in zip(cols, names.values(), strict=True))], names=["doc_id", "n_bytes", *names])

    return stored.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, fp_time array<int>, fp_code array<int>")


def header(media_bytes: bytes) -> tuple[int, int]:
    """Sample rate and number of samples of a stored file, from its header alone."""
    return struct.unpack("<I", media_bytes[24:28])[0], struct.unpack("<I", media_bytes[40:44])[0]
