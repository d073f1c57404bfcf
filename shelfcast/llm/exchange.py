"""Shuffles of integer columns as blobs: many small rows travel as few large
ones, sorted and with only the bytes that vary, so that a shuffle of hashes
costs a few bytes for each instead of a row."""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import column, map_arrow

#: Rows that a task gathers before it sends them on.
FLUSH_ROWS = 1_000_000


def encode(*columns: np.ndarray) -> bytes:
    """Unsigned 64-bit columns of equal length; the first is in ascending order
    and travels as differences."""
    out = [struct.pack("<I", len(columns[0]))]
    for i, col in enumerate(columns):
        col = col.astype(np.uint64)
        if i == 0 and len(col):
            col = np.concatenate([col[:1], np.diff(col)])
        width = max(1, (int(col.max(initial=0)).bit_length() + 7) // 8)
        planes = np.ascontiguousarray(col.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
        out.append(bytes([width]) + planes.tobytes())
    return b"".join(out)


def decode(blob: bytes, n_columns: int) -> list[np.ndarray]:
    n, at, out = struct.unpack_from("<I", blob)[0], 4, []
    for i in range(n_columns):
        width = blob[at]
        planes = np.frombuffer(blob, np.uint8, width * n, at + 1).reshape(width, n)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = planes.T
        col = wide.view("<u8").reshape(n)
        out.append(np.cumsum(col, dtype=np.uint64) if i == 0 else col)
        at += 1 + width * n
    return out


def by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> dict[str, list]:
    """Rows (bucket, blob) of columns sorted by the first; ``bucket`` ascends
    with the first column."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    lows, highs = [0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]
    spans = [(lo, hi) for lo, hi in zip(lows, highs) if hi > lo]
    return {
        "bucket": [int(bucket[lo]) for lo, _ in spans],
        "blob": [encode(*(c[lo:hi] for c in columns)) for lo, hi in spans],
    }


def gather(dealt: DataFrame, parts: int, schema: str, fn: Callable, flush: Callable | None = None) -> DataFrame:
    """``fn(bucket, blobs)`` yields batches for each bucket of ``dealt``, with all
    blobs of the bucket in one task; ``parts`` tasks. With ``flush``, it yields
    tuples of arrays instead, and ``flush(tuples)`` makes a batch of what the
    task has gathered, so that a task sends a blob to each bucket, not one for
    each pair of buckets."""

    def run(batches):
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for bucket, blob in zip(column(b, "bucket"), column(b, "blob")):
                held.setdefault(bucket, []).append(blob)
        ready, size = [], 0
        for bucket in sorted(held):
            for out in fn(bucket, held.pop(bucket)):
                if flush is None:
                    yield out
                    continue
                ready.append(out)
                size += len(out[0])
                if size >= FLUSH_ROWS:
                    yield flush(ready)
                    ready, size = [], 0
        if ready:
            yield flush(ready)

    # Buckets are numbered 0 .. parts - 1 or more; each goes to the task of its number.
    return map_arrow(dealt.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")), ["bucket", "blob"], schema, run)


def task_count(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
