"""Token files: shards of raw ids under a minimal perfect hash index.

``write`` encodes whole texts, orders them by doc_id and writes a folder of two
tables. ``shards`` has a row for each shard, of about ``shard_bytes`` of raw
ids: the payload (unsigned 16-bit little-endian ids, 32-bit if the vocabulary
is larger), the distinct keys in order, and the index, which maps a key to a
slot without collisions (compress, hash, displace) and stores for each slot the
key's fingerprint, offset, and number of documents. ``parts`` has the count of
ids of each range partition, from which a shard's place in the whole is found.
A key is found in constant time: its bucket's displacement gives the slot, the
fingerprint turns away keys that were never written.

Spark's own writer commits the files, so lost executors leave no partial shard
and the folder may lie in any store that Spark writes to.

Defined cases: a null or empty text is its end id alone. Rows with a null
``doc_id`` have no key and are not written. Rows that share a doc_id are written
side by side, in the order of their texts, under one key, and each comes back.
Further columns are ignored, whatever their names. An empty table gives no
shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import column, joined, map_arrow, scratch, text_array
from .tokens import BLOCK, encoder

SHARD_BYTES = 4 << 20
SHARD = (
    "part long, seg long, start_in_part long, n_ids long, width int, payload binary, doc_ids binary, "
    "seeds binary, prints binary, slots binary, lengths binary"
)


def mix(keys: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    """64-bit hashes of 64-bit keys, by one seed or a seed for each."""
    with np.errstate(over="ignore"):
        seed = np.asarray(seed).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
        x = keys.astype(np.uint64) + seed
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements of the buckets, and the slot of each of the distinct keys:
    0 .. n-1, each once. A bucket of one key takes a slot that is left at the
    end, and has it as its displacement, as -1 - slot."""
    n = len(keys)
    m = max(1, n // 3)
    bucket = (mix(keys, 1) % np.uint64(m)).astype(np.int64)
    seeds, slots, free = np.zeros(m, np.int32), np.zeros(n, np.int64), np.ones(n, bool)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=m)
    ends = np.cumsum(sizes)
    for b in np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes > 1)].tolist():
        members = order[ends[b] - sizes[b] : ends[b]]
        seed, tries, found = 2, 16, None
        while found is None:
            at = (mix(keys[members], np.arange(seed, seed + tries)[:, None]) % np.uint64(n)).astype(np.int64)
            fits = np.flatnonzero(free[at].all(axis=1)).tolist()
            found = next((t for t in fits if len(set(at[t].tolist())) == len(members)), None)
            if found is None:
                seed, tries = seed + tries, min(2 * tries, 1024)
        seeds[b], slots[members], free[at[found]] = seed + found, at[found], False
    single = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(free)
    seeds[single], slots[order[ends[single] - 1]] = -1 - left, left
    return seeds, slots


def make_shard(rows: list[tuple[int, bytes]], part: int, seg: int, start: int, width: int) -> dict:
    """One shard of (doc_id, ids as 32-bit bytes) in ascending order."""
    doc_ids = np.array([d for d, _ in rows], np.int64)
    keys, first, times = np.unique(doc_ids, return_index=True, return_counts=True)
    seeds, slots = build_index(keys)
    lengths = np.array([len(x) // 4 for _, x in rows], np.int64)
    place = np.zeros((len(keys), 3), np.int64)  # by slot: offset, first row, rows
    place[slots] = np.stack([(lengths.cumsum() - lengths)[first], first, times], 1)
    prints = np.zeros(len(keys), np.uint32)
    prints[slots] = mix(keys, 0) >> np.uint64(32)
    ids = np.frombuffer(b"".join(x for _, x in rows), "<u4")
    return {
        "part": part, "seg": seg, "start_in_part": start, "n_ids": len(ids), "width": width,
        "payload": ids.astype(f"<u{width}").tobytes(), "doc_ids": keys.astype("<i8").tobytes(),
        "seeds": seeds.astype("<i4").tobytes(), "prints": prints.astype("<u4").tobytes(),
        "slots": place.astype("<i8").tobytes(), "lengths": lengths.astype("<i8").tobytes(),
    }


class Shard:
    """Keyed access to one shard row."""

    def __init__(self, row: dict):
        self.doc_ids = np.frombuffer(row["doc_ids"], "<i8")
        self.seeds, self.prints = np.frombuffer(row["seeds"], "<i4"), np.frombuffer(row["prints"], "<u4")
        self.slots = np.frombuffer(row["slots"], "<i8").reshape(-1, 3)
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.ids = np.frombuffer(row["payload"], f"<u{row['width']}")

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1 if its fingerprint is not there."""
        n = len(self.prints)
        if not n:
            return np.full(len(keys), -1)
        seeds = self.seeds[(mix(keys, 1) % np.uint64(len(self.seeds))).astype(np.int64)]
        at = np.where(seeds < 0, -1 - seeds.astype(np.int64), (mix(keys, seeds) % np.uint64(n)).astype(np.int64))
        return np.where(self.prints[at] == (mix(keys, 0) >> np.uint64(32)).astype(np.uint32), at, -1)

    def find(self, keys: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(key, offset, ids) of each document under each key that is there."""
        for key, at in zip(keys.tolist(), self.slot(keys).tolist()):
            if at < 0:
                continue
            offset, first, times = self.slots[at].tolist()
            for n in self.lengths[first : first + times].tolist():
                yield key, offset, self.ids[offset : offset + n]
                offset += n


def write(docs: DataFrame, path: str, vocabulary: str, byte_level: bool = True, end_id: int = 2, vocabulary_size: int = 65_536, shard_bytes: int = SHARD_BYTES) -> str:
    """Write the token files of ``docs`` under ``path``."""
    spark = docs.sparkSession
    width = 2 if vocabulary_size <= 65_536 else 4
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = (
        docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
        .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    )

    def run(batches):
        enc, end = encoder(vocabulary, byte_level), np.array([end_id], "<u4").tobytes()
        part, seg, start, rows, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def flush():
            shard = make_shard(rows, part, seg, start, width)
            return shard["n_ids"], {k: [v] for k, v in shard.items()}

        for b in joined(batches, BLOCK):
            for doc, ids in zip(column(b, "doc_id"), enc.encode(text_array(b))):
                # Documents that share a key stay in one shard.
                if size >= 2 * shard_bytes and doc != rows[-1][0]:
                    n, out = flush()
                    yield out
                    seg, start, rows, size = seg + 1, start + n, [], 0
                rows.append((doc, ids + end))
                size += len(ids) + 4
        if rows:
            yield flush()[1]

    map_arrow(ordered, ["doc_id", "text"], SHARD, run).write.parquet(f"{path}/shards")
    shards = spark.read.parquet(f"{path}/shards")
    shards.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).write.parquet(f"{path}/parts")
    return path


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the count of ids before them. One number for
    each range partition (a few thousand rows) passes through the driver."""
    totals = sorted((r.part, r.n_ids) for r in spark.read.parquet(f"{path}/parts").collect())
    before, rows = 0, []
    for part, n in totals:
        rows.append((part, before))
        before += n
    starts = spark.createDataFrame(rows, "part long, part_start long")
    shards = spark.read.parquet(f"{path}/shards")
    return shards.join(F.broadcast(starts), "part").withColumn("start", F.col("part_start") + F.col("start_in_part"))


_SHARD_COLUMNS = ["start", *(c.split()[0] for c in SHARD.split(", ") if c.split()[0] not in ("part", "seg", "start_in_part", "n_ids"))]


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, each fetched
    through the index by its key."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                shard, out = Shard(row), {n: [] for n in ("doc_id", "start", "n_tokens", "ids_crc32")}
                for key, offset, ids in shard.find(shard.doc_ids):
                    out["doc_id"].append(key)
                    out["start"].append(row["start"] + offset)
                    out["n_tokens"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield out

    return map_arrow(_placed(spark, path), _SHARD_COLUMNS, "doc_id long, start long, n_tokens long, ids_crc32 long", run)


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """doc_id, start and ids of the given keys. Shards whose key range misses
    every asked key are skipped; keys that were not written give no row."""
    asked = np.unique(np.array(keys, np.int64))

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                shard, out = Shard(row), {n: [] for n in ("doc_id", "start", "ids")}
                lo, hi = np.searchsorted(asked, [shard.doc_ids[0], shard.doc_ids[-1] + 1])
                for key, offset, ids in shard.find(asked[lo:hi]):
                    out["doc_id"].append(key)
                    out["start"].append(row["start"] + offset)
                    out["ids"].append(ids.astype(np.int64))
                yield out

    return map_arrow(_placed(spark, path), _SHARD_COLUMNS, "doc_id long, start long, ids array<long>", run)


def write_and_read(docs: DataFrame, vocabulary: str, **how) -> DataFrame:
    spark = docs.sparkSession
    return read(spark, write(docs, scratch(spark, "token-files"), vocabulary, **how))
