"""What the operators of this package share: reading, staging, batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

#: Rows of one Arrow batch between Spark and a Python worker. Texts average a
#: few kB and reach hundreds, so the default of 10,000 would hold tens of MB.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder of ``spark.checkpoint.dir``."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, so that
    lost executors cost no recomputation past this point."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """Tables that an operator needs until its result is written: one folder
    under the shared folder, dropped table by table or as a whole. Only paths
    that this object made are ever deleted."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.made = spark, scratch(spark, name), {}

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{len(self.made)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made[id(out)] = (out, path)
        return out

    def stage_parts(self, df: DataFrame, column: str, n: int, name: str) -> list[DataFrame]:
        """``df`` written in one go, split by the integer ``column`` (0 to n - 1,
        which goes): a table for each value, without a shuffle."""
        path = f"{self.path}/{name}-{len(self.made)}"
        df.write.partitionBy(column).parquet(path)
        schema = df.drop(column).schema
        # An empty part has no folder: it is read from the whole by its number.
        whole = self.spark.read.schema(df.schema).parquet(path)
        out = [whole.where(f"{column} = {k}").select(*schema.names) for k in range(n)]
        self.made[id(whole)] = (whole, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete the given tables of this workspace, or all of them."""
        paths = [self.made[id(t)][1] for t in tables] if tables else [self.path]
        for p in paths:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release_memory() -> None:
    """Give memory that is free within this process back to the system. Python
    workers serve one stage after the other, and what an earlier stage needed
    stays with them otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: What this worker keeps between tasks, by key, and the keys its task has asked for.
_KEPT: dict = {}
_ASKED: set = set()


def kept(key, make: Callable):
    """``make()``, made once for a row of tasks of this worker that ask for it.
    The first ``map_arrow`` task that does not lets it go: a vocabulary and its
    cache take more memory than most tasks, and a worker serves all stages."""
    if key not in _KEPT:
        _KEPT[key] = make()
    _ASKED.add(key)
    return _KEPT[key]


def _let_go() -> None:
    for key in [k for k in _KEPT if k not in _ASKED]:
        del _KEPT[key]
    _ASKED.clear()


def map_arrow(df: DataFrame, columns: list, schema: str, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` over ``columns``; ``fn`` yields dicts of column -> values
    (lists or numpy arrays) that are turned into batches of ``schema``."""
    picked = df.select(*columns)
    out = _schema(schema)

    def run(batches):
        _ASKED.clear()
        for part in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[f.name], type=f.type) for f in out], schema=out
            )
        part = None
        _let_go()
        release_memory()

    return picked.mapInArrow(run, schema)


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()),
    "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([pa.field(n, _ARROW[t]) for n, t in (x.strip().split(" ") for x in ddl.split(","))])


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def text_array(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts of a batch in Arrow; null counts as empty."""
    return batch.column(batch.schema.get_field_index(column)).fill_null("")


def joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches in order, short ones put together up to about ``size`` bytes.
    While one is in use, the short ones are gone already."""
    held, n = [], 0
    for b in batches:
        if held and n + b.nbytes > size:
            held, n = [pa.concat_batches(held)], 0
            yield held.pop()
        held.append(b)
        n += b.nbytes
    b = None
    if held:
        held = [pa.concat_batches(held)]
        yield held.pop()


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def fold(key: str, n: int):
    """crc32 of a column's decimal text, mod n: the folds of the label rules."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def split_u64(values: np.ndarray, n: int) -> np.ndarray:
    """Bucket 0..n-1 of each 64-bit hash, from its high bits."""
    return ((values >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


#: Ids that a filter drops are broadcast up to this many (16 MB); beyond it they
#: meet the documents by a shuffle.
BROADCAST_IDS = 1_000_000


def without_ids(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``dropped`` (staged, one
    column ``doc_id``). Rows with a null doc_id stay."""
    ids = dropped.where("doc_id IS NOT NULL").distinct()
    if dropped.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_anti").select(*docs.columns)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name
