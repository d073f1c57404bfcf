"""Readers for the six sources and the derived tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .adapter import Sources
from .schemas import RAW_SCHEMAS

DEFAULT_FILES = {
    "train": "train.csv",
    "test": "test.csv",
    "stores": "stores.csv",
    "oil": "oil.csv",
    "holidays": "holidays_events.csv",
    "transactions": "transactions.csv",
}


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """One source with an explicit schema. CSV is read with a header, empty
    fields as null, and FAILFAST so a malformed row stops the job instead of
    being silently dropped."""
    if fmt == "csv":
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("nullValue", "")
            .option("dateFormat", "yyyy-MM-dd")
            .csv(path)
        )
    return spark.read.schema(schema).format(fmt).load(path)


def read_sources(spark: SparkSession, base_dir: str, fmt: str = "csv",
                 files: dict[str, str] | None = None) -> Sources:
    """The six raw sources from ``base_dir``."""
    names = dict(DEFAULT_FILES)
    names.update(files or {})
    base = base_dir.rstrip("/")
    tables = {k: read_table(spark, f"{base}/{names[k]}", RAW_SCHEMAS[k], fmt) for k in RAW_SCHEMAS}
    return Sources(**tables)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: StructType | None = None) -> DataFrame | None:
    """A table that may be absent: None when the path does not exist."""
    try:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True)
        df = reader.load(path)
        df.schema  # resolve now so a missing path surfaces here
        return df
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


def read_feature_table(spark: SparkSession, path: str, columns: list[str] | None = None,
                       split: str | None = None) -> DataFrame:
    """Feature table scan with optional column pruning and split filter.
    Types persist in Parquet, so no repair step is needed."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.where(F.col("dataset_split") == split)
    if columns:
        df = df.select(*columns)
    return df


def head_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First n rows in a stable order (S4): the limit is the feature."""
    return df.orderBy(*order).limit(n)


def metrics_for_model(metrics: DataFrame, model: str) -> DataFrame:
    """Metric rows of one model from the shared metrics table."""
    return metrics.where(F.col("model") == model)
