"""Writers (S7-S11, S13 helpers). Every sink writes a directory of part
files through the executors; nothing is collected to the driver."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write a table (S7). CSV gets a header; no index column exists."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_json_rows(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Report rows as JSON lines, UTF-8."""
    df.write.mode(mode).json(path)
    return path


EXPERIMENT_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("runtime_seconds", T.DoubleType()),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
    T.StructField("timestamp", T.TimestampType()),
])


def experiment_record(spark: SparkSession, experiment: str, model: str, params: dict,
                      metrics: dict, runtime_seconds: float, extra: dict | None = None) -> DataFrame:
    """One experiment row (S9): params as map<string,string>, metrics as
    map<string,double>, runtime rounded to 2 dp, a timestamp."""
    row = (
        experiment, model,
        {str(k): str(v) for k, v in params.items()},
        {str(k): float(v) for k, v in metrics.items()},
        round(float(runtime_seconds), 2),
        {str(k): str(v) for k, v in (extra or {}).items()},
        _dt.datetime.now(),
    )
    return spark.createDataFrame([row], EXPERIMENT_SCHEMA)


def _replace_partitions(df: DataFrame, path: str, keys: list[str]) -> str:
    """Write rows into the partitions of their ``keys``: the partitions that
    occur in ``df`` are replaced whole, all others stay as they are. New columns
    are allowed; readers merge the schemas of the partitions."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    return path


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """A metric or experiment store; columns that a partition lacks are null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def log_experiment(spark: SparkSession, table_path: str, experiment: str, model: str, params: dict,
                   metrics: dict, runtime_seconds: float, extra: dict | None = None) -> DataFrame:
    """The row of one run in the experiments table (S9). A run is told by
    experiment, model and parameters (``run``, a digest of them): running the
    same again replaces its row, other parameters add one."""
    rec = experiment_record(spark, experiment, model, params, metrics, runtime_seconds, extra)
    said = "\n".join(f"{k}={v}" for k, v in sorted(params.items()))
    _replace_partitions(rec.withColumn("run", F.md5(F.lit(said))), table_path, ["experiment", "model", "run"])
    return rec


def write_predictions(pred: DataFrame, path: str, fmt: str = "csv") -> str:
    """Prediction sink (S10): (id, sales) or (date, store_nbr, family,
    predicted_sales), ordered by its key at the sink only."""
    key = ["id"] if "id" in pred.columns else ["date", "store_nbr", "family"]
    return write_table(pred.orderBy(*key), path, fmt)


def append_metrics(metrics: DataFrame, path: str, model: str) -> str:
    """Metric sink (S11): the rows of ``model`` in one metrics table
    partitioned by model. A rerun replaces the model's own rows."""
    return _replace_partitions(metrics.withColumn("model", F.lit(model)), path, ["model"])
