"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Configuration every job in this library is written against. Values that
# depend on data size (shuffle partitions, file split size) are parameters so a
# cluster deployment can size them to the input; AQE coalesces small shuffles
# and splits skewed partitions at run time either way.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "shelfcast",
    shuffle_partitions: int = 8,
    driver_memory: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Use the session's checkpoint folder; only when it is unset on a local
    master (local runs and tests) set a fresh scratch folder. Never overrides
    a cluster setting, and never points a cluster at a machine-local folder:
    on a cluster without the setting the result is None, and ``stage`` raises."""
    current = checkpoint_dir(spark)
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        return None
    if fallback is None:
        fallback = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the checkpoint folder and
    reading it back. The written table survives executor loss, unlike cached
    blocks. A cluster has to name the shared folder in spark.checkpoint.dir."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{base.rstrip('/')}/stage-{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_bucketed(df: DataFrame, name: str, keys: list[str], order: list[str]) -> DataFrame:
    """Like ``stage``, as a table bucketed by ``keys`` and sorted by ``keys`` and
    ``order`` in each bucket: operators that partition by the keys read it
    without an exchange. There are as many buckets as shuffle partitions. The
    files are under the checkpoint folder; the catalog entry is the session's."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"stage_{name}_{uuid.uuid4().hex[:12]}"
    # Dealt by the keys first, so that a task writes whole buckets.
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", f"{base.rstrip('/')}/{table}").saveAsTable(table)
    return spark.table(table)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark
    context. Functions that run inside tasks are pickled by reference, so a
    worker started from another folder has to be able to import them."""
    sc = spark.sparkContext
    if getattr(sc, "_shelfcast_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="shelfcast-zip-"), "shelfcast.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._shelfcast_shipped = True


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, in any store that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def input_version(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the tables in ``folder`` (and of their parts),
    in any store that Spark reads: changes when the input does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for table in fs.listStatus(path):
        parts = fs.listStatus(table.getPath()) if table.isDirectory() else [table]
        out += [(p.getPath().toString(), p.getLen(), p.getModificationTime()) for p in parts]
    return tuple(sorted(out))
