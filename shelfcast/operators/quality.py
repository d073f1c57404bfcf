"""Data-quality profile and lineage.

A profile is one aggregate pass over a table: row count, missing count per
column (null, or NaN for floating columns) and the date range; duplicate key
rows (rows minus distinct key groups; null keys compare equal as in a group-by)
are a second aggregate that reads the key columns alone. Counters observed on
the writes of the tables would save the first pass, but a stage that runs again
after a lost executor counts its rows again, so they are not used. Results are long rows, so profiles of many tables union into one
report table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROFILE_SCHEMA = "section string, table_name string, metric string, column_name string, value bigint, text string"


def _missing(field: T.StructField):
    c = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.count_if(c.isNull() | F.isnan(c))
    return F.count_if(c.isNull())


def profile_table(df: DataFrame, keys: list[str] | None = None, section: str = "",
                  table_name: str = "") -> DataFrame:
    """Long profile rows: rows, columns (one row per column, in order),
    missing per column, duplicate_key_rows, date_min / date_max (A2)."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [_missing(f).alias(f"_m{i}") for i, f in enumerate(fields)]
    has_date = "date" in df.columns
    if has_date:
        aggs += [F.date_format(F.min("date"), "yyyy-MM-dd").alias("_dmin"),
                 F.date_format(F.max("date"), "yyyy-MM-dd").alias("_dmax")]
    stats = df.agg(*aggs)
    entries = [F.struct(F.lit("rows").alias("metric"), F.lit(None).cast("string").alias("column_name"),
                        F.col("_rows").cast("bigint").alias("value"), F.lit(None).cast("string").alias("text"))]
    for i, f in enumerate(fields):
        entries.append(F.struct(F.lit("column").alias("metric"), F.lit(f.name).alias("column_name"),
                                F.lit(i).cast("bigint").alias("value"), F.lit(None).cast("string").alias("text")))
        entries.append(F.struct(F.lit("missing").alias("metric"), F.lit(f.name).alias("column_name"),
                                F.col(f"_m{i}").cast("bigint").alias("value"),
                                F.lit(None).cast("string").alias("text")))
    if has_date:
        for m, c in (("date_min", "_dmin"), ("date_max", "_dmax")):
            entries.append(F.struct(F.lit(m).alias("metric"), F.lit("date").alias("column_name"),
                                    F.lit(None).cast("bigint").alias("value"), F.col(c).alias("text")))
    names = F.lit(section).alias("section"), F.lit(table_name).alias("table_name")
    out = stats.select(*names, F.inline(F.array(*entries)))
    if keys:
        repeats = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("_more")).agg(F.coalesce(F.sum("_more"), F.lit(0)).alias("_n"))
        out = out.unionByName(repeats.select(
            *names, F.lit("duplicate_key_rows").alias("metric"), F.lit(",".join(keys)).alias("column_name"),
            F.col("_n").cast("bigint").alias("value"), F.lit(None).cast("string").alias("text")))
    return out


# The keys each table is checked for.
RAW_KEYS = {"train": ["id"], "test": ["id"], "stores": ["store_nbr"], "oil": ["date"],
            "holidays": None, "transactions": ["date", "store_nbr"]}
CLEAN_KEYS = {"train": ["date", "store_nbr", "family"], "test": ["id"], "oil": ["date"],
              "holidays": None, "transactions": ["date", "store_nbr"],
              "holiday_features": ["date", "store_nbr"]}
OUTPUT_KEYS = ["date", "store_nbr", "family", "dataset_split"]


def quality_report(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame],
                   integrated: DataFrame, features: DataFrame, counters: DataFrame | None = None) -> DataFrame:
    """Profiles of the raw, cleaned and output tables as one long table (A3),
    with the cleaning counters appended as section ``transformations``."""
    parts = [profile_table(raw[k], v, "raw_tables", k) for k, v in RAW_KEYS.items() if k in raw]
    parts += [profile_table(cleaned[k], v, "cleaned_tables", k) for k, v in CLEAN_KEYS.items() if k in cleaned]
    parts.append(profile_table(integrated, OUTPUT_KEYS, "outputs", "integrated_dataset"))
    parts.append(profile_table(features, OUTPUT_KEYS, "outputs", "feature_dataset"))
    if counters is not None:
        parts.append(counters.select(
            F.lit("transformations").alias("section"), F.col("step").alias("table_name"), "metric",
            F.lit(None).cast("string").alias("column_name"), F.col("value").cast("bigint").alias("value"),
            F.lit(None).cast("string").alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Grain and keys of the sources.
LINEAGE_SOURCES = [
    ("train", "date x store_nbr x family", ["id"], ["date", "store_nbr", "family"]),
    ("test", "date x store_nbr x family", ["id"], ["date", "store_nbr", "family"]),
    ("stores", "store_nbr", ["store_nbr"], ["store_nbr"]),
    ("oil", "date", ["date"], ["date"]),
    ("holidays_events", "holiday/event record", [], ["date", "type", "locale", "locale_name", "description"]),
    ("transactions", "date x store_nbr", [], ["date", "store_nbr"]),
]

def lineage_steps() -> list[tuple[str, str]]:
    """(operator, what it does) of the feature run, from the operators' own
    docstrings."""
    from . import clean, features

    ran = (clean.standardize, clean.build_train_grid, clean.clean_oil, clean.clean_holidays,
           clean.build_holiday_store_features, clean.build_transactions_frame, features.integrate, features.build_features)
    return [(f.__name__, " ".join((f.__doc__ or "").split("\n\n")[0].split())) for f in ran]


LINEAGE_OUTPUTS = [
    ("integrated_dataset", "date x store_nbr x family x split"),
    ("feature_dataset", "date x store_nbr x family x split"),
    ("quality_report", "pipeline run"),
    ("lineage_metadata", "pipeline run"),
]


def lineage(spark: SparkSession, source_paths: dict[str, str], output_paths: dict[str, str]) -> DataFrame:
    """Lineage record as rows (kind, step, name, path, grain, primary_keys,
    business_keys, description) (S14). A fixed handful of rows."""
    schema = ("kind string, step int, name string, path string, grain string, primary_keys array<string>, "
              "business_keys array<string>, description string")
    rows = [("source", None, n, source_paths.get(n), g, pk, bk, None) for n, g, pk, bk in LINEAGE_SOURCES]
    rows += [("transformation", i + 1, name, None, None, None, None, s) for i, (name, s) in enumerate(lineage_steps())]
    rows += [("output", None, n, output_paths.get(n), g, None, None, None) for n, g in LINEAGE_OUTPUTS]
    return spark.createDataFrame(rows, schema)
