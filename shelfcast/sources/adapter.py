"""Adapter views: the benchmark's TPC-H-like tables seen as the six retail
sources (train, test, stores, oil, holidays, transactions).

Every view is a lazy DataFrame over the given Parquet tables, so its work grows
with them. Column pruning and date predicates reach the Parquet scans.

Mapping (one row per store-day-family is an *observed* sale):
  train         lineitem x supplier x part, date = ship date, store = supplier
                nation, family = part type; sales = sum(quantity),
                onpromotion = lines with discount >= 0.05; the last TEST_DAYS
                days are held out
  test          held-out days x train stores x train families; onpromotion from
                the actuals or 0 (actual sales kept aside in ``test_actuals``)
  stores        nation x region
  oil           orders per weekday: average order price in thousands (whole),
                missing on the 13th of each month
  transactions  distinct orders per (ship date, supplier nation), sparse
  holidays      generated from the distinct order dates (national, regional,
                local rules below)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import checked_broadcast

# --- fixed values (must stay as they are for results to match) -------------
FAMILIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
HOLIDAY_TYPES = ["Holiday", "Event", "Additional", "Bridge", "Work Day", "Transfer"]
TEST_DAYS = 16
ID_EPOCH = "1992-01-01"
PROMO_DISCOUNT = 0.05
CLUSTER_MODULUS = 17
NATIONAL_LOCALE_NAME = "World"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Sources:
    train: DataFrame
    test: DataFrame
    stores: DataFrame
    oil: DataFrame
    holidays: DataFrame
    transactions: DataFrame
    test_actuals: DataFrame | None = None
    # test rows together with their held-out sales (adapter only)
    test_full: DataFrame | None = None

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "train": self.train,
            "test": self.test,
            "stores": self.stores,
            "oil": self.oil,
            "holidays": self.holidays,
            "transactions": self.transactions,
        }


# Types of the benchmark columns the views read. Declaring them lets the
# reader skip its per-table schema-inference job; the scan still reads only
# these columns.
COLUMN_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_quantity": "double",
    "l_discount": "double", "l_shipdate": "timestamp_ntz",
    "s_suppkey": "bigint", "s_nationkey": "int",
    "p_partkey": "bigint", "p_type": "string",
    "n_nationkey": "int", "n_name": "string", "n_regionkey": "int",
    "r_regionkey": "int", "r_name": "string",
    "o_orderdate": "timestamp_ntz", "o_totalprice": "double",
}


def _table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    ddl = ", ".join(f"{c} {COLUMN_TYPES[c]}" for c in cols)
    return spark.read.schema(ddl).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _family_ordinal(family: Column) -> Column:
    return F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), family) - 1


def row_id(date: Column, store_nbr: Column, family: Column) -> Column:
    """Deterministic id of a (date, store, family) row: slots for 1,000 families
    and 1,000,000 stores a day. A family outside the list, or a store beyond its
    slot, fails instead of sharing an id."""
    ordinal, store = _family_ordinal(family), store_nbr.cast("bigint")
    return (
        F.datediff(date, F.lit(ID_EPOCH).cast("date")).cast("bigint") * 1_000_000_000
        + F.when((store >= 0) & (store < 1_000_000), store).otherwise(F.raise_error(F.lit("store number outside 0..999999"))) * 1000
        + F.when(ordinal >= 0, ordinal).otherwise(F.raise_error(F.concat(F.lit("unknown family: "), F.coalesce(family, F.lit("null")))))
    ).cast("bigint")


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed (date, store_nbr, family) sales before the train/test cut.

    The supplier/part lookups are plain equi-joins: Spark broadcasts them when
    their scanned size is under the broadcast threshold and sort-merges
    otherwise. The aggregate combines map-side, so a hot store or family is
    reduced before the shuffle."""
    lines = _table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_quantity",
                   "l_discount", "l_shipdate")
    supplier = _table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    part = _table(spark, sf_dir, "part", "p_partkey", "p_type")
    joined = (
        lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .join(part, lines.l_partkey == part.p_partkey)
    )
    return joined.groupBy(
        F.to_date("l_shipdate").alias("date"),
        F.col("s_nationkey").cast("int").alias("store_nbr"),
        F.col("p_type").alias("family"),
    ).agg(
        F.sum("l_quantity").alias("sales"),
        F.count_if(F.col("l_discount") >= PROMO_DISCOUNT).cast("int").alias("onpromotion"),
    )


def _cutoff(daily: DataFrame) -> DataFrame:
    """One row: last observed date and the last training date."""
    return daily.agg(F.max("date").alias("_max_date")).select(
        "_max_date", F.date_sub("_max_date", TEST_DAYS).alias("_cutoff")
    )


def train_view(daily: DataFrame, cutoff: DataFrame) -> DataFrame:
    return (
        daily.crossJoin(F.broadcast(cutoff))  # one row
        .where(F.col("date") <= F.col("_cutoff"))
        .select(
            row_id(F.col("date"), F.col("store_nbr"), F.col("family")).alias("id"),
            "date", "store_nbr", "family",
            F.col("sales").cast("double").alias("sales"),
            "onpromotion",
        )
    )


def _test_frame(daily: DataFrame, cutoff: DataFrame) -> DataFrame:
    train_part = daily.crossJoin(F.broadcast(cutoff)).where(F.col("date") <= F.col("_cutoff"))
    # TEST_DAYS rows: a proven size bound, so the spine is broadcast.
    days = cutoff.select(
        F.explode(F.sequence(F.date_add("_cutoff", 1), F.col("_max_date"))).alias("date")
    )
    stores = train_part.select("store_nbr").distinct()
    families = train_part.select("family").distinct()
    # row_id fails on a family outside FAMILIES, so there are at most that many
    grid = stores.crossJoin(F.broadcast(families)).crossJoin(F.broadcast(days))
    actual = daily.select("date", "store_nbr", "family",
                          F.col("sales").alias("_sales"), F.col("onpromotion").alias("_promo"))
    return grid.join(actual, ["date", "store_nbr", "family"], "left").select(
        row_id(F.col("date"), F.col("store_nbr"), F.col("family")).alias("id"),
        "date", "store_nbr", "family",
        F.coalesce(F.col("_promo"), F.lit(0)).cast("int").alias("onpromotion"),
        F.coalesce(F.col("_sales"), F.lit(0.0)).cast("double").alias("sales"),
    )


def stores_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("store_nbr"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.chr(F.col("n_regionkey") + 65).alias("type"),
        (F.col("n_nationkey") % CLUSTER_MODULUS).cast("int").alias("cluster"),
    )


def oil_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders", "o_orderdate", "o_totalprice")
    per_day = (
        orders.groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("_cents"),
            F.count(F.lit(1)).alias("_n"),
        )
        .where(F.weekday("date") < 5)
    )
    # Whole units of the average order price in thousands: integer arithmetic
    # keeps it exact on every engine, so interpolated and averaged prices have
    # no rounding ties at 6 decimals.
    price = F.expr("cast(_cents div (_n * 100000) as double)")
    return per_day.select(
        "date",
        F.when(F.dayofmonth("date") == 13, F.lit(None).cast("double")).otherwise(price).alias("dcoilwtico"),
    )


def transactions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_shipdate")
    supplier = _table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    return (
        lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .groupBy(F.to_date("l_shipdate").alias("date"), F.col("s_nationkey").cast("int").alias("store_nbr"))
        .agg(F.count_distinct("l_orderkey").cast("double").alias("transactions"))
    )


def holidays_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = (
        _table(spark, sf_dir, "orders", "o_orderdate")
        .select(F.to_date("o_orderdate").alias("date"))
        .distinct()
    )
    types = F.array(*[F.lit(t) for t in HOLIDAY_TYPES])
    month = F.month("date")
    national = dates.where(F.dayofmonth("date") == 1).select(
        "date",
        F.element_at(types, (month - 1) % 6 + 1).alias("type"),
        F.lit("National").alias("locale"),
        F.lit(NATIONAL_LOCALE_NAME).alias("locale_name"),
        F.concat(F.lit("N "), month.cast("string")).alias("description"),
        (F.year("date") % 3 == 0).alias("transferred"),
    )
    region = _table(spark, sf_dir, "region", "r_regionkey", "r_name")
    # region and nation are dimension tables; broadcast behind a counted bound
    regional = dates.join(checked_broadcast(region), F.dayofmonth("date") == region.r_regionkey + 1).select(
        "date",
        F.element_at(types, month % 6 + 1).alias("type"),
        F.lit("Regional").alias("locale"),
        F.col("r_name").alias("locale_name"),
        F.concat(F.lit("  R  "), F.col("r_name")).alias("description"),
        (month == 12).alias("transferred"),
    )
    nation = _table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    local = (
        dates.where(month % 4 == 0)
        .join(checked_broadcast(nation), F.dayofmonth("date") == nation.n_nationkey % 28 + 1)
        .select(
            "date",
            F.lit("Holiday").alias("type"),
            F.lit("Local").alias("locale"),
            F.col("n_name").alias("locale_name"),
            F.concat(F.lit("L "), F.col("n_name")).alias("description"),
            F.lit(False).alias("transferred"),
        )
    )
    return national.unionByName(regional).unionByName(local)


def load_sources(spark: SparkSession, sf_dir: str, persist: bool = True) -> Sources:
    """The six raw sources (plus the held-out actuals) over ``sf_dir``.

    The daily aggregate feeds train, test and the cut date; ``persist`` keeps
    it (memory, spilling to disk) so those views read it instead of
    re-aggregating lineitem. Jobs submitted side by side over it share its
    one shuffle stage. Lost blocks are recomputed from lineage."""
    daily = daily_sales(spark, sf_dir)
    if persist:
        daily = daily.persist(StorageLevel.MEMORY_AND_DISK)
    cutoff = _cutoff(daily)
    test_full = _test_frame(daily, cutoff)
    return Sources(
        train=train_view(daily, cutoff),
        test=test_full.drop("sales"),
        stores=stores_view(spark, sf_dir),
        oil=oil_view(spark, sf_dir),
        holidays=holidays_view(spark, sf_dir),
        transactions=transactions_view(spark, sf_dir),
        test_actuals=test_full.select("id", "date", "store_nbr", "family", "sales"),
        test_full=test_full,
    )
