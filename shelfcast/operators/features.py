"""Integration and feature derivation.

The panel is the large side of every join here; stores, oil and the
store-day table are dimension-sized. Transactions and holiday features share
the (date, store_nbr) key, so they are combined first and joined to the panel
once: one shuffle of the panel instead of two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..functions.text import pipe_piece_count
from .clean import HOLIDAY_FLAGS, Cleaned
from .common import checked_broadcast, one_row

# Join keys and output columns in order.
JOIN_KEYS = ["date", "store_nbr", "family"]

HOLIDAY_FILL_ZERO = ["holiday_count", "is_national_holiday", "is_regional_holiday",
                     "is_local_holiday", *HOLIDAY_FLAGS]

INTEGRATED_COLUMNS = [
    "date", "store_nbr", "family", "id", "sales", "onpromotion", "dataset_split", "is_generated_row",
    "city", "state", "type", "cluster",
    "oil_price", "oil_missing_original", "oil_price_change_1", "oil_price_ma_7", "oil_price_ma_28",
    "transactions", "transactions_missing_original",
    *HOLIDAY_FILL_ZERO, "holiday_names",
    "promo_active",
]

FEATURE_COLUMNS = [
    "id", "date", "dataset_split", "store_nbr", "family", "store_family_key", "sales",
    "onpromotion", "promo_active", "transactions", "transactions_missing_original",
    "oil_price", "oil_missing_original", "oil_price_change_1", "oil_price_ma_7", "oil_price_ma_28",
    "city", "state", "type", "cluster",
    "holiday_count", "holiday_name_count", "holiday_names",
    "is_national_holiday", "is_regional_holiday", "is_local_holiday",
    "is_holiday", "is_event", "is_additional", "is_bridge", "is_work_day",
    "year", "quarter", "month", "day", "day_of_week", "day_of_year", "week_of_year",
    "is_weekend", "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end",
    "days_since_start",
    "family_mean_onpromotion", "store_mean_onpromotion",
    "family_mean_transactions", "store_mean_transactions",
    "is_generated_row",
]


def union_splits(train_grid: DataFrame, test: DataFrame) -> DataFrame:
    """Train grid and test with aligned columns and split literals."""
    train = train_grid.select(*JOIN_KEYS, "id", "sales", "onpromotion",
                              F.lit("train").alias("dataset_split"), "is_generated_row")
    test = test.select(*JOIN_KEYS, "id", F.lit(None).cast("double").alias("sales"), "onpromotion",
                       F.lit("test").alias("dataset_split"), F.lit(0).alias("is_generated_row"))
    return train.unionByName(test)


def store_day_table(transactions: DataFrame, holiday_features: DataFrame) -> DataFrame:
    """Transactions frame (complete date x store) with holiday features.

    Holiday rows only exist for stores of the stores table, which is exactly
    the transactions frame's store axis, so a left join loses nothing that
    could match a panel row."""
    return transactions.join(holiday_features, ["date", "store_nbr"], "left")


def integrate(c: Cleaned) -> DataFrame:
    """The 30-column integrated dataset."""
    base = union_splits(c.train, c.test)
    stores = checked_broadcast(c.stores)
    # One row per day of the span: bounded by the calendar, broadcast.
    oil = F.broadcast(c.oil)
    store_day = store_day_table(c.transactions, c.holiday_features)
    merged = (
        base.join(stores, "store_nbr", "left")
        .join(oil, "date", "left")
        .join(store_day, ["date", "store_nbr"], "left")
    )
    fills = {k: F.coalesce(F.col(k), F.lit(0)).cast("int") for k in HOLIDAY_FILL_ZERO}
    fills["transactions_missing_original"] = F.coalesce(
        F.col("transactions_missing_original"), F.lit(0)).cast("int")
    fills["holiday_names"] = F.coalesce(F.col("holiday_names"), F.lit(""))
    fills["transactions"] = F.coalesce(F.col("transactions"), F.lit(0.0))
    fills["promo_active"] = (F.coalesce(F.col("onpromotion"), F.lit(0)) > 0).cast("int")
    return merged.withColumns(fills).select(*INTEGRATED_COLUMNS)


def group_means(panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Family and store means of onpromotion and transactions over all rows
    (train, generated and test). One aggregate pass with two grouping sets;
    partial aggregation runs map-side, so a dominant family or store is
    reduced before the shuffle."""
    sets = panel.groupingSets([["family"], ["store_nbr"]], "family", "store_nbr").agg(
        F.avg("onpromotion").alias("mean_onpromotion"),
        F.avg("transactions").alias("mean_transactions"),
        F.grouping_id().alias("_gid"),
    )
    fam = sets.where(F.col("_gid") == 1).select(
        "family",
        F.col("mean_onpromotion").alias("family_mean_onpromotion"),
        F.col("mean_transactions").alias("family_mean_transactions"),
    )
    sto = sets.where(F.col("_gid") == 2).select(
        "store_nbr",
        F.col("mean_onpromotion").alias("store_mean_onpromotion"),
        F.col("mean_transactions").alias("store_mean_transactions"),
    )
    return fam, sto


def build_features(integrated: DataFrame, span: DataFrame | None = None,
                   axes_small: bool = False) -> DataFrame:
    """The 49-column feature dataset.

    ``span`` (one row with ``min_date``) is the global first date; without it
    the minimum is taken over the panel. ``axes_small`` (checked once per run,
    see ``panel_axes_are_small``) lets the per-family and per-store means be
    broadcast back to the panel; otherwise they are shuffle-joined."""
    if span is not None:
        start = one_row(span.select(F.col("min_date").alias("_start")))
    else:
        start = one_row(integrated.agg(F.min("date").alias("_start")))
    fam, sto = group_means(integrated)
    with_cal = integrated.withColumns(calendar_columns("date"))
    featured = (
        with_cal.crossJoin(start)
        .join(F.broadcast(fam) if axes_small else fam, "family", "left")
        .join(F.broadcast(sto) if axes_small else sto, "store_nbr", "left")
        .withColumns({
            "days_since_start": F.datediff("date", "_start"),
            "store_family_key": F.concat_ws("_", F.col("store_nbr").cast("string"), F.col("family")),
            "holiday_name_count": pipe_piece_count("holiday_names"),
        })
    )
    return featured.select(*FEATURE_COLUMNS)
