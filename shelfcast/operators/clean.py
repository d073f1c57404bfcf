"""Cleaning: typing, panel densification, oil repair, holiday scoping.

Operators P1-P9, G1-G4, W1-W4, J2-J4, U2, A1 and the transformation counters
of A4. Everything is lazy; ``standardize`` wires them the way the pipeline
uses them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import lenient_double, normalize_text, text_to_bool
from ..sources.adapter import Sources
from ..sources.schemas import TRAIN_KEY
from .common import BROADCAST_MAX_ROWS, checked_broadcast, date_spine, one_row


# ---------------------------------------------------------------- typing

def type_sources(src: Sources) -> Sources:
    """Strict casts for ids/keys, lenient numeric coercion for oil and
    transactions, text -> boolean for ``transferred``, normalized text."""
    train = src.train.select(
        F.col("id").cast("bigint").alias("id"),
        F.to_date("date").alias("date"),
        F.col("store_nbr").cast("int").alias("store_nbr"),
        F.col("family").cast("string").alias("family"),
        F.col("sales").cast("double").alias("sales"),
        F.col("onpromotion").cast("int").alias("onpromotion"),
    )
    test = src.test.select(
        F.col("id").cast("bigint").alias("id"),
        F.to_date("date").alias("date"),
        F.col("store_nbr").cast("int").alias("store_nbr"),
        F.col("family").cast("string").alias("family"),
        F.col("onpromotion").cast("int").alias("onpromotion"),
    )
    stores = src.stores.select(
        F.col("store_nbr").cast("int").alias("store_nbr"),
        normalize_text("city").alias("city"),
        normalize_text("state").alias("state"),
        normalize_text("type").alias("type"),
        F.col("cluster").cast("int").alias("cluster"),
    )
    oil = src.oil.select(F.to_date("date").alias("date"), lenient_double("dcoilwtico").alias("dcoilwtico"))
    holidays = src.holidays.select(
        F.to_date("date").alias("date"),
        normalize_text("type").alias("type"),
        normalize_text("locale").alias("locale"),
        normalize_text("locale_name").alias("locale_name"),
        normalize_text("description").alias("description"),
        text_to_bool("transferred").alias("transferred"),
    )
    transactions = src.transactions.select(
        F.to_date("date").alias("date"),
        F.col("store_nbr").cast("int").alias("store_nbr"),
        lenient_double("transactions").alias("transactions"),
    )
    return Sources(train, test, stores, oil, holidays, transactions, src.test_actuals)


# ---------------------------------------------------------- densification

def panel_facts(train: DataFrame, test: DataFrame | None = None) -> dict:
    """One job over the date and key columns: HyperLogLog sizes of the store
    and family axes and the train (and test) date bounds. The result is a few
    scalars; the spines and the span are then built from them instead of
    re-scanning the date column in every plan that needs them."""
    facts = train.agg(
        F.approx_count_distinct("store_nbr", 0.05).alias("stores"),
        F.approx_count_distinct("family", 0.05).alias("families"),
        F.min("date").alias("train_lo"), F.max("date").alias("train_hi"),
    )
    if test is not None:
        facts = facts.crossJoin(test.agg(F.min("date").alias("test_lo"), F.max("date").alias("test_hi")))
    return facts.first().asDict()


def axes_within(facts: dict, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Both panel axes within ``max_rows`` (HLL error is well under 10 %; the
    margin keeps the check conservative)."""
    return max(facts["stores"] or 0, facts["families"] or 0) * 1.1 <= max_rows


def panel_axes_are_small(train: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Size check of the panel's store and family axes, done once per run with
    HyperLogLog counts (no distinct values are shuffled). When both axes are
    within ``max_rows``, tables keyed by store or by family are broadcast;
    otherwise joins on them stay shuffle joins."""
    return axes_within(panel_facts(train), max_rows)


def _bounds_row(spark, lo, hi, names: tuple[str, str]) -> DataFrame:
    """A one-row frame of two dates known on the driver."""
    return one_row(spark.range(1).select(F.lit(lo).cast("date").alias(names[0]),
                                         F.lit(hi).cast("date").alias(names[1])))


def span_from_facts(spark, facts: dict) -> DataFrame:
    """(min_date, max_date) over train and test (A6) from ``panel_facts``."""
    los = [d for d in (facts["train_lo"], facts.get("test_lo")) if d is not None]
    his = [d for d in (facts["train_hi"], facts.get("test_hi")) if d is not None]
    return _bounds_row(spark, min(los) if los else None, max(his) if his else None, ("min_date", "max_date"))


def build_train_grid(train: DataFrame, fill_value: float = 0.0, axes_small: bool = False,
                     facts: dict | None = None) -> DataFrame:
    """Every date between the first and last train date x every store x every
    family seen in train, left-joined to train.

    ``is_generated_row`` marks keys absent from train (a present row with a null
    sales value is filled but not marked). Duplicate train keys multiply, as a
    left join does. The spine is broadcast (one row per day); the store x family
    axis stays distributed, so the grid is built where it is consumed and joined
    to train by one shuffle on the key."""
    if facts is not None:
        bounds = _bounds_row(train.sparkSession, facts["train_lo"], facts["train_hi"], ("lo", "hi"))
    else:
        bounds = train.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    spine = date_spine(bounds, "lo", "hi")
    stores = train.select("store_nbr").distinct()
    families = train.select("family").distinct()
    if axes_small:
        families = F.broadcast(families)
    grid = stores.crossJoin(families).crossJoin(F.broadcast(spine))
    present = train.withColumn("_present", F.lit(1))
    merged = grid.join(present, TRAIN_KEY, "left")
    return merged.select(
        *TRAIN_KEY,
        F.col("id").cast("bigint").alias("id"),
        F.coalesce(F.col("sales"), F.lit(float(fill_value))).alias("sales"),
        F.coalesce(F.col("onpromotion"), F.lit(0)).cast("int").alias("onpromotion"),
        F.col("_present").isNull().cast("int").alias("is_generated_row"),
    )


def grid_counters(train: DataFrame, grid: DataFrame) -> DataFrame:
    """rows_before, rows_after, rows_added (A4) as one row."""
    before = train.agg(F.count(F.lit(1)).alias("rows_before"))
    after = grid.agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.sum("is_generated_row").cast("bigint").alias("rows_added"),
    )
    return before.crossJoin(after)


def global_span(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row (min_date, max_date) over train and test dates (A6). The train
    grid spans exactly the train dates, so the raw train table gives the same
    bounds without building the grid."""
    a = train.agg(F.min("date").alias("a_lo"), F.max("date").alias("a_hi"))
    b = test.agg(F.min("date").alias("b_lo"), F.max("date").alias("b_hi"))
    return a.crossJoin(b).select(
        F.least("a_lo", "b_lo").alias("min_date"), F.greatest("a_hi", "b_hi").alias("max_date")
    )


# ------------------------------------------------------------ windows

def linear_interpolate(value: Column, order: Column, position: Column, partition: list[str]) -> Column:
    """Linear interpolation by position between the previous and next known
    values; leading/trailing gaps take the nearest known value (W1).
    ``position`` must be increasing in ``order`` (for a daily spine: day number)."""
    w = Window.partitionBy(*partition).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known_pos = F.when(value.isNotNull(), position)
    pv, pi = F.last(value, True).over(before), F.last(known_pos, True).over(before)
    nv, ni = F.first(value, True).over(after), F.first(known_pos, True).over(after)
    interp = F.when(
        value.isNull() & pi.isNotNull() & ni.isNotNull(),
        pv + (nv - pv) * (position - pi) / (ni - pi),
    )
    return F.coalesce(value, interp, pv, nv)


def forward_back_fill(value: Column, order: Column, partition: list[str]) -> Column:
    """Forward fill, then backward fill for what is still missing."""
    w = Window.partitionBy(*partition).orderBy(order)
    prev = F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nxt = F.first(value, True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return F.coalesce(value, prev, nxt)


def first_difference(value: Column, order: Column, partition: list[str]) -> Column:
    """x - previous x; the first row (and any null difference) is 0."""
    w = Window.partitionBy(*partition).orderBy(order)
    return F.coalesce(value - F.lag(value, 1).over(w), F.lit(0.0))


def trailing_mean(value: Column, order: Column, partition: list[str], n: int) -> Column:
    """Mean of the last ``n`` rows, partial windows allowed."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(1 - n, 0)
    return F.avg(value).over(w)


# ------------------------------------------------------------------- oil

def clean_oil(oil: DataFrame, span: DataFrame) -> DataFrame:
    """Reindex oil to every day of the span, mark originally missing prices,
    interpolate, fill the edges, then derive change and moving averages.

    Oil is one row per calendar day, so its windows run over the daily spine
    without a partition key; the spine's size is bounded by the number of days,
    not by data volume. Prices outside the span are dropped before the windows."""
    spine = date_spine(span, "min_date", "max_date")
    merged = spine.join(oil.withColumnRenamed("dcoilwtico", "oil_price"), "date", "left")
    d = F.col("date")
    pos = F.datediff(d, F.lit("1970-01-01").cast("date"))
    filled = merged.select(
        "date",
        F.col("oil_price").isNull().cast("int").alias("oil_missing_original"),
        linear_interpolate(F.col("oil_price"), d, pos, []).alias("oil_price"),
    )
    filled = filled.withColumn("oil_price", forward_back_fill(F.col("oil_price"), d, []))
    return filled.select(
        "date",
        "oil_price",
        "oil_missing_original",
        first_difference(F.col("oil_price"), d, []).alias("oil_price_change_1"),
        trailing_mean(F.col("oil_price"), d, [], 7).alias("oil_price_ma_7"),
        trailing_mean(F.col("oil_price"), d, [], 28).alias("oil_price_ma_28"),
    )


def oil_counters(oil_clean: DataFrame) -> DataFrame:
    return oil_clean.agg(
        F.count(F.lit(1)).alias("rows_after_reindex"),
        F.sum("oil_missing_original").cast("bigint").alias("missing_original"),
    )


# -------------------------------------------------------------- holidays

# The flag column of each holiday type.
HOLIDAY_FLAGS = {
    "is_holiday": "holiday",
    "is_event": "event",
    "is_additional": "additional",
    "is_bridge": "bridge",
    "is_work_day": "work day",
}


def clean_holidays(holidays: DataFrame) -> DataFrame:
    """Drop transferred rows; carry type/locale/description; five type flags.
    The 'transfer' type sets no flag."""
    kept = holidays.where(~F.col("transferred"))
    return kept.select(
        "*",
        F.col("type").alias("holiday_type"),
        F.col("locale").alias("holiday_locale"),
        F.col("description").alias("holiday_description"),
        *[(F.col("type") == v).cast("int").alias(k) for k, v in HOLIDAY_FLAGS.items()],
    )


def holiday_counters(holidays: DataFrame, cleaned: DataFrame) -> DataFrame:
    before = holidays.agg(F.count(F.lit(1)).alias("rows_before"))
    after = cleaned.agg(F.count(F.lit(1)).alias("rows_after"))
    return before.crossJoin(after).withColumn(
        "transferred_removed", F.col("rows_before") - F.col("rows_after")
    )


# ---------------------------------------------------------- transactions

def build_transactions_frame(transactions: DataFrame, stores: DataFrame, span: DataFrame) -> DataFrame:
    """Every day of the span x every store of the stores table, left-joined to
    transactions; missing counts are marked, then filled with 0."""
    spine = date_spine(span, "min_date", "max_date")
    store_ids = stores.select("store_nbr").distinct()
    frame = store_ids.crossJoin(F.broadcast(spine))
    merged = frame.join(transactions, ["date", "store_nbr"], "left")
    return merged.select(
        "date",
        "store_nbr",
        F.coalesce(F.col("transactions"), F.lit(0.0)).alias("transactions"),
        F.col("transactions").isNull().cast("int").alias("transactions_missing_original"),
    )


def transactions_counters(frame: DataFrame) -> DataFrame:
    return frame.agg(
        F.count(F.lit(1)).alias("rows_after_reindex"),
        F.sum("transactions_missing_original").cast("bigint").alias("missing_original"),
    )


# ------------------------------------------------- holiday -> store

def expand_holidays_to_stores(holidays_clean: DataFrame, stores: DataFrame) -> DataFrame:
    """National rows reach every store; regional rows stores whose state equals
    the locale name; local rows stores whose city equals it. Other locales and
    unmatched names drop out (inner joins)."""
    store_keys = checked_broadcast(stores.select("store_nbr", "city", "state"))
    h = holidays_clean
    national = h.where(F.col("holiday_locale") == "national").crossJoin(store_keys)
    regional = h.where(F.col("holiday_locale") == "regional").join(
        store_keys, F.col("locale_name") == F.col("state"))
    local = h.where(F.col("holiday_locale") == "local").join(
        store_keys, F.col("locale_name") == F.col("city"))
    return national.unionByName(regional).unionByName(local)


def build_holiday_store_features(holidays_clean: DataFrame, stores: DataFrame) -> DataFrame:
    """Per (date, store): holiday count, any national/regional/local, max of
    the five type flags, and the sorted distinct non-empty names joined by '|'."""
    combined = expand_holidays_to_stores(holidays_clean, stores).withColumn(
        "holiday_name", F.coalesce(F.col("holiday_description"), F.lit(""))
    )
    loc = F.col("holiday_locale")
    return combined.groupBy("date", "store_nbr").agg(
        F.count(F.lit(1)).cast("int").alias("holiday_count"),
        F.max((loc == "national").cast("int")).alias("is_national_holiday"),
        F.max((loc == "regional").cast("int")).alias("is_regional_holiday"),
        F.max((loc == "local").cast("int")).alias("is_local_holiday"),
        *[F.max(k).alias(k) for k in HOLIDAY_FLAGS],
        F.array_join(
            F.array_sort(F.collect_set(F.when(F.col("holiday_name") != "", F.col("holiday_name")))),
            "|",
        ).alias("holiday_names"),
    )


# ---------------------------------------------------------------- composition

@dataclass(frozen=True)
class Cleaned:
    train: DataFrame
    test: DataFrame
    stores: DataFrame
    oil: DataFrame
    holidays: DataFrame
    transactions: DataFrame
    holiday_features: DataFrame
    span: DataFrame
    typed: Sources
    axes_small: bool = False


def standardize(src: Sources, fill_value: float = 0.0) -> Cleaned:
    typed = type_sources(src)
    facts = panel_facts(typed.train, typed.test)
    axes_small = axes_within(facts)
    grid = build_train_grid(typed.train, fill_value, axes_small, facts)
    span = span_from_facts(typed.train.sparkSession, facts)
    holidays = clean_holidays(typed.holidays)
    return Cleaned(
        train=grid,
        test=typed.test,
        stores=typed.stores,
        oil=clean_oil(typed.oil, span),
        holidays=holidays,
        transactions=build_transactions_frame(typed.transactions, typed.stores, span),
        holiday_features=build_holiday_store_features(holidays, typed.stores),
        span=span,
        typed=typed,
        axes_small=axes_small,
    )


def transformation_counters(c: Cleaned) -> DataFrame:
    """All counters of the cleaning step as long rows (step, metric, value)."""
    parts = {
        "train": grid_counters(c.typed.train, c.train),
        "oil": oil_counters(c.oil),
        "holidays": holiday_counters(c.typed.holidays, c.holidays),
        "transactions": transactions_counters(c.transactions),
    }
    out = None
    for step, df in parts.items():
        cols = df.columns
        stacked = df.select(
            F.lit(step).alias("step"),
            F.explode(F.map_from_arrays(
                F.array(*[F.lit(x) for x in cols]),
                F.array(*[F.col(x).cast("bigint") for x in cols]),
            )).alias("metric", "value"),
        )
        out = stacked if out is None else out.unionByName(stacked)
    return out
