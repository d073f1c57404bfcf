"""Per-series operators over the long panel.

A series is one (store_nbr, family) pair. Nothing here materializes a single
series: every operator is a window or an aggregate partitioned by the series
key, so the panel is shuffled by series once and each task holds whole series
whose length is bounded by the calendar span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

SERIES = ["store_nbr", "family"]


def series_window(order: str = "date", *, desc: bool = False, partition: list[str] | None = None):
    o = F.col(order).desc() if desc else F.col(order)
    return Window.partitionBy(*(partition or SERIES)).orderBy(o)


# Default columns of a series slice (fixed values: the original's defaults).
SLICE_COLUMNS = ["sales", "onpromotion", "oil_price", "transactions", "is_holiday", "is_event"]


def series_slice(features: DataFrame, store_nbr: int, family: str, cols: list[str] | None = None) -> DataFrame:
    """Train rows of one series, date plus ``cols``, in date order (P14). The
    key and split predicates reach the Parquet scan, so only the row groups
    that can hold the series are read."""
    return (features.where((F.col("store_nbr") == store_nbr) & (F.col("family") == family)
                           & (F.col("dataset_split") == "train"))
            .select("date", *(cols or SLICE_COLUMNS))
            .orderBy("date"))


# ------------------------------------------------------------------ splits

def time_split(df: DataFrame, val_start: str, test_start: str, col: str = "split") -> DataFrame:
    """Half-open date split: [.., val_start) train, [val_start, test_start) val,
    [test_start, ..) test (T1)."""
    d = F.col("date")
    vs, ts = F.lit(val_start).cast("date"), F.lit(test_start).cast("date")
    return df.withColumn(col, F.when(d < vs, "train").when(d < ts, "val").otherwise("test"))


def rolling_origin_bounds(df: DataFrame, n_splits: int = 3, val_days: int = 31) -> DataFrame:
    """Per series and split k: val_end = last date - (n_splits-1-k)*val_days,
    val_start = val_end - val_days (T2 bounds; k = 0 is the earliest window)."""
    spans = df.groupBy(*SERIES).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    ks = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("split")
    return spans.select(*SERIES, "first_date", "last_date", ks).select(
        *SERIES, "split", "first_date",
        F.date_sub("last_date", (n_splits - 1 - F.col("split")) * val_days).alias("val_end"),
    ).withColumn("val_start", F.date_sub("val_end", val_days))


def rolling_origin_split(df: DataFrame, n_splits: int = 3, val_days: int = 31,
                         min_train_days: int = 365, strict: bool = False) -> DataFrame:
    """Rows of every rolling-origin split with flags ``is_train`` / ``is_val``.

    Slices are label-inclusive at both ends like the original, so the first
    validation day is also the last training day and validation has
    ``val_days + 1`` rows; ``strict=True`` keeps that day in training only.
    Splits with fewer than ``min_train_days`` training rows are dropped.
    Each row is repeated for at most ``n_splits`` splits of its own series.
    The series' first and last dates come from whole-series windows and the
    splits from an explode, so the job shuffles by series once (before the
    rows multiply) and the (series, split) windows and aggregates downstream
    reuse that partitioning."""
    d = F.col("date")
    whole = Window.partitionBy(*SERIES)
    ks = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("split")
    spans = df.withColumns({"first_date": F.min("date").over(whole), "_last": F.max("date").over(whole)})
    val_end = F.date_sub("_last", (n_splits - 1 - F.col("split")) * val_days)
    j = (spans.select("*", ks)
         .withColumn("val_end", val_end)
         .withColumn("val_start", F.date_sub("val_end", val_days))
         .drop("_last")
         .where(d <= F.col("val_end")))
    val_lo = (d > F.col("val_start")) if strict else (d >= F.col("val_start"))
    tagged = j.withColumns({"is_train": d <= F.col("val_start"), "is_val": val_lo})
    n_train = F.count_if(F.col("is_train")).over(Window.partitionBy(*SERIES, "split"))
    return tagged.withColumn("n_train", n_train).where(F.col("n_train") >= min_train_days)


def rolling_origin_masks(df: DataFrame, n_splits: int = 3, val_days: int = 31, strict: bool = False) -> DataFrame:
    """Every row once, with ``is_train<k>`` / ``is_val<k>`` of each
    rolling-origin split k: the bounds of ``rolling_origin_split`` as flags. Rows
    after a split's end have both false; splits with few training rows are kept."""
    d, last = F.col("date"), F.col("_last")
    flags = {}
    for k in range(n_splits):
        val_end = F.date_sub(last, (n_splits - 1 - k) * val_days)
        val_start = F.date_sub(val_end, val_days)
        flags |= {f"is_train{k}": d <= val_start,
                  f"is_val{k}": ((d > val_start) if strict else (d >= val_start)) & (d <= val_end)}
    return df.withColumn("_last", F.max("date").over(Window.partitionBy(*SERIES))).withColumns(flags).drop("_last")


def expanding_folds(n: int, k: int) -> list[tuple[int, int, int]]:
    """(fold, test_start, test_end_exclusive) of k expanding-window folds over
    n ordered rows: fold size n // (k+1), tests end at n (W11)."""
    size = n // (k + 1)
    if size == 0:
        raise ValueError("too few rows for the requested folds")
    first = n - k * size
    return [(i, first + i * size, first + (i + 1) * size) for i in range(k)]


def indexed_rows(df: DataFrame, order: list[str], partition: list[str] = SERIES) -> tuple[DataFrame, int]:
    """0-based position ``row_index`` of each row in the total order
    (``partition`` then ``order``), and the number of rows (W10).

    Rows are partitioned by range and sorted inside a partition, so a row's
    number is its place in its partition plus the rows of the partitions before
    it. The ordered rows are written once with both parts of that number; what
    the driver sees is one count per partition. No window is involved."""
    keys = [*partition, *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    placed = stage(placed, "ordered")
    # The id holds the partition above 33 bits of the place inside it.
    part, place = F.shiftright("_id", 33).cast("int"), F.col("_id").bitwiseAND((1 << 33) - 1)
    n, starts = 0, []
    for r in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((r["part"], n))
        n += r["count"]
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start long")
    numbered = placed.join(F.broadcast(offsets), part == F.col("_part")).withColumn("row_index", F.col("_start") + place)
    return numbered.drop("_id", "_part", "_start"), n


def global_row_index(df: DataFrame, order: list[str], partition: list[str] = SERIES) -> DataFrame:
    """``df`` with the row_index of ``indexed_rows``."""
    return indexed_rows(df, order, partition)[0]


def positional_split(df: DataFrame, order: list[str], fraction: float = 0.8,
                     partition: list[str] = SERIES) -> DataFrame:
    """First ``fraction`` of rows in the (partition, order) total order -> train,
    rest -> val, as int(n * fraction) like the original (W10)."""
    indexed, n = indexed_rows(df, order, partition)
    return indexed.withColumn("split", F.when(F.col("row_index") < int(n * fraction), "train").otherwise("val"))


# --------------------------------------------------------- series features

def lag_features(df: DataFrame, value: str = "sales", lags=(1, 7, 14, 28)) -> DataFrame:
    """Row-based lags per series."""
    w = series_window()
    return df.withColumns({f"{value}_lag_{k}": F.lag(value, k).over(w) for k in lags})


def full_window_mean(value: str, n: int, include_current: bool = True) -> Column:
    """Mean of the last n rows, null unless the window is full.
    ``include_current=False`` ends the window at the previous row."""
    end = 0 if include_current else -1
    w = series_window().rowsBetween(end - n + 1, end)
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def full_window_std(value: str, n: int, include_current: bool = True) -> Column:
    """Sample standard deviation of the last n rows, full window only."""
    end = 0 if include_current else -1
    w = series_window().rowsBetween(end - n + 1, end)
    return F.when(F.count(value).over(w) == n, F.stddev_samp(value).over(w))


def rolling_features(df: DataFrame, value: str = "sales", include_current: bool = True) -> DataFrame:
    return df.withColumns({
        "rolling_mean_7": full_window_mean(value, 7, include_current),
        "rolling_std_7": full_window_std(value, 7, include_current),
        "rolling_mean_14": full_window_mean(value, 14, include_current),
    })


def sequence_windows(df: DataFrame, features: list[str], target: str, length: int) -> DataFrame:
    """For each row, the previous ``length`` rows' feature vectors of the same
    series as an array of arrays, and the current target (W12). Windows are
    built per series, never across series; rows without a full history drop."""
    w = series_window().rowsBetween(-length, -1)
    vec = F.array(*[F.col(f).cast("float") for f in features])
    return (
        df.withColumn("window", F.collect_list(vec).over(w))
        .where(F.size("window") == length)
        .select(*SERIES, "date", "window", F.col(target).alias("target"))
    )


def step_numbers(df: DataFrame, col: str = "step") -> DataFrame:
    """1-based step of each row inside its series by date."""
    return df.withColumn(col, F.row_number().over(series_window()))


def days_since_start(df: DataFrame) -> DataFrame:
    start = F.broadcast(df.agg(F.min("date").alias("_start")))
    return df.crossJoin(start).withColumn("days_since_start", F.datediff("date", "_start")).drop("_start")


# ------------------------------------------------------- series selection

def series_list(df: DataFrame, split: str | None = "train") -> DataFrame:
    """Distinct (store_nbr, family) pairs of a split (A5)."""
    src = df if split is None else df.where(F.col("dataset_split") == split)
    return src.select(*SERIES).distinct()


def first_n_series(df: DataFrame, n: int) -> DataFrame:
    """First n pairs in (store_nbr, family) order (L2): a top-k, not a cap."""
    return series_list(df).orderBy(*SERIES).limit(n)


def sample_series(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Seeded sample of n pairs without replacement: order by a keyed hash
    (L3). The order is reproducible but differs from NumPy's generator."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("store_nbr").cast("string"), F.col("family")))
    return series_list(df).orderBy(key, *SERIES).limit(n)


def restrict_to_series(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose pair is in ``pairs`` (J9, left semi join)."""
    return df.join(pairs.select(*SERIES), SERIES, "left_semi")


def last_n_days(df: DataFrame, n: int) -> DataFrame:
    """Rows with date > max(date) - n."""
    mx = F.broadcast(df.agg(F.max("date").alias("_max")))
    return df.crossJoin(mx).where(F.col("date") > F.date_sub("_max", n)).drop("_max")


def fold_assignment(df: DataFrame, k: int, order: list[str], partition: list[str] = SERIES) -> DataFrame:
    """Expanding-window fold of every row (W11) over the (partition, order)
    total order: ``test_fold`` is the fold whose test block holds the row
    (null for the leading train-only block); fold f trains on every row
    before its block. Uses the distributed row index of ``indexed_rows``."""
    indexed, n = indexed_rows(df, order, partition)
    folds = expanding_folds(n, k)
    first, size = folds[0][1], folds[0][2] - folds[0][1]
    fold = F.floor((F.col("row_index") - first) / size).cast("int")
    return indexed.withColumn("test_fold", F.when(F.col("row_index") >= first, fold))
