"""Seasonal-naive forecasting and backtests over all series at once
(T3-T6, A16, A22, T15).

The seasonal-naive model keeps the last ``period`` training values of a series
and repeats them. Here that is one pass over the series partitioning: a
descending running count ranks the training rows from the end, a whole-series
window gathers the last ``period`` of them (a bounded array) onto every row,
an ascending running count numbers the rows to forecast, and step s reads
season[(s - 1) % period]. All windows share one hash partitioning, and the
per-series metrics are a grouped aggregate on that same partitioning, so a
backtest scans and shuffles its input once and joins nothing back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import error_aggregates
from ..session import stage
from .quantiles import exact_quantiles
from .series import SERIES

TRAIN_SPLIT = "train"


def _season_pick(role_is_fit: Column, partition: list[str]) -> Column:
    """Rank of a fit row counted from the end of its series (1 = last)."""
    w = Window.partitionBy(*partition).orderBy(F.col("date").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return F.when(role_is_fit, F.sum(role_is_fit.cast("int")).over(w))


def _step(role_is_target: Column, partition: list[str]) -> Column:
    w = Window.partitionBy(*partition).orderBy(F.col("date")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return F.when(role_is_target, F.sum(role_is_target.cast("int")).over(w))


def seasonal_naive_masks(rows: DataFrame, masks: dict[str, tuple[str, str]], value: str,
                         period: int = 7, partition: list[str] = SERIES) -> DataFrame:
    """Every input row once, with the forecasts of several splits beside each
    other. ``masks`` gives for each suffix its fit and target flag; added for it
    are ``_step`` (position among the group's rows to forecast), ``_n_fit`` (fit
    rows in the group) and ``prediction`` (null unless it is a row to forecast
    of a group with at least ``period`` fit rows; the original raises for shorter
    series and its callers skip them). All splits share the same three windows."""
    whole = Window.partitionBy(*partition)
    places, facts, preds = {}, {}, {}
    for k, (fit_col, target_col) in masks.items():
        fit, tgt = F.col(fit_col), F.col(target_col)
        places |= {f"_back{k}": _season_pick(fit, partition), f"_step{k}": _step(tgt, partition)}
        # at most `period` values per group: a bounded gather
        last = F.collect_list(F.when(F.col(f"_back{k}") <= period, F.struct(F.col(f"_back{k}"), F.col(value).alias("v")))).over(whole)
        facts |= {f"_last{k}": last, f"_n_fit{k}": F.count_if(fit).over(whole)}
        # chronological order: the oldest of the last `period` values first
        season = F.reverse(F.transform(F.sort_array(f"_last{k}"), lambda x: x["v"]))
        preds[f"prediction{k}"] = F.when(tgt & (F.col(f"_n_fit{k}") >= period),
                                         F.element_at(season, ((F.col(f"_step{k}") - 1) % period + 1).cast("int")))
    out = rows.withColumns(places).withColumns(facts).withColumns(preds)
    return out.drop(*[f"{c}{k}" for k in masks for c in ("_back", "_last")])


def seasonal_naive_frame(rows: DataFrame, fit_col: str, target_col: str, value: str,
                         period: int = 7, partition: list[str] = SERIES) -> DataFrame:
    """Every input row with ``_step``, ``_n_fit`` and ``prediction`` of one split."""
    return seasonal_naive_masks(rows, {"": (fit_col, target_col)}, value, period, partition)


def seasonal_naive(rows: DataFrame, fit_col: str, target_col: str, value: str,
                   period: int = 7, partition: list[str] = SERIES,
                   extra_counts: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Seasonal-naive forecasts for all series (T3) as (forecast rows,
    per-group facts: n_fit, n_target and ``extra_counts``)."""
    frame = seasonal_naive_frame(rows, fit_col, target_col, value, period, partition)
    forecasts = frame.where(F.col("prediction").isNotNull())
    facts = frame.groupBy(*partition).agg(
        F.count_if(F.col(fit_col)).alias("n_fit"),
        F.count_if(F.col(target_col)).alias("n_target"),
        *[F.count_if(c).alias(k) for k, c in (extra_counts or {}).items()],
    )
    return forecasts, facts


def _scored(frame: DataFrame, value: str) -> DataFrame:
    """Truth kept only where a forecast exists, so the error aggregates skip
    every other row of the group."""
    return frame.withColumn("_y", F.when(F.col("prediction").isNotNull(), F.col(value)))


def training_frame(features: DataFrame) -> DataFrame:
    """Train split with the columns the backtests read; sales coerced, null -> 0
    (S2). Column pruning and the split predicate reach the Parquet scan."""
    return features.where(F.col("dataset_split") == TRAIN_SPLIT).select(
        "date", "store_nbr", "family", F.coalesce(F.col("sales").try_cast("double"), F.lit(0.0)).alias("sales")
    )


def baseline_backtest(features: DataFrame, val_start: str, test_start: str, period: int = 7) -> DataFrame:
    """Seasonal naive fitted on [.., val_start) and scored on
    [val_start, test_start) for every series (T4). One row per evaluated series:
    rmsle, rmse, mae and the day counts of the three splits."""
    frame = training_frame(features)
    d = F.col("date")
    vs, ts = F.lit(val_start).cast("date"), F.lit(test_start).cast("date")
    tagged = frame.withColumns({
        "_fit": d < vs,
        "_val": (d >= vs) & (d < ts),
        "_test": d >= ts,
    })
    frame = _scored(seasonal_naive_frame(tagged, "_fit", "_val", "sales", period), "sales")
    per_series = frame.groupBy(*SERIES).agg(
        *error_aggregates("_y", "prediction", "rmsle_only"),
        F.count("prediction").alias("_n_pred"),
        F.count_if("_fit").alias("train_days"),
        F.count_if("_val").alias("val_days"),
        F.count_if("_test").alias("test_days"),
    )
    return per_series.where(F.col("_n_pred") > 0).select(
        *SERIES, "rmsle", "rmse", "mae", "train_days", "val_days", "test_days")


def backtest_summary(results: DataFrame, metric: str = "rmsle") -> DataFrame:
    """n, mean / median / sample std of RMSLE, mean RMSE and MAE (A16): one row,
    also of an empty table. The median is exact, found in bounded memory."""
    results = stage(results.select(metric, "rmse", "mae"), "backtest")
    median = exact_quantiles(results, metric, [0.5]).select(F.col("quantiles")[0].alias("m")).first()
    return results.agg(
        F.count(F.lit(1)).alias("n_sequences"),
        F.avg(metric).alias("rmsle_mean"),
        F.lit(median.m if median else None).cast("double").alias("rmsle_median"),
        F.stddev_samp(metric).alias("rmsle_std"),
        F.avg("rmse").alias("rmse_mean"),
        F.avg("mae").alias("mae_mean"),
    )


def rolling_validation(features: DataFrame, n_splits: int = 3, val_days: int = 31,
                       min_train_days: int = 365, period: int = 7, strict: bool = False) -> DataFrame:
    """Seasonal naive over rolling-origin splits of every series (T5): one row
    per (series, split) with the train end, validation bounds and metrics. The
    splits are flags beside each row, scored by conditional aggregates, so rows
    are not repeated; only the finished metrics are laid out by split."""
    from .series import rolling_origin_masks

    rows = rolling_origin_masks(training_frame(features), n_splits, val_days, strict)
    ks = range(n_splits)
    frame = seasonal_naive_masks(rows, {str(k): (f"is_train{k}", f"is_val{k}") for k in ks}, "sales", period)
    # truth kept only where a forecast exists
    frame = frame.withColumns({f"_y{k}": F.when(F.col(f"prediction{k}").isNotNull(), F.col("sales")) for k in ks})
    names = ["train_end", "val_start", "val_end", "rmsle", "rmse", "mae"]
    aggs = []
    for k in ks:
        forecast_date = F.when(F.col(f"_y{k}").isNotNull(), F.col("date"))
        aggs += [F.max(F.when(F.col(f"is_train{k}"), F.col("date"))).alias(f"train_end{k}"),
                 F.min(forecast_date).alias(f"val_start{k}"), F.max(forecast_date).alias(f"val_end{k}"),
                 *error_aggregates(f"_y{k}", f"prediction{k}", "rmsle_only", tuple(f"{m}{k}" for m in names[3:])),
                 F.count_if(f"is_train{k}").alias(f"_n_train{k}"), F.count(f"prediction{k}").alias(f"_n_pred{k}")]
    splits = F.array(*[F.struct(F.lit(k).alias("split"), *[F.col(f"{c}{k}").alias(c) for c in [*names, "_n_train", "_n_pred"]]) for k in ks])
    out = frame.groupBy(*SERIES).agg(*aggs).select(*SERIES, F.inline(splits))
    return out.where((F.col("_n_train") >= min_train_days) & (F.col("_n_pred") > 0)).select(*SERIES, "split", *names)


def rolling_summary(per_split: DataFrame) -> DataFrame:
    """Mean metrics over the splits of each series."""
    return per_split.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n_splits"),
        F.avg("rmsle").alias("rmsle_mean"),
        F.avg("rmse").alias("rmse_mean"),
        F.avg("mae").alias("mae_mean"),
    )


def submission(features: DataFrame, test: DataFrame, period: int = 7,
               horizon: int | None = None, decimals: int | None = 2) -> DataFrame:
    """Seasonal-naive predictions for every test id.

    The last ``period`` training values of each train series are repeated over
    its test rows in date order. Series with fewer than ``period`` training
    rows get the global training mean; test pairs absent from train get no row.
    ``horizon`` keeps only the first steps of each series (the original stops
    at 16); None takes the horizon from the data."""
    frame = training_frame(features).select(*SERIES, "date", "sales",
                                            F.lit(True).alias("_fit"), F.lit(False).alias("_tgt"),
                                            F.lit(None).cast("bigint").alias("id"))
    targets = test.select(*SERIES, "date", F.lit(None).cast("double").alias("sales"),
                          F.lit(False).alias("_fit"), F.lit(True).alias("_tgt"), "id")
    rows = frame.unionByName(targets)
    scored = seasonal_naive_frame(rows, "_fit", "_tgt", "sales", period)
    mean = F.broadcast(frame.agg(F.avg("sales").alias("_mean")))  # one row
    # series with some but fewer than `period` training rows: the global mean
    out = (
        scored.where(F.col("_tgt") & (F.col("_n_fit") > 0))
        .crossJoin(mean)
        .select("id", "_step", F.coalesce(F.col("prediction"), F.col("_mean")).alias("prediction"))
    )
    if horizon is not None:
        out = out.where(F.col("_step") <= horizon)
    pred = F.col("prediction")
    if decimals is not None:
        pred = F.round(pred, decimals)
    return out.select("id", pred.alias("sales"))


def global_mean(frame: DataFrame, value: str = "sales") -> DataFrame:
    """Global mean used as fallback forecast (A22): one row."""
    return frame.agg(F.avg(value).alias("global_mean"))


def prophet_holiday_frame(holidays: DataFrame) -> DataFrame:
    """Holiday rows for the additive model (T15): work days and transferred
    rows skipped; zero-width windows; local holidays scaled by 0.5. Values are
    compared after normalization (lower case)."""
    from ..functions.text import normalize_text, text_to_bool

    t = normalize_text("type")
    return holidays.where((t != "work day") & ~text_to_bool("transferred")).select(
        F.col("description").alias("holiday"),
        F.to_date("date").alias("ds"),
        F.lit(0).alias("lower_window"),
        F.lit(0).alias("upper_window"),
        F.when(normalize_text("locale") == "local", F.lit(0.5)).alias("scale"),
    )
