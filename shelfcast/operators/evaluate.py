"""Evaluation aggregates as tables.

Charts in the original are drawn from these aggregates; here the aggregates
themselves are the product. Every operator is a groupBy / window / join over
the input, never a driver loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import clip_zero, error_aggregates, extended_aggregates, residual
from ..functions.stats import histogram_bin, inverse_normal
from .common import checked_broadcast
from .quantiles import exact_quantiles

KEY = ["date", "store_nbr", "family"]


# ------------------------------------------------------------ filters, joins

def filter_history(df: DataFrame, store_nbr: int | None = None, family: str | None = None,
                   date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Optional store / family filters; the inclusive date range applies only
    when both ends are given (P15)."""
    out = df
    if store_nbr is not None:
        out = out.where(F.col("store_nbr") == store_nbr)
    if family is not None:
        out = out.where(F.col("family") == family)
    if date_from is not None and date_to is not None:
        out = out.where(F.col("date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))
    return out


def test_with_predictions(test: DataFrame, predictions: DataFrame, stores: DataFrame | None) -> DataFrame:
    """test ⟕ predictions on id (sales -> predicted_sales) ⟕ stores."""
    pred = predictions.select("id", F.col("sales").alias("predicted_sales"))
    out = test.join(pred, "id", "left")
    if stores is not None:
        out = out.join(stores, "store_nbr", "left")
    return out


def pair_with_actuals(pred: DataFrame, actual: DataFrame, key: list[str] = KEY,
                      pred_col: str = "predicted_sales", actual_col: str = "sales") -> DataFrame:
    """Prediction <-> actual pairs matched on the key, not on position."""
    return pred.select(*key, F.col(pred_col).alias("prediction")).join(
        actual.select(*key, F.col(actual_col).alias("actual")), key)


def with_band(df: DataFrame, pred: str = "prediction", width: float | str = 0.1) -> DataFrame:
    """Prediction band pred ± ci (P23); ``width`` a fraction or a column name."""
    ci = F.col(width) if isinstance(width, str) else F.abs(F.col(pred)) * width
    return df.withColumns({"lower": F.col(pred) - ci, "upper": F.col(pred) + ci})


def with_residual(df: DataFrame, actual: str = "actual", pred: str = "prediction",
                  sign: str = "pred_minus_actual") -> DataFrame:
    """Residual column (P24); the sign is a parameter."""
    return df.withColumn("residual", residual(F.col(actual), F.col(pred), sign))


# ------------------------------------------------------------- aggregates

def daily_total(df: DataFrame, value: str = "sales", alias: str = "total") -> DataFrame:
    """Total per day."""
    return df.groupBy("date").agg(F.sum(value).alias(alias))


def top_n(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The n keys with the largest total, ties by key (A9). The limit is the
    feature; Spark plans it as a TakeOrderedAndProject over the partial sums."""
    return (df.groupBy(key).agg(F.sum(value).alias("total"))
            .orderBy(F.col("total").desc(), F.col(key)).limit(n))


def mean_matrix_long(df: DataFrame, value: str = "sales", top_families: int = 10,
                     stores: list[int] | None = None, families: list[str] | None = None) -> DataFrame:
    """Store x family mean of ``value`` restricted to the families with the
    largest column sums (A10), in long form (store_nbr, family, mean_value)."""
    src = df
    if stores is not None:
        src = src.where(F.col("store_nbr").isin(stores))
    if families is not None:
        src = src.where(F.col("family").isin(families))
    cell = src.groupBy("store_nbr", "family").agg(F.avg(value).alias("mean_value"))
    top = (cell.groupBy("family").agg(F.sum("mean_value").alias("_colsum"))
           .orderBy(F.col("_colsum").desc(), "family").limit(top_families).select("family"))
    return cell.join(F.broadcast(top), "family", "left_semi")  # at most top_families rows


def pivot_matrix(long: DataFrame, row: str = "store_nbr", col: str = "family",
                 value: str = "mean_value") -> DataFrame:
    """Wide matrix from the long form; the pivot values are the (bounded) top-k
    column keys, passed explicitly so Spark does not scan for them."""
    keys = sorted(r[0] for r in long.select(col).distinct().collect())
    return long.groupBy(row).pivot(col, keys).agg(F.first(value)).orderBy(row)


def metric_matrix_long(results: DataFrame, metric: str = "rmsle", n_families: int = 15,
                       n_stores: int = 15) -> DataFrame:
    """Store x family metric matrix (A11, L6): the ``n_families`` families with
    the lowest mean metric, of their rows the first ``n_stores`` stores, long
    form (store_nbr, family, value). Both selections are top-k reports."""
    fam = (results.groupBy("family").agg(F.avg(metric).alias("_m"))
           .orderBy("_m", "family").limit(n_families).select("family"))
    kept = results.join(F.broadcast(fam), "family", "left_semi")  # at most n_families rows
    sto = kept.select("store_nbr").distinct().orderBy("store_nbr").limit(n_stores)
    cells = kept.join(F.broadcast(sto), "store_nbr", "left_semi")
    return cells.groupBy("store_nbr", "family").agg(F.avg(metric).alias("value"))


def best_worst(results: DataFrame, key: str = "family", metric: str = "rmsle", k: int = 5) -> DataFrame:
    """Best k and worst k groups by mean metric (A12): two top-k reports
    (TakeOrderedAndProject), ranked after the limit over k rows each."""
    means = results.groupBy(key).agg(F.avg(metric).alias("mean_metric"))

    def side(name: str, order: list) -> DataFrame:
        top = means.orderBy(*order).limit(k)
        return top.select(F.lit(name).alias("side"), F.row_number().over(Window.orderBy(*order)).alias("rank"),
                          key, "mean_metric")

    best = side("best", [F.col("mean_metric").asc(), F.col(key)])
    worst = side("worst", [F.col("mean_metric").desc(), F.col(key)])
    return best.unionByName(worst)


def validation_metrics(metrics: DataFrame) -> DataFrame:
    """Validation metrics per model (A13): the model's validation row when it
    has a ``split`` column value, else the mean over its per-series rows."""
    has_split = metrics.where(F.col("split").isNotNull())
    val = has_split.where(F.col("split") == "validation").groupBy("model").agg(
        F.first("rmsle").alias("rmsle"), F.first("mae").alias("mae"), F.first("rmse").alias("rmse"))
    per_series = metrics.where(F.col("split").isNull()).groupBy("model").agg(
        F.avg("rmsle").alias("rmsle"), F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"))
    return val.unionByName(per_series)


def metrics_long(model_metrics: DataFrame, metrics: list[str] = ("rmsle", "mae", "rmse")) -> DataFrame:
    """model x metric long table."""
    return model_metrics.unpivot("model", list(metrics), "metric", "value")


def radar_normalized(model_metrics: DataFrame, metrics: list[str] = ("rmsle", "mae", "rmse")) -> DataFrame:
    """metric / max over models per metric, 0 when the max is 0."""
    long = metrics_long(model_metrics, metrics)
    mx = F.max("value").over(Window.partitionBy("metric"))  # one row per model: tiny
    return long.withColumn("normalized", F.when(mx == 0, F.lit(0.0)).otherwise(F.col("value") / mx))


def best_model(model_metrics: DataFrame, metric: str = "rmsle", order_col: str = "position") -> DataFrame:
    """Model with the smallest metric, the first listed wins ties."""
    return model_metrics.agg(
        F.min_by("model", F.struct(F.col(metric), F.col(order_col))).alias("best_model"),
        F.min(metric).alias(f"best_{metric}"),
    )


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram with the last bin closed (A17): bin, lower edge,
    count; plus the mean of the values on every row."""
    stats = F.broadcast(df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"),
                               F.avg(value).alias("mean_value")))
    v = df.where(F.col(value).isNotNull()).select(value).crossJoin(stats)
    b = histogram_bin(F.col(value), F.col("_lo"), F.col("_hi"), bins)
    return v.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"),
        F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"), F.first("mean_value").alias("mean_value"),
    ).select(
        "bin",
        (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_start"),
        "count", "mean_value",
    )


def density_curve(df: DataFrame, value: str, grid_points: int = 200, fine_bins: int = 2048) -> DataFrame:
    """Gaussian kernel density over ``grid_points`` points (A18), Scott's
    bandwidth. The data is first reduced to a fine histogram (at most
    ``fine_bins`` rows), so the kernel sum is grid_points x fine_bins."""
    stats = F.broadcast(df.agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"),
        F.stddev_samp(value).alias("_sd"), F.count(value).alias("_n")))
    fine = (df.where(F.col(value).isNotNull()).select(value).crossJoin(stats)
            .groupBy(histogram_bin(F.col(value), F.col("_lo"), F.col("_hi"), fine_bins).alias("_b"))
            .agg(F.count(F.lit(1)).alias("_c"), F.avg(value).alias("_x")))
    grid = stats.select(F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("_i"), "*").select(
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_i") / (grid_points - 1)).alias("x"),
        (F.col("_sd") * F.pow(F.col("_n"), -0.2)).alias("_h"), "_n")
    k = F.exp(-0.5 * F.pow((F.col("x") - F.col("_x")) / F.col("_h"), 2)) / (F.col("_h") * (2 * 3.141592653589793) ** 0.5)
    return (F.broadcast(grid).crossJoin(fine)
            .groupBy("x").agg((F.sum(F.col("_c") * k) / F.first("_n")).alias("density")))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers (most extreme values within 1.5 IQR) and outlier
    count per group (A19). The quartiles are exact and found in bounded memory;
    their table has one row per group."""
    quart = exact_quantiles(df, value, [0.25, 0.5, 0.75], group).withColumnRenamed(group, "_group")
    j = df.select(group, value).join(checked_broadcast(quart), F.col(group).eqNullSafe(F.col("_group")))
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[2]
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    v = F.col(value)
    return j.groupBy(group).agg(
        F.first(q1).alias("q1"), F.first(F.col("quantiles")[1]).alias("median"), F.first(q3).alias("q3"),
        F.min(F.when(v >= lo, v)).alias("whisker_low"),
        F.max(F.when(v <= hi, v)).alias("whisker_high"),
        F.count_if((v < lo) | (v > hi)).alias("outliers"),
    )


def top_groups(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """The rows of the ``n`` groups with the largest sums of ``value``: the
    groups that a box report of the top n is about (A9, A19)."""
    return df.join(F.broadcast(top_n(df, group, value, n).select(group)), group, "left_semi")


def qq_points(df: DataFrame, value: str, points: int = 99) -> DataFrame:
    """Normal Q-Q pairs (A20): exact sample quantiles on a fixed probability
    grid against the standard normal quantiles of the same grid."""
    probs = [(i + 0.5) / points for i in range(points)]
    q = exact_quantiles(df, value, probs)
    return q.select(F.posexplode("quantiles").alias("i", "sample_quantile")).select(
        "i", (F.col("i") + 0.5) / points, "sample_quantile"
    ).toDF("i", "p", "sample_quantile").withColumn("theoretical_quantile", inverse_normal(F.col("p")))


def metric_table(pairs: DataFrame, group: list[str] | None = None, clip: str = "pred") -> DataFrame:
    """RMSLE / RMSE / MAE over prediction-actual pairs, optionally grouped."""
    aggs = error_aggregates("actual", "prediction", clip)
    return pairs.groupBy(*group).agg(*aggs) if group else pairs.agg(*aggs)


def extended_metric_table(pairs: DataFrame, group: list[str] | None = None) -> DataFrame:
    """RMSLE, MAE, RMSE, R2, MAPE with both sides clipped."""
    aggs = extended_aggregates("actual", "prediction")
    return pairs.groupBy(*group).agg(*aggs) if group else pairs.agg(*aggs)


def compare_models(model_metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long comparison table and the best model (T17); needs two models."""
    if model_metrics.select("model").distinct().limit(2).count() < 2:
        raise ValueError("a comparison needs at least two models")
    return metrics_long(model_metrics), best_model(model_metrics)


def model_frame(series_rows: DataFrame, regressors: list[str]) -> DataFrame:
    """Frame for the additive model (P5, P22): date -> ds, sales -> y, the
    requested regressors as doubles; regressors absent from the input are 0.0."""
    cols = [F.col("date").alias("ds"), F.col("sales").alias("y")]
    for r in regressors:
        cols.append((F.col(r).cast("double") if r in series_rows.columns else F.lit(0.0)).alias(r))
    return series_rows.select(*cols)
