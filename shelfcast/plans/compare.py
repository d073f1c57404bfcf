"""Train-and-compare run (T17): every model's forecasts scored per series into
one metrics table, which is read back and compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluate import compare_models
from ..operators.models import forecast_metrics
from ..operators.series import SERIES
from ..sources import sinks

METRICS = ["rmsle", "rmse", "mae"]


def train_and_compare(spark: SparkSession, models: dict[str, Callable[[], DataFrame]], actuals: DataFrame,
                      store: str) -> tuple[DataFrame, DataFrame]:
    """Fit the models in their order and write each one's per-series metrics to
    the metrics table ``store`` (a rerun replaces its own rows); return the long
    comparison and the best model, both from what the table then holds.

    A model gives forecast rows (series, date, yhat, order_label). A metric of a model is the
    mean over the series that it scored. Models without any row are left out of
    the comparison, which raises if fewer than two remain; rows that an earlier run
    left for them in the same store still count. Ties go to the model listed first."""
    for position, (name, forecasts) in enumerate(models.items()):
        rows = forecast_metrics(forecasts(), actuals).select(*SERIES, *METRICS, F.lit(position).alias("position"))
        sinks.append_metrics(rows, store, name)
    table = sinks.read_store(spark, store).where(F.col("model").isin(list(models)))
    means = table.groupBy("model", "position").agg(*[F.avg(m).alias(m) for m in METRICS])
    return compare_models(means)
