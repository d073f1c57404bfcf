"""Forecast-error expressions.

Clipping differs between the places the metrics are used, so it is a
parameter: ``rmsle_only`` clips the prediction at zero inside RMSLE only,
``pred`` clips the prediction for every metric, ``both`` clips truth and
prediction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_zero(c: Column) -> Column:
    """max(x, 0) that keeps null as null (greatest() would turn it into 0)."""
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(c, F.lit(0.0)))


def _sides(y: Column, p: Column, clip: str) -> tuple[Column, Column, Column]:
    if clip == "rmsle_only":
        return y, p, clip_zero(p)
    if clip == "pred":
        return y, clip_zero(p), clip_zero(p)
    if clip == "both":
        return clip_zero(y), clip_zero(p), clip_zero(p)
    raise ValueError(f"unknown clip mode {clip!r}")


def error_aggregates(y: str = "y", p: str = "p", clip: str = "rmsle_only",
                     names: tuple[str, str, str] = ("rmsle", "rmse", "mae")) -> list[Column]:
    """RMSLE, RMSE, MAE as aggregate expressions (use in agg / groupBy.agg)."""
    yt, pr, pl = _sides(F.col(y), F.col(p), clip)
    return [
        F.sqrt(F.avg(F.pow(F.log1p(yt) - F.log1p(pl), 2))).alias(names[0]),
        F.sqrt(F.avg(F.pow(yt - pr, 2))).alias(names[1]),
        F.avg(F.abs(yt - pr)).alias(names[2]),
    ]


def extended_aggregates(y: str = "y", p: str = "p") -> list[Column]:
    """RMSLE, MAE, RMSE, R2, MAPE with both sides clipped at zero.

    R2 = 1 - SSE / SST with SST = n * var_pop(y); a constant truth gives 1 for
    an exact fit and 0 otherwise. MAPE uses a 1e-8 guard and is in percent."""
    yt, pr = clip_zero(F.col(y)), clip_zero(F.col(p))
    sse = F.sum(F.pow(yt - pr, 2))
    sst = F.var_pop(yt) * F.count(yt)
    r2 = F.when(sst > 0, 1 - sse / sst).when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return [
        F.sqrt(F.avg(F.pow(F.log1p(yt) - F.log1p(pr), 2))).alias("rmsle"),
        F.avg(F.abs(yt - pr)).alias("mae"),
        F.sqrt(F.avg(F.pow(yt - pr, 2))).alias("rmse"),
        r2.alias("r2"),
        (F.avg(F.abs((yt - pr) / (yt + 1e-8))) * 100).alias("mape"),
    ]


def residual(y: Column, p: Column, sign: str = "pred_minus_actual") -> Column:
    if sign == "pred_minus_actual":
        return p - y
    if sign == "actual_minus_pred":
        return y - p
    raise ValueError(f"unknown residual sign {sign!r}")
