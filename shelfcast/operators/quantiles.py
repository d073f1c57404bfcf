"""Exact quantiles in bounded memory.

Selection by repeated histogram refinement, for all groups and all ranks at
once. A pass counts the values of each open interval in ``BINS`` bins and keeps,
for each rank, the bin that holds it, as the interval between the smallest and the
largest value in it. A rank is found when its interval is one value. Each pass is
one aggregate combined before its shuffle; what it keeps for a group is a
few intervals, whatever the group holds, and a very large group is only ever
counted."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import checked_broadcast

BINS = 1024


def exact_quantiles(df: DataFrame, value: str, probs: list[float], group: str | None = None) -> DataFrame:
    """``n`` (values that are not null or NaN) and ``quantiles``, an array with
    the linearly interpolated quantile of each of ``probs``; one row per group,
    or one row. A group without values, or an empty table, has no row."""
    v = F.col(value).cast("double")
    key = F.lit(0) if group is None else F.col(group)
    rows = stage(df.select(key.alias("g"), v.alias("v")).where(v.isNotNull() & ~F.isnan(v)), "quantile-rows")
    stats = stage(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "quantile-groups")
    place = [F.col("n").cast("double") * p - F.lit(p) for p in probs]  # p * (n - 1)
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(h), F.ceil(h)) for h in place])))
    wanted = stats.select("g", F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("before"))
    found = []
    while True:
        wanted = stage(wanted, "quantile-ranks")
        found.append(wanted.where("lo = hi").select("g", "rank", F.col("lo").alias("x")))
        still = wanted.where("lo < hi")
        if still.isEmpty():
            break
        wanted = _narrowed(rows, still)
    values = found[0]
    for more in found[1:]:
        values = values.unionByName(more)
    by_rank = values.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("at"))
    quantiles = []
    for h in place:
        low, high = F.col("at")[F.floor(h)], F.col("at")[F.ceil(h)]
        quantiles.append(low + (high - low) * (h - F.floor(h)))
    same = stats["g"].eqNullSafe(by_rank["g"])
    out = stats.join(by_rank, same).select(stats["g"].alias(group or "_all"), "n", F.array(*quantiles).alias("quantiles"))
    return out if group else out.drop("_all")


def _narrowed(rows: DataFrame, still: DataFrame) -> DataFrame:
    """The open ranks with the bin of their interval that holds them."""
    at = ["h", "lo", "hi", "before"]
    spans = still.select(F.col("g").alias("h"), "lo", "hi", "before").distinct()
    inside = rows.join(checked_broadcast(spans), F.col("g").eqNullSafe(F.col("h")) & F.col("v").between(F.col("lo"), F.col("hi")))
    cell = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
    bins = inside.groupBy(*at, cell.alias("cell")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
    upto = F.sum("c").over(Window.partitionBy(*at).orderBy("cell"))
    bins = bins.withColumn("below", F.col("before") + upto - F.col("c")).withColumnsRenamed({"lo": "low", "hi": "high"}).drop("before")
    same = (F.col("g").eqNullSafe(F.col("h")) & (F.col("lo") == F.col("low")) & (F.col("hi") == F.col("high"))
            & (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("c")))
    return still.join(bins, same).select("g", "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("below").alias("before"))


def interpolated(values: list[float], p: float) -> float:
    """The same quantile of a sorted list, for small tables and tests."""
    h = p * (len(values) - 1)
    return values[floor(h)] + (values[ceil(h)] - values[floor(h)]) * (h - floor(h))
