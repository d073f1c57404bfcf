"""Joining rows back to what was found about their groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: At most this many groups are broadcast. A group counts as hot from
#: rows / HOT_GROUPS members on, so there are never more hot ones than this.
HOT_GROUPS = 100_000
#: No group below this size is treated as hot.
LEAST_HOT = 1_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``groups`` (unique in ``key``, both written
    tables; ``key`` not null in ``groups``). Rows of hot groups stay where they
    are and meet a broadcast of at most HOT_GROUPS rows; the others shuffle, and
    no key of that shuffle has more rows than a hot group's least size. ``how``
    is 'inner' or 'left'; null keys match nothing."""
    least = max(LEAST_HOT, -(-n_rows // HOT_GROUPS))
    hot = F.broadcast(groups.where(F.col(size) >= least))
    cold = groups.where(F.col(size) < least)
    added = [c for c in groups.columns if c != key]
    at_once = rows.join(hot, key)
    rest = rows.join(hot.select(key), key, "left_anti")
    if how == "left":
        # A null key would send every such row to one task.
        keyless = rest.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(groups.schema[c].dataType).alias(c) for c in added])
        rest = rest.where(F.col(key).isNotNull())
    out = at_once.unionByName(rest.join(cold, key, how))
    return out.unionByName(keyless) if how == "left" else out
