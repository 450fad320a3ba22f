"""Dimension lookups with a size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.sources.manifest import input_fingerprint

# (fingerprint of the files read, bound) -> within the bound
_CHECKED: dict[tuple[str, int], bool] = {}


def checked_broadcast(dim: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only when ``dim`` is proven to hold <= ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows, so it stays cheap even
    when the table turns out to be large; beyond the bound the plain
    DataFrame is returned and the planner falls back to a shuffle join.  It
    runs again whenever a file that ``dim`` reads has changed.
    """
    at = (input_fingerprint(dim), max_rows)
    if at not in _CHECKED:
        _CHECKED[at] = dim.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(dim) if _CHECKED[at] else dim


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    value: str,
    out: str | None = None,
    default: str | None = None,
    max_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Left-join ``dim[key] -> dim[value]`` onto ``df`` with a default.

    ``dim`` must be unique on ``key`` (a dictionary), so the join never
    fans out.  Missing keys get ``default`` (the reference falls back to a
    value when the dictionary has no entry).
    """
    out = out or value
    d = dim.select(F.col(key).alias("__lk"), F.col(value).alias("__lv"))
    d = checked_broadcast(d, max_broadcast_rows)
    joined = df.join(d, df[key] == d["__lk"], "left")
    filled = F.coalesce(F.col("__lv"), F.lit(default)) if default is not None else F.col("__lv")
    return joined.withColumn(out, filled).drop("__lk", "__lv")
