"""Keep the latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def default_tiebreak(df: DataFrame, key: str, order: str) -> list[str]:
    """All remaining columns, in schema order — makes the winner unique."""
    return [f for f in df.columns if f not in (key, order)]


def dedupe_latest(
    df: DataFrame,
    key: str = "screening_id",
    order: str = "screening_date",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``key``: latest ``order`` first, nulls last.

    The reference breaks ties arbitrarily (Q2); here the remaining columns
    (ascending, nulls last) decide, so the result does not depend on the
    partitioning.  ``row_number() ... = 1`` is planned by Catalyst as a
    partial WindowGroupLimit *before* the shuffle, so even a key that holds
    a third of all rows reaches the exchange as at most one row per input
    partition.
    """
    tb = default_tiebreak(df, key, order) if tiebreak is None else list(tiebreak)
    w = Window.partitionBy(key).orderBy(
        F.col(order).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tb])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
