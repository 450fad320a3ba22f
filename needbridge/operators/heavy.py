"""Heavy keys of a join: a bounded list with exact counts, and the salts it gives.

``heavy_keys`` finds every key that holds more than a share of the rows.  A
frequent-items summary (mergeable, of bounded size, built by one narrow
partial aggregate) proposes candidates; an exact count of just those decides.
At most ``1 / share`` keys can qualify, which bounds the list whatever the
size of the table.  A key that is null never joins and is never heavy.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy above this share of all rows, and above this number of rows.
DEFAULT_SHARE, MIN_ROWS = 0.001, 1_000_000
# The summary of M items misses no key above 3.5 / M of the rows.
_SUMMARY_ERROR = 3.5
_MOST_ITEMS, _MOST_CANDIDATES = 1_000_000, 100_000


class HeavyKeys(NamedTuple):
    """Keys of ``column`` with the number of salts each is spread over."""

    column: str
    parts: dict


def heavy_keys(df: DataFrame, key: str, share: float = DEFAULT_SHARE, min_rows: int = MIN_ROWS,
               candidates_from: DataFrame | None = None) -> HeavyKeys:
    """Keys that hold more than ``share`` of the rows and more than ``min_rows`` rows, exactly.

    The summary is built on ``candidates_from``, a cheaper table that holds
    every row's key at least as often (default: ``df``), and shares are of its
    rows.  Only if it has candidates are those counted in ``df``.
    """
    tracked = min(_MOST_ITEMS, 1 << max(4, int(2 * _SUMMARY_ERROR / share) - 1).bit_length())
    most = min(_MOST_CANDIDATES, tracked, int(2 / share) + 1)
    rows = (df if candidates_from is None else candidates_from).where(F.col(key).isNotNull()).select(key)
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.call_function(
        "approx_top_k", F.col(key), F.lit(most), F.lit(tracked)).alias("top")).first()
    floor = max(1, int(max(seen["n"] * share, min_rows)))
    # estimates never fall short by more than the error, which is below half the share
    asked = [t["item"] for t in seen["top"] or [] if t["count"] > floor / 2]
    if not asked:
        return HeavyKeys(key, {})
    exact = df.where(F.col(key).isin(asked)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return HeavyKeys(key, {r[key]: max(2, -(-r["n"] // floor)) for r in exact.where(F.col("n") > floor).collect()})


def _parts(heavy: HeavyKeys) -> Column:
    """Number of salts of a row's key: one unless it is heavy."""
    k = F.col(heavy.column)
    if not heavy.parts:
        return F.lit(1)
    known = F.map_from_arrays(F.array(*[F.lit(v) for v in heavy.parts]), F.array(*[F.lit(v) for v in heavy.parts.values()]))
    return F.when(k.isin(list(heavy.parts)), F.element_at(known, k)).otherwise(F.lit(1))


def salted_left_join(left: DataFrame, right: DataFrame, heavy: HeavyKeys) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``heavy.column``; heavy keys of ``right`` meet in several tasks.

    Rows of ``right`` with a heavy key are spread over salts by the hash of the
    row; the rows of ``left`` with that key are copied to each salt.  A copy
    that meets nothing at its salt is dropped: a heavy key has rows in ``right``
    (``heavy`` is counted on it), so no row of ``left`` is lost.  Both sides are
    evaluated once.
    """
    if not heavy.parts:
        return left.join(right, heavy.column, "left")
    parts = _parts(heavy)
    spread = right.withColumn("__salt", F.pmod(F.xxhash64(*right.columns), parts).cast("int")).withColumn(
        "__met", F.lit(True))
    copied = left.withColumn("__heavy", parts > 1).withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return copied.join(spread, [heavy.column, "__salt"], "left").where(
        ~F.col("__heavy") | F.col("__met")).drop("__salt", "__heavy", "__met")
