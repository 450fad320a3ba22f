"""Key-hash sampling.

The first 32 bits of the MD5 of a row's key and the seed decide, so a sample
depends on the keys alone: it is repeatable when partitions are recomputed
after an executor loss, other engines draw the same rows, and all rows of one
key are kept or dropped together.  Rates need no shuffle; exact sizes need one
narrow count.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Digests fall into this many equal ranges; a sample of exact size sorts the rows of one range only.
RANGES = 65_536
_SPACE = float(1 << 32)


def _digest(key: str, seed: int) -> Column:
    """Hex MD5 of ``key:seed``, null for a null key."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def _position(key: str, seed: int) -> Column:
    """The digest's first 32 bits as a number."""
    return F.conv(F.substring(_digest(key, seed), 1, 8), 16, 10).cast("long")


def stratified_sample(df: DataFrame, stratum: str, rates: Mapping[str, float], key: str,
                      default_rate: float = 0.0, seed: int = 42) -> DataFrame:
    """Keep each row with the rate of its stratum (e.g. a risk tier)."""
    rate = F.lit(float(default_rate))
    for value, r in rates.items():
        rate = F.when(F.col(stratum) == value, F.lit(float(r))).otherwise(rate)
    return df.where(_position(key, seed) < rate * _SPACE)


def sample_share(df: DataFrame, share: float, key: str, seed: int = 7) -> DataFrame:
    """Keep about ``share`` of the keys (within sampling error)."""
    return df.where(_position(key, seed) < F.lit(float(share) * _SPACE))


def sample_exact(df: DataFrame, size: int, key: str, seed: int = 11, stratum: str | None = None) -> DataFrame:
    """Exactly ``size`` rows (all, if there are fewer), of each ``stratum`` if one is given.

    The rows with the least digests; ``key`` must be unique, rows without one
    are never drawn.  A histogram of digest ranges (at most ``RANGES`` rows
    a stratum) finds the range in which the sample ends; ranges before it are
    kept whole, and only the rows of that one range are sorted.
    """
    if size <= 0:
        return df.where(F.lit(False))
    group = [stratum] if stratum else []
    keyed = df.where(F.col(key).isNotNull()).withColumn("__digest", _digest(key, seed)).withColumn(
        "__range", F.floor(_position(key, seed) / (_SPACE / RANGES)).cast("int"))
    upto = Window.partitionBy(*group).orderBy("__range")
    ranges = keyed.groupBy(*group, "__range").agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__before", F.sum("__n").over(upto) - F.col("__n"))
    last = ranges.where((F.col("__before") < size) & (F.col("__before") + F.col("__n") >= size)).select(
        *[F.col(g).alias("__stratum") for g in group], F.col("__range").alias("__last"), "__before")
    same = F.col(stratum).eqNullSafe(F.col("__stratum")) if stratum else F.lit(True)
    # one row a stratum: where the sample ends; a stratum without one is kept whole
    j = keyed.join(last if stratum else F.broadcast(last), same, "left")
    inside = F.col("__last").isNull() | (F.col("__range") < F.col("__last"))
    whole = j.where(inside)
    edge = j.where(F.col("__range") == F.col("__last")).withColumn("__rank", F.row_number().over(
        Window.partitionBy(*group, "__range").orderBy("__digest", key))).where(
        F.col("__rank") <= size - F.col("__before"))
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))
