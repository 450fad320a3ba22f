"""Exact distinct counts that merge: bitmaps over dense numbers.

``COUNT(DISTINCT key)`` at several levels would expand every detail row once per
level.  Here every key gets a dense number, the finest groups hold bitmaps of the
numbers they met, and coarser levels are unions of those bitmaps: detail rows
are aggregated once, and only bitmaps are expanded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a bitmap (fixed by Spark's bitmap functions).
BITS = 32_768


def distinct_rollup(df: DataFrame, key: str, group: Sequence[str], out: str, parts: int | None = None) -> DataFrame:
    """Distinct non-null ``key`` values at every roll-up level of ``group``: group, grouping_level, out.

    ``grouping_level`` is the grouping id: bit i set = i-th key (from the
    right) rolled up.  Keys are numbered within ``parts`` parts by hash
    (default: the session's shuffle partitions), by their order, so a
    recomputed task gives the same numbers; a part's (group, key) pairs meet
    in one task.
    """
    group = list(group)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = F.col(key)
    # a key that fills a third of the rows is one row per group from here on
    met = df.select(*group, key).distinct().withColumn("__part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    number = F.dense_rank().over(Window.partitionBy("__part").orderBy(key)) - 1
    numbered = met.withColumn("__number", F.when(k.isNotNull(), number).cast("long"))
    finest = numbered.groupBy(*group, "__part", F.floor(F.col("__number") / BITS).alias("__slice")).agg(
        F.bitmap_construct_agg(F.col("__number") % BITS).alias("__bits"))
    sets = [[*map(F.col, group[:n]), F.col("__part"), F.col("__slice")] for n in range(len(group), -1, -1)]
    merged = finest.groupingSets(sets, *group, "__part", "__slice").agg(
        F.bitmap_or_agg("__bits").alias("__bits"), F.shiftright(F.grouping_id(), 2).cast("long").alias("grouping_level"))
    return merged.groupBy(*group, "grouping_level").agg(F.sum(F.bitmap_count("__bits")).alias(out))
