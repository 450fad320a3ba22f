"""Merge a batch of submissions into a table of latest records.

The kept table is partitioned by ranges of its key.  A batch rewrites only the
ranges it touches, by dynamic partition overwrite; all others are not read.
The latest record of a key does not depend on how its records were batched
(the order is total), so merging batch by batch gives the rows of one full run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from needbridge.operators.dedupe import dedupe_latest
from needbridge.sources.manifest import children

RANGE = "key_range"


def id_range(key: str, digits: int = 4) -> Column:
    """Ids that differ in their last ``digits`` characters only share a range; consecutive ids do."""
    k = F.col(key)
    return F.coalesce(F.substring(k, F.lit(1), F.greatest(F.length(k) - digits, F.lit(0))), F.lit(""))


def merge_latest(path: str, batch: DataFrame, key: str = "screening_id", order: str = "screening_date",
                 tiebreak: Sequence[str] | None = None, range_of: Column | None = None) -> None:
    """Bring ``batch`` into the latest-record table at ``path`` (created if absent).

    Rows of the table and the batch that share a key compete as in
    ``dedupe_latest``.  The touched ranges are found by a distinct over the
    batch's keys and prune the table's partitions.
    """
    spark = batch.sparkSession
    new = batch.withColumn(RANGE, id_range(key) if range_of is None else range_of)
    rows = new
    if any(not n.startswith("_") for n in children(spark, path)):
        kept = spark.read.schema(new.schema).parquet(path)
        touched = new.select(RANGE).distinct()
        rows = kept.join(touched, RANGE, "left_semi").select(*new.columns).unionByName(new)
    latest = dedupe_latest(rows, key, order, tiebreak)
    latest.repartition(RANGE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        RANGE).parquet(path)


def read_latest(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(RANGE)
