"""Hot-key handling for ordered per-entity scans.

A window ``PARTITION BY member_id ORDER BY ...`` sends every row of one
member to one task.  If a single member held a third of all rows, that one
task would do a third of the job.  Ordered scans (row numbers, lags,
running minima) are therefore split in two:

* **cold** entities (at most ``threshold`` rows) keep the plain window —
  one hash shuffle, and none at all when the input is already partitioned
  by the entity (e.g. straight after a sort-merge join on it);
* **hot** entities are range-partitioned on ``(entity, order...)`` so a hot
  entity's rows are cut into contiguous chunks that land in different
  tasks.  Each chunk is scanned locally; a small per-(entity, chunk)
  summary — at most ``#hot entities + #chunks`` rows — carries counts and
  boundary values from one chunk to the next and is joined back by
  broadcast.

The hot-key list comes from a partially aggregated count, so building it
never moves a hot group; it holds at most ``rows / threshold`` keys, which
is the proven bound that makes its broadcast safe.

The chunk id is the range partition id.  Range bounds are sampled, and
the sample depends on row order after a shuffle, so two evaluations of the
same plan may cut differently.  The chunk-tagged hot rows are therefore
materialised once with a reliable ``checkpoint()`` (in the shared
``spark.checkpoint.dir``) before the local scan and the summary both read
them — consistent, and safe when an executor is lost.  When no key is hot
(the usual case, found by one bounded existence check) nothing is
checkpointed and the plan is the plain window.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from needbridge.session import ensure_checkpoint_dir

CHUNK = "__chunk"
DEFAULT_HOT_ROWS = 2_000_000

# Tasks much smaller than this cost more in scheduling than they save.
MIN_CHUNK_ROWS = 1_000_000
# Largest key list / carry table sent by broadcast; beyond it, shuffle joins.
MAX_BROADCAST_KEYS = 1_000_000


def bounded(df: DataFrame, rows: int):
    """Broadcast hint for a side whose row count ``rows`` is already known."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_KEYS else df


def hot_keys(df: DataFrame, key: str, threshold: int) -> DataFrame:
    """Keys with more than ``threshold`` rows (<= rows/threshold of them), with counts; a null is no key."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > threshold))


class HotSplit(NamedTuple):
    cold: DataFrame          # rows of cold keys
    hot: DataFrame | None    # rows of hot keys, None when no key is hot
    chunks: int              # suggested number of range chunks for the hot rows
    n_hot: int               # number of hot keys
    keys: DataFrame | None   # the hot keys (broadcast-hinted when small enough)


def split_hot(df: DataFrame, key: str, threshold: int,
              counts_from: DataFrame | None = None) -> HotSplit:
    """Split ``df`` into the rows of cold and of hot keys.

    ``counts_from`` may name a cheaper superset of ``df`` (e.g. the raw
    table before deduplication and joins) to count keys on; a key counted
    hot there but not in ``df`` just takes the exact chunked path.
    Both filters are broadcast hash joins against the bounded hot-key list,
    so the cold side keeps whatever partitioning ``df`` already has.
    The chunk count aims at about ``max(threshold, MIN_CHUNK_ROWS)`` rows
    per chunk, so a chunk of a hot key is no larger than the largest cold
    group (or one modest task).  The hot-key list is checkpointed, so the rows
    it counts are computed once however often it is joined; a two-number
    aggregate over it decides all of this.
    """
    ensure_checkpoint_dir(df.sparkSession)
    counts = hot_keys(counts_from if counts_from is not None else df, key, threshold).checkpoint(eager=True)
    stats = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("__n").alias("rows")).first()
    k = int(stats["k"] or 0)
    if not k:
        return HotSplit(df, None, 0, 0, None)
    per_chunk = max(threshold, MIN_CHUNK_ROWS)
    chunks = int(max(2, -(-stats["rows"] // per_chunk)))
    hot = bounded(counts.select(key), k)  # size known: k keys
    return HotSplit(df.join(hot, key, "left_anti"), df.join(hot, key, "left_semi"), chunks, k, hot)


def range_chunks(df: DataFrame, key: str, order: list[Column], num_chunks: int) -> DataFrame:
    """Range-partition on ``(key, order...)``, tag rows with their chunk, materialise.

    Partition ids of a range exchange ascend with the sort key, so the
    chunks of one entity are contiguous and ordered.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (df.repartitionByRange(num_chunks, F.col(key).asc_nulls_first(), *order)
              .withColumn(CHUNK, F.spark_partition_id()))
    return tagged.checkpoint(eager=True)

