"""Put each entity's events in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from needbridge.operators.skew import (
    CHUNK,
    DEFAULT_HOT_ROWS,
    MAX_BROADCAST_KEYS,
    bounded,
    range_chunks,
    split_hot,
)
from needbridge.sources.lookup import checked_broadcast

c = F.col


def _order(ts: str, tiebreak: Sequence[str]):
    # one explicit spec for both row_number and lag (Q3): nulls last
    return [c(ts).asc_nulls_last(), *[c(t).asc_nulls_last() for t in tiebreak]]


def _plain(df: DataFrame, entity: str, ts: str, tiebreak, seq_col: str, prior_col: str) -> DataFrame:
    w = Window.partitionBy(entity).orderBy(*_order(ts, tiebreak))
    return (df.withColumn(seq_col, F.row_number().over(w).cast("long"))
            .withColumn(prior_col, F.lag(ts).over(w)))


def _chunked(df: DataFrame, entity: str, ts: str, tiebreak, seq_col: str, prior_col: str,
             num_chunks: int, n_hot: int) -> DataFrame:
    order = _order(ts, tiebreak)
    r = range_chunks(df, entity, order, num_chunks)
    w = Window.partitionBy(entity, CHUNK).orderBy(*order)
    local = r.withColumn("__rn", F.row_number().over(w)).withColumn("__lag", F.lag(ts).over(w))
    summary = local.groupBy(entity, CHUNK).agg(
        F.count(F.lit(1)).alias("__n"), F.max_by(c(ts), c("__rn")).alias("__last"))
    wc = Window.partitionBy(entity).orderBy(CHUNK)
    carry = summary.select(
        entity, CHUNK,
        F.coalesce(F.sum("__n").over(wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("__off"),
        F.lag("__last").over(wc).alias("__prev"),
    )
    # carry has <= (#hot entities + #chunks) rows
    out = local.join(bounded(carry, n_hot + num_chunks), [entity, CHUNK])
    return (out.withColumn(seq_col, (c("__rn") + c("__off")).cast("long"))
            .withColumn(prior_col, F.when(c("__rn") == 1, c("__prev")).otherwise(c("__lag")))
            .drop("__rn", "__lag", "__off", "__prev", CHUNK))


def sequence_events(
    df: DataFrame,
    entity: str = "member_id",
    ts: str = "screening_date",
    tiebreak: Sequence[str] = ("screening_id",),
    seq_col: str = "screening_seq",
    prior_col: str = "prior_screening_date",
    hot_key_rows: int | None = DEFAULT_HOT_ROWS,
    num_chunks: int | None = None,
    counts_from: DataFrame | None = None,
) -> DataFrame:
    """Add a 1-based sequence number and the previous timestamp per entity.

    Order: ``ts`` ascending with nulls last, then ``tiebreak``.  Entities
    with more than ``hot_key_rows`` rows are scanned in range chunks (see
    ``needbridge.operators.skew``); ``hot_key_rows=None`` uses the plain
    window only.  ``counts_from``: a cheaper superset of ``df`` to find hot
    entities on.
    """
    tiebreak = list(tiebreak)
    if hot_key_rows is None:
        return _plain(df, entity, ts, tiebreak, seq_col, prior_col)
    cold, hot, chunks, n_hot, _ = split_hot(df, entity, hot_key_rows, counts_from)
    a = _plain(cold, entity, ts, tiebreak, seq_col, prior_col)
    if hot is None:
        return a
    n = num_chunks or chunks
    b = _chunked(hot, entity, ts, tiebreak, seq_col, prior_col, n, n_hot).select(*a.columns)
    return a.unionByName(b)


MEMBER_ATTRS = (
    "race_ethnicity", "age", "is_child", "is_senior", "eligibility_group",
    "risk_tier", "managed_care_plan", "primary_language",
)
SCREENING_ATTRS = (
    "scn_region", "county", "screening_date", "screening_tool", "hrsn_flag",
    "primary_need_type", "needs_count", "food_insecurity", "housing_instability",
    "transportation_need", "utility_need", "interpersonal_safety",
)


def member_screenings(
    screenings: DataFrame,
    members: DataFrame,
    hot_key_rows: int | None = DEFAULT_HOT_ROWS,
    num_chunks: int | None = None,
    counts_from: DataFrame | None = None,
) -> DataFrame:
    """Valid deduplicated screenings joined to their member, in sequence.

    Cold members: inner sort-merge join on ``member_id`` and the sequence
    window, which reuses the join's partitioning — one shuffle for both.

    Hot members are split off *before* the join: a sort-merge join would
    put a hot member's rows into one task (adaptive execution will not
    split it, since that would force another shuffle under the window).
    Their rows instead meet a broadcast of just the hot members'
    attributes (size-checked) and go to the range-chunked scan.  Hot
    members are found on ``counts_from`` (default: the valid screenings);
    pass the staged, not yet deduplicated screenings to make that check one
    narrow scan with a partial aggregate.  If there are any, the valid
    screenings are checkpointed, so that both parts read them and the
    deduplication before them runs once.
    """
    s = screenings.where(~c("null_date_flag") & ~c("null_member_flag"))
    m = members.select("member_id", *MEMBER_ATTRS)
    cols = ["screening_id", "member_id", *MEMBER_ATTRS, *SCREENING_ATTRS]
    if hot_key_rows is None:
        return sequence_events(s.join(m, "member_id").select(*cols), hot_key_rows=None)
    source = (counts_from if counts_from is not None else s).select("member_id")
    _, _, chunks, n_hot, keys = split_hot(s, "member_id", hot_key_rows, source)
    if keys is None:
        return sequence_events(s.join(m, "member_id").select(*cols), hot_key_rows=None)
    s = s.select("screening_id", "member_id", *SCREENING_ATTRS).checkpoint(eager=True)
    cold_s, hot_s = s.join(keys, "member_id", "left_anti"), s.join(keys, "member_id", "left_semi")
    cold = sequence_events(cold_s.join(m, "member_id").select(*cols), hot_key_rows=None)
    hot_members = checked_broadcast(m.join(keys, "member_id", "left_semi"), MAX_BROADCAST_KEYS)
    hot = hot_s.join(hot_members, "member_id").select(*cols)
    seq = _chunked(hot, "member_id", "screening_date", ["screening_id"], "screening_seq",
                   "prior_screening_date", num_chunks or chunks, n_hot)
    return cold.unionByName(seq.select(*cold.columns))
