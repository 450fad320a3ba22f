"""Join renewal outcomes to service linkage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.functions import flag
from needbridge.operators.heavy import HeavyKeys, salted_left_join

c = F.col

RENEWAL_COLS = (
    "renewal_id", "member_id", "county", "scn_region", "risk_tier", "eligibility_group",
    "renewal_date", "renewal_outcome", "is_disenrolled", "disenrollment_reason",
    "outreach_attempts", "language_barrier_flag",
)
LINK_COLS = ("hrsn_flag", "primary_need_type", "needs_count", "service_gap_flag", "no_service_flag")


def unmet_need(unmet: str) -> F.Column:
    """The flag that makes a lapse a lapse with need: any need found, or a service gap (Q6)."""
    if unmet not in ("need", "gap"):
        raise ValueError(unmet)
    return c("hrsn_flag") if unmet == "need" else c("service_gap_flag")


def join_outcomes(
    renewals: DataFrame,
    linkage: DataFrame,
    unmet: str = "need",
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Renewals LEFT JOIN linkage on ``member_id`` (fans out per screening, Q5).

    ``lapsed_and_unmet_hrsn`` = disenrolled and the screening found a need
    (the reference ignores whether a service followed, Q6); ``unmet='gap'``
    uses the service-gap flag instead.

    Skew: a member with very many screenings makes one hot key on the
    *right* side, which adaptive execution cannot split for a left outer
    join.  ``heavy`` (from ``heavy_keys(linkage, "member_id")``) salts just
    those members; all others meet in the one plain left join.  Each input is
    evaluated once either way.  Marts that only count the fanned-out rows
    need not form them (``risk_from_linkage``).
    """
    r = renewals.select(*RENEWAL_COLS)
    link = linkage.select("member_id", *LINK_COLS, "screening_id")
    j = salted_left_join(r, link, heavy or HeavyKeys("member_id", {}))
    return j.select(
        *RENEWAL_COLS, *LINK_COLS,
        flag(c("is_disenrolled") & unmet_need(unmet)).alias("lapsed_and_unmet_hrsn"),
    )


def linkage_per_member(linkage: DataFrame, unmet: str = "need") -> DataFrame:
    """Per member: linked screenings, those with a need, those that make a lapse count.

    A plain aggregate: a member with millions of screenings ships one partial
    row per map task, and none at all where the linkage is partitioned by
    member already.
    """
    return linkage.groupBy("member_id").agg(
        F.count(F.lit(1)).alias("link_rows"),
        F.count_if(c("hrsn_flag")).alias("link_need"),
        F.count_if(unmet_need(unmet)).alias("link_unmet"))
