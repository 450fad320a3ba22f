"""Marts: milestone performance, service-gap index, renewal risk.

Shared shape: reduce to one row per (group, member) first — a partial
aggregate that also collapses hot members map-side and needs no shuffle
when the input is already partitioned by member — then aggregate the
groups.  This replaces SQL's multiple COUNT(DISTINCT) (an Expand that
multiplies rows) by two ordinary aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from needbridge.functions import flag, pct, round_half_even, tier
from needbridge.operators.linkage import first_followup_after
from needbridge.operators.outcomes import linkage_per_member
from needbridge.schemas import (
    DISENROLLED,
    DY26_WINDOW,
    MILESTONE_DEFAULT,
    MILESTONE_TIERS,
    NOT_IDENTIFIED,
    SERVICE_SLA_DAYS,
)

c = F.col
#: Parts over which a share's grouped rows are spread to meet their total.
SHARE_PARTS = 16


def _in_window(ts: str, window: tuple[str, str]) -> F.Column:
    lo, hi = window
    return c(ts).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 2) -> DataFrame:
    """``ROUND(value * 100.0 / NULLIF(SUM(value) OVER (), 0), digits)``.

    ``df`` holds grouped rows, all different.  The total is one more grouping
    set of them, so what made them is evaluated once; the total's row is
    copied to each of a few parts of the rows, so they are never gathered
    into a single window partition.
    """
    cols = df.columns
    sets = df.groupingSets([[c(x) for x in cols], []], *cols).agg(
        F.sum(value).alias("__sum"), (F.grouping_id() != 0).alias("__is_total"))
    parts = F.when(c("__is_total"), F.sequence(F.lit(0), F.lit(SHARE_PARTS - 1))).otherwise(
        F.array(F.pmod(F.xxhash64(*cols), F.lit(SHARE_PARTS)).cast("int")))
    spread = sets.withColumn("__part", F.explode(parts))
    total = F.max(F.when(c("__is_total"), c("__sum"))).over(Window.partitionBy("__part"))
    return (spread.withColumn("__total", total).where(~c("__is_total"))
            .select(*cols, pct(value, "__total", digits).alias(out)))


def _screening_summary(ms: DataFrame, group: Sequence[str], window, ts: str) -> DataFrame:
    per_member = ms.groupBy(*group, "member_id").agg(
        F.bool_or(flag(_in_window(ts, window))).alias("__inw"),
        F.count_if(c("hrsn_flag")).alias("__hrsn"),
        F.sum("needs_count").alias("__ns"),
        F.count("needs_count").alias("__nc"),
    )
    return per_member.groupBy(*group).agg(
        F.count("member_id").alias("total_screened"),
        F.count_if(c("__inw") & c("member_id").isNotNull()).alias("screened_dy26"),
        F.sum("__hrsn").alias("hrsn_positive"),
        F.round(F.sum("__ns").cast("double") / F.nullif(F.sum("__nc"), F.lit(0)).cast("double"), 2)
        .alias("avg_needs_count"),
    )


def milestone_performance(
    members: DataFrame,
    member_screenings: DataFrame,
    group: Sequence[str] = ("scn_region",),
    window: tuple[str, str] = DY26_WINDOW,
    tiers=MILESTONE_TIERS,
    default_tier: str = MILESTONE_DEFAULT,
    ts: str = "screening_date",
) -> DataFrame:
    """Screening rate, prevalence, share of volume and milestone tier per group.

    Groups come from the member table; a group without screenings keeps
    NULL counts and falls to the default tier (Q8).  ``hrsn_positive``
    counts screening rows while the rate divides by members (Q4).
    """
    group = list(group)
    totals = members.groupBy(*group).agg(F.countDistinct("member_id").alias("total_members"))
    ss = _screening_summary(member_screenings, group, window, ts)
    j = totals.join(ss, group, "left")
    j = j.select(
        *group, "total_members", "total_screened", "screened_dy26", "hrsn_positive",
        "avg_needs_count",
        pct("total_screened", "total_members").alias("screening_rate_pct"),
        pct("hrsn_positive", "total_screened").alias("hrsn_prevalence_pct"),
    )
    j = share_of_total(j, "total_screened", "pct_of_state_volume")
    j = j.withColumn("dy26_milestone_status",
                     tier("screened_dy26", "total_members", tiers, default_tier))
    return j.orderBy(c("screening_rate_pct").desc_nulls_last(), *[c(g).asc_nulls_last() for g in group])


def milestone_by_screened(
    member_screenings: DataFrame,
    group: Sequence[str] = ("scn_region",),
    window: tuple[str, str] = DY26_WINDOW,
    tiers=MILESTONE_TIERS,
    default_tier: str = MILESTONE_DEFAULT,
    ts: str = "screening_date",
) -> DataFrame:
    """README variant: no member table; tier base = members screened (Q10)."""
    group = list(group)
    ss = _screening_summary(member_screenings, group, window, ts).select(
        *group, "total_screened", "screened_dy26",
        c("hrsn_positive").alias("members_with_need"))
    ss = share_of_total(ss, "total_screened", "pct_of_state_total")
    ss = ss.withColumn("dy26_milestone_status",
                       tier("screened_dy26", "total_screened", tiers, default_tier))
    return ss.orderBy(c("pct_of_state_total").desc_nulls_last(), *[c(g).asc_nulls_last() for g in group])


def _gap_metrics() -> list:
    return [
        F.count(F.lit(1)).alias("screened_with_need"),
        F.count_if(c("no_service_flag")).alias("no_service_count"),
        F.count_if(c("service_gap_flag")).alias("gap_within_30d_count"),
        F.avg("days_to_first_service").alias("__avg_days"),
    ]


def _gap_rates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *keys, "screened_with_need", "no_service_count", "gap_within_30d_count",
        pct("gap_within_30d_count", "screened_with_need").alias("service_gap_rate_pct"),
        pct("no_service_count", "screened_with_need").alias("no_service_rate_pct"),
        F.round("__avg_days", 1).alias("avg_days_to_service"),
    )


def _with_need(linkage: DataFrame, exclude_need: str | None) -> DataFrame:
    df = linkage.where(c("hrsn_flag"))
    if exclude_need is not None:
        df = df.where(c("primary_need_type") != exclude_need)
    return df


def gap_index(
    linkage: DataFrame,
    group: Sequence[str] = ("county", "scn_region", "primary_need_type"),
    exclude_need: str | None = NOT_IDENTIFIED,
) -> DataFrame:
    """Gap and no-service rates and mean days to first service per group."""
    group = list(group)
    agg = _with_need(linkage, exclude_need).groupBy(*group).agg(*_gap_metrics())
    return _gap_rates(agg, group).orderBy(
        c("service_gap_rate_pct").desc_nulls_last(), *[c(g).asc_nulls_last() for g in group])


def gap_rollup(
    linkage: DataFrame,
    group: Sequence[str] = ("county", "scn_region", "primary_need_type"),
    exclude_need: str | None = NOT_IDENTIFIED,
) -> DataFrame:
    """All roll-up levels of ``gap_index`` in one pass over the linkage.

    The finest groups are aggregated first; the roll-up expands those few rows, not
    the linkage.  ``grouping_level`` is the grouping id: bit i set = i-th
    key (from the right) rolled up.
    """
    group = list(group)
    finest = _with_need(linkage, exclude_need).groupBy(*group).agg(
        F.count(F.lit(1)).alias("__n"),
        F.count_if(c("no_service_flag")).alias("__none"),
        F.count_if(c("service_gap_flag")).alias("__gap"),
        F.sum("days_to_first_service").alias("__days"),
        F.count("days_to_first_service").alias("__served"))
    agg = finest.rollup(*group).agg(
        F.sum("__n").alias("screened_with_need"), F.sum("__none").alias("no_service_count"),
        F.sum("__gap").alias("gap_within_30d_count"),
        (F.sum("__days") / F.nullif(F.sum("__served"), F.lit(0))).alias("__avg_days"),
        F.grouping_id().cast("long").alias("grouping_level"))
    return _gap_rates(agg, [*group, "grouping_level"])


def gap_after_screening(
    member_screenings: DataFrame,
    services: DataFrame,
    group: Sequence[str] = ("county", "primary_need_type"),
    sla_days: int = SERVICE_SLA_DAYS,
    method: str = "days",
) -> DataFrame:
    """README gap variant (T15): any service of the member on/after the date.

    Keeps 'Not Identified' needs (Q14); repeat screenings of one member on
    one day with the same county and need count once (Q13).
    """
    ev = member_screenings.where(c("hrsn_flag"))
    linked = first_followup_after(ev, services, method=method)
    late = c("first_service_date").isNull() | (
        F.datediff(c("first_service_date"), c("screening_date")) > sla_days)
    agg = linked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("screened_with_need"),
        F.count_if(late).alias("unmet_within_30d"),
    )
    rate = round_half_even(c("unmet_within_30d").cast("double")
                   / F.nullif(c("screened_with_need"), F.lit(0)).cast("double") * F.lit(100.0), 2)
    return agg.withColumn("service_gap_rate_pct", rate).orderBy(
        c("service_gap_rate_pct").desc_nulls_last(), *[c(g).asc_nulls_last() for g in group])


def _risk_rates(per_member: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sum one row per (group, member) of the four counts up to the groups, with rates."""
    agg = per_member.groupBy(*group).agg(
        F.count("member_id").alias("total_members"),
        F.sum("__lapsed").alias("coverage_lapsed"),
        F.sum("__hrsn").alias("hrsn_positive"),
        F.sum("__unmet").alias("lapsed_with_unmet_hrsn"),
        F.sum("__barrier").alias("lapsed_language_barrier"),
    )
    out = agg.select(
        *group, "total_members", "coverage_lapsed", "hrsn_positive", "lapsed_with_unmet_hrsn",
        "lapsed_language_barrier",
        pct("coverage_lapsed", "total_members").alias("disenrollment_rate_pct"),
        pct("lapsed_with_unmet_hrsn", "total_members").alias("high_risk_rate_pct"),
    )
    return out.orderBy(c("high_risk_rate_pct").desc_nulls_last(), *[c(g).asc_nulls_last() for g in group])


def _grain(counts: Sequence, grain: str) -> list:
    """Row counts summed, or each member once per flag (1 where any row counts)."""
    if grain not in ("row", "member"):
        raise ValueError(grain)
    names = ("__lapsed", "__hrsn", "__unmet", "__barrier")
    if grain == "row":
        return [F.sum(x).alias(n) for x, n in zip(counts, names)]
    return [F.max((x > 0).cast("long")).alias(n) for x, n in zip(counts, names)]


_RISK_GROUP = ("county", "scn_region", "race_ethnicity")


def risk_intersection(
    outcomes: DataFrame,
    members: DataFrame,
    group: Sequence[str] = _RISK_GROUP,
    grain: str = "row",
) -> DataFrame:
    """Lapse and lapse-with-need rates per group (T11), from the fanned-out outcomes.

    ``grain='row'`` reproduces the reference: flags are summed over the
    fanned-out renewal × screening rows but divided by distinct members
    (Q5), so a rate can exceed 100.  ``grain='member'`` counts each member
    once per flag.
    """
    group = list(group)
    base = outcomes.join(members.select("member_id", "race_ethnicity"), "member_id", "left")
    flags = (c("is_disenrolled"), c("hrsn_flag"), c("lapsed_and_unmet_hrsn"),
             c("language_barrier_flag") & c("is_disenrolled"))
    counts = [flag(x).cast("long") for x in flags]
    return _risk_rates(base.groupBy(*group, "member_id").agg(*_grain(counts, grain)), group)


def risk_from_linkage(
    renewals: DataFrame,
    linkage: DataFrame,
    members: DataFrame,
    group: Sequence[str] = _RISK_GROUP,
    grain: str = "row",
    unmet: str = "need",
) -> DataFrame:
    """``risk_intersection`` of the outcome join without forming its fan-out.

    A renewal of a member with k linked screenings stands for max(k, 1) joined
    rows, so counts per member (one partial aggregate of the linkage) replace
    the join's rows: renewals, counts and members meet 1:1, no key is hot.
    """
    group = list(group)
    link = linkage_per_member(linkage, unmet)
    base = renewals.join(link, "member_id", "left").join(
        members.select("member_id", "race_ethnicity"), "member_id", "left")
    rows = F.greatest(F.coalesce(c("link_rows"), F.lit(0)), F.lit(1))
    lapsed = flag(c("is_disenrolled")).cast("long")
    barrier = flag(c("language_barrier_flag") & c("is_disenrolled")).cast("long")
    counts = (lapsed * rows, F.coalesce(c("link_need"), F.lit(0)),
              lapsed * F.coalesce(c("link_unmet"), F.lit(0)), barrier * rows)
    return _risk_rates(base.groupBy(*group, "member_id").agg(*_grain(counts, grain)), group)


def _risk_of_pairs(members: DataFrame, sides: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group: members, lapsed pairs, lapsed pairs with need, from pair counts per member.

    ``sides``: one row per member with the rows of the outcome side that lapsed
    (``__rl``) and the screening rows, all (``__sn``) and with a need (``__sh``).
    """
    group = list(group)
    m = members.groupBy("member_id", *group).agg(F.count(F.lit(1)).alias("__mk"))
    j = m.join(sides, "member_id", "left")
    lapsed = c("__mk") * F.coalesce(c("__rl"), F.lit(0))
    s_rows = F.greatest(F.coalesce(c("__sn"), F.lit(0)), F.lit(1))
    agg = j.groupBy(*group).agg(
        # (member, group) rows are unique here, so count == count distinct
        F.count("member_id").alias("total_members"),
        F.sum(lapsed * s_rows).alias("coverage_lapsed"),
        F.sum(lapsed * F.coalesce(c("__sh"), F.lit(0))).alias("lapsed_with_unmet_hrsn"),
    )
    rate = round_half_even(c("lapsed_with_unmet_hrsn").cast("double")
                   / F.nullif(c("total_members"), F.lit(0)).cast("double") * F.lit(100.0), 2)
    return agg.withColumn("high_risk_rate_pct", rate).orderBy(
        c("high_risk_rate_pct").desc_nulls_last(), *[c(g).asc_nulls_last() for g in group])


def risk_from_members(
    members: DataFrame,
    outcomes: DataFrame,
    member_screenings: DataFrame,
    group: Sequence[str] = ("county", "race_ethnicity"),
    lapsed_value: str = DISENROLLED,
) -> DataFrame:
    """README risk variant (T16): members ⟕ outcomes ⟕ screenings on member.

    The literal form joins two per-screening tables on ``member_id`` only,
    so a member with N of each yields N² rows and the sums count them
    (Q17).  Each side is first counted per member and the products are
    summed instead — same numbers, no quadratic blow-up, and the three
    inputs meet as 1:1 joins.
    """
    r = outcomes.groupBy("member_id").agg(
        F.count_if(c("renewal_outcome") == lapsed_value).alias("__rl"))
    s = member_screenings.groupBy("member_id").agg(
        F.count(F.lit(1)).alias("__sn"),
        F.count_if(c("hrsn_flag")).alias("__sh"))
    return _risk_of_pairs(members, r.join(s, "member_id", "full"), group)


def risk_from_members_linkage(
    members: DataFrame,
    renewals: DataFrame,
    linkage: DataFrame,
    group: Sequence[str] = ("county", "race_ethnicity"),
    lapsed_value: str = DISENROLLED,
) -> DataFrame:
    """``risk_from_members`` for the outcomes of ``renewals`` and ``linkage``.

    The linkage has one row per member screening, so its counts per member
    give both sides: a renewal makes max(k, 1) outcome rows, and k screening
    rows meet each.  Linkage and renewals are evaluated once, no fan-out is formed.
    """
    r = renewals.groupBy("member_id").agg(
        F.count_if(c("renewal_outcome") == lapsed_value).alias("__lapsed"))
    j = r.join(linkage_per_member(linkage), "member_id", "full")
    rows = F.greatest(F.coalesce(c("link_rows"), F.lit(0)), F.lit(1))
    sides = j.select("member_id", (c("__lapsed") * rows).alias("__rl"),
                     c("link_rows").alias("__sn"), c("link_need").alias("__sh"))
    return _risk_of_pairs(members, sides, group)
