"""Link events to their follow-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from needbridge.functions import flag
from needbridge.schemas import SERVICE_SLA_DAYS

c = F.col

LINKAGE_COLS = (
    "screening_id", "member_id", "scn_region", "county", "race_ethnicity", "risk_tier",
    "screening_date", "hrsn_flag", "primary_need_type", "needs_count",
)


def first_followups(followups: DataFrame, keys: Sequence[str] = ("member_id", "screening_id")) -> DataFrame:
    """Per key: earliest date, fewest days and count — independent minima (Q7).

    A plain aggregate, so the map side pre-combines: a screening with
    millions of services still ships one partial row per map task.
    """
    return followups.groupBy(*keys).agg(
        F.min("service_date").alias("first_service_date"),
        F.min("days_to_service").alias("days_to_first_service"),
        F.count(F.lit(1)).alias("total_services"),
    )


def link_first_followup(
    events: DataFrame,
    followups: DataFrame,
    keys: Sequence[str] = ("member_id", "screening_id"),
    sla_days: int = SERVICE_SLA_DAYS,
) -> DataFrame:
    """Each event with its first follow-up and the no-service / gap flags.

    The follow-ups are pre-aggregated to one row per key before the left
    join, so the join is 1:1 and cannot fan out.
    """
    fs = first_followups(followups, keys)
    j = events.select(*LINKAGE_COLS).join(fs, list(keys), "left")
    first, days, need = c("first_service_date"), c("days_to_first_service"), c("hrsn_flag")
    return j.select(
        *LINKAGE_COLS,
        "first_service_date",
        "days_to_first_service",
        F.coalesce(c("total_services"), F.lit(0).cast("long")).alias("total_services"),
        flag(need & first.isNull()).alias("no_service_flag"),
        flag(need & (first.isNull() | (days > sla_days))).alias("service_gap_flag"),
    )


# --- earliest follow-up on or after the event (README gap variant, J6) ------

def follow_up_days(followups: DataFrame, entity: str, follow_ts: str) -> DataFrame:
    """One row per entity: its distinct follow-up days, ascending.

    Reduced to distinct (entity, day) before anything is gathered, so a day
    with any number of follow-ups ships once per map task, and an array holds
    at most one element per calendar day.
    """
    days = followups.where(c(follow_ts).isNotNull() & c(entity).isNotNull()).select(
        c(entity).alias("__e"), c(follow_ts).alias("__f")).distinct()
    return days.groupBy("__e").agg(F.array_sort(F.collect_list("__f")).alias("__days"))


def first_at_or_after(days: F.Column, day: F.Column) -> F.Column:
    """Least element of the ascending array ``days`` that is not before ``day`` (null if none).

    A binary search: as many steps as the array's size has binary digits.
    """
    def halve(s, _):
        mid = ((s["lo"] + s["hi"]) / 2).cast("int")
        return F.when(s["lo"] >= s["hi"], s).when(
            F.get(days, mid) < day, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))
        ).otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))

    start = F.struct(F.lit(0).alias("lo"), F.size(days).alias("hi"))
    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(days))))
    return F.when(day.isNotNull() & days.isNotNull(),
                  F.aggregate(steps, start, halve, lambda s: F.get(days, s["lo"])))


def _by_running_minimum(events: DataFrame, followups: DataFrame, entity: str, ts: str, follow_ts: str,
                        group: Sequence[str]) -> DataFrame:
    """Running minimum in reverse date order over distinct events and follow-up days.

    At equal dates follow-ups come before events, so an event sees every
    follow-up on or after its date.  Both inputs are distinct, so an entity has at most
    (days × event groups) rows in its window.
    """
    e = events.select(*group).distinct().select(
        *group, c(ts).alias("__t"), F.lit(0).alias("__kind"), F.lit(None).cast("date").alias("__f"))
    f = followups.where(c(follow_ts).isNotNull() & c(entity).isNotNull()).select(
        c(entity), c(follow_ts).alias("__t"), F.lit(1).alias("__kind"), c(follow_ts).alias("__f")).distinct()
    w = Window.partitionBy(entity).orderBy(c("__t").desc_nulls_first(), c("__kind").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    scanned = e.unionByName(f, allowMissingColumns=True).withColumn("__first", F.min("__f").over(w))
    return scanned.where(c("__kind") == 0).select(*group, c("__first").alias("first_service_date"))


def first_followup_after(
    events: DataFrame,
    followups: DataFrame,
    entity: str = "member_id",
    ts: str = "screening_date",
    follow_ts: str = "service_date",
    group: Sequence[str] = ("member_id", "county", "primary_need_type", "screening_date"),
    method: str = "days",
) -> DataFrame:
    """Per event group: earliest ``follow_ts`` of the same entity on/after ``ts``.

    An event with a null date never matches (SQL ``>=``).  No pair of event
    and follow-up is formed, no job runs while the plan is built:

    * ``method='days'``: one sorted array of distinct days per entity, one
      left join, a binary search per event group;
    * ``method='scan'``: one window per entity over both inputs;
    * ``method='join'``: the literal range join followed by MIN, quadratic per
      entity; the tests' reference only.
    """
    group = list(group)
    if ts not in group or entity not in group:
        raise ValueError("group must contain the entity and the event timestamp")
    if method == "join":
        f = followups.select(c(entity).alias("__e"), c(follow_ts).alias("__f"))
        j = events.select(*group).join(
            f, (c(entity) == c("__e")) & (c("__f") >= c(ts)), "left")
        return j.groupBy(*group).agg(F.min("__f").alias("first_service_date"))
    if method == "scan":
        return _by_running_minimum(events, followups, entity, ts, follow_ts, group)
    if method != "days":
        raise ValueError(method)
    days = follow_up_days(followups, entity, follow_ts)
    j = events.select(*group).distinct().join(days, c(entity) == c("__e"), "left")
    return j.select(*group, first_at_or_after(c("__days"), c(ts)).alias("first_service_date"))
