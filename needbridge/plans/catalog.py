"""Registered queries over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the whole driver tables (via ``needbridge.sources.driver``).  The SQL twins
live in ``needbridge.plans.oracle`` under the same names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from needbridge import operators as ops
from needbridge.operators import quality as dq
from needbridge.operators import reporting as rep
from needbridge.operators import sampling as smp
from needbridge.operators.increment import merge_latest, read_latest
from needbridge.plans.pipeline import mart_order, open_run, quality_suite, run_pipeline
from needbridge.plans.stages import Stages
from needbridge.schemas import NEED_TYPES, SAMPLE_RATES
from needbridge.session import ensure_checkpoint_dir
from needbridge.sources import driver
from needbridge.sources.lookup import lookup
from needbridge.sources import raw as rawsrc
from needbridge.sources.sinks import export_csv

# Milestone window for the driver data (its order dates span 1995–2001).
DRIVER_WINDOW = ("1997-01-01", "1997-03-31")
AS_OF = "2025-01-01"
# Threshold used by the *_hot_split queries: low enough that the driver's
# busiest members take the range-chunked path, so the gate checks it.
SPLIT_TEST_ROWS, SPLIT_TEST_CHUNKS = 8, 24
SAMPLE_SIZE = 250

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def stages(spark: SparkSession, sf_dir: str, **kw) -> Stages:
    return Stages(driver.load_all(spark, sf_dir), window=DRIVER_WINDOW, **kw)


# --- staging ---------------------------------------------------------------
@query
def stg_members(spark, d):
    return stages(spark, d).stg_members


@query
def stg_screenings(spark, d):
    return stages(spark, d).stg_screenings


@query
def stg_services(spark, d):
    return stages(spark, d).stg_services


@query
def stg_renewals(spark, d):
    return stages(spark, d).stg_renewals


# --- intermediate ----------------------------------------------------------
@query
def dedupe_latest(spark, d):
    return stages(spark, d).int_screenings_deduped


@query
def sequence_events(spark, d):
    return stages(spark, d).int_member_screenings


@query
def sequence_hot_split(spark, d):
    """Same as ``sequence_events`` with the busiest members range-chunked."""
    s = stages(spark, d)
    return ops.member_screenings(s.int_screenings_deduped, s.stg_members,
                             hot_key_rows=SPLIT_TEST_ROWS, num_chunks=SPLIT_TEST_CHUNKS,
                             counts_from=s.stg_screenings)


@query
def link_first_followup(spark, d):
    return stages(spark, d).int_service_linkage


@query
def outcome_join(spark, d):
    return stages(spark, d).int_renewal_hrsn


# --- marts -----------------------------------------------------------------
@query
def milestone_performance(spark, d):
    return stages(spark, d).mart_scn_performance


@query
def milestone_by_screened(spark, d):
    return ops.milestone_by_screened(stages(spark, d).int_member_screenings, window=DRIVER_WINDOW)


@query
def share_of_total(spark, d):
    ms = stages(spark, d).int_member_screenings
    vol = ms.groupBy("county").agg(F.count(F.lit(1)).alias("screenings"))
    return ops.share_of_total(vol, "screenings", "pct_of_screenings")


@query
def gap_index(spark, d):
    return stages(spark, d).mart_service_gap_index


@query
def gap_by_need(spark, d):
    return ops.gap_index(stages(spark, d).int_service_linkage, ["primary_need_type"])


@query
def gap_by_county(spark, d):
    return ops.gap_index(stages(spark, d).int_service_linkage, ["county"])


@query
def gap_grouping_sets(spark, d):
    return ops.gap_rollup(stages(spark, d).int_service_linkage)


@query
def followup_after_range(spark, d):
    s = stages(spark, d)
    return ops.gap_after_screening(s.int_member_screenings, s.stg_services)


@query
def followup_after_join(spark, d):
    """The same result by a window over events and follow-up days in date order."""
    s = stages(spark, d)
    return ops.gap_after_screening(s.int_member_screenings, s.stg_services, method="scan")


@query
def followup_hot_split(spark, d):
    """First service per event group; a member's days are one array, its events split freely."""
    s = stages(spark, d)
    return ops.first_followup_after(s.int_member_screenings.where(F.col("hrsn_flag")), s.stg_services)


@query
def risk_intersection(spark, d):
    return stages(spark, d).mart_renewal_hrsn_risk


@query
def risk_from_members(spark, d):
    s = stages(spark, d)
    return ops.risk_from_members_linkage(s.stg_members, s.stg_renewals, s.int_service_linkage)


@query
def lapse_by_county(spark, d):
    s = stages(spark, d)
    return ops.risk_from_linkage(s.stg_renewals, s.int_service_linkage, s.stg_members, ["county"])


@query
def risk_by_member_grain(spark, d):
    s = stages(spark, d)
    return ops.risk_from_linkage(s.stg_renewals, s.int_service_linkage, s.stg_members, grain="member")


@query
def top10_gap(spark, d):
    return rep.top_k(stages(spark, d).mart_service_gap_index, "service_gap_rate_pct", 10,
                 ["county", "scn_region", "primary_need_type"])


@query
def top10_risk(spark, d):
    return rep.top_k(stages(spark, d).mart_renewal_hrsn_risk, "high_risk_rate_pct", 10,
                 ["county", "scn_region", "race_ethnicity"])


# --- data quality ----------------------------------------------------------
@query
def dq_null_rates(spark, d):
    s = stages(spark, d)
    return dq.suite(
        dq.null_rates(s.stg_members, ["member_id", "scn_region"], "staging", "stg_members"),
        dq.null_rates(s.stg_screenings, ["member_id", "scn_region"], "staging", "stg_screenings"),
    )


@query
def dq_null_rates_by_region(spark, d):
    return dq.null_rates_by_group(stages(spark, d).stg_screenings, "scn_region",
                                  ["member_id", "screening_date", "screening_tool"], "staging")


@query
def dq_allowed_values(spark, d):
    return dq.allowed_values(stages(spark, d).stg_screenings, "primary_need_type", NEED_TYPES,
                             "staging", "stg_screenings", where=F.col("hrsn_flag"))


@query
def dq_duplicates(spark, d):
    s = stages(spark, d)
    return dq.suite(
        dq.duplicates(s.stg_screenings, "screening_id", "staging", "stg_screenings"),
        dq.duplicates(s.int_screenings_deduped, "screening_id", "intermediate",
                      "int_screenings_deduped"),
    )


@query
def dq_referential(spark, d):
    s = stages(spark, d)
    return dq.referential(s.int_screenings_deduped, s.stg_members, "member_id",
                          "intermediate", "screenings->members")


@query
def dq_completeness(spark, d):
    return dq.completeness(stages(spark, d).mart_scn_performance, "dy26_milestone_status",
                           "marts", "mart_scn_performance")


@query
def dq_gap_alert(spark, d):
    return dq.gap_alert(ops.gap_index(stages(spark, d).int_service_linkage, ["county"]))


@query
def dq_milestone_alert(spark, d):
    return dq.milestone_alert(stages(spark, d).mart_scn_performance)


# --- lookups, cohorts, summaries, submissions ------------------------------
@query
def region_lookup(spark, d):
    """County → region through a dimension (broadcast after a size check)."""
    n = driver.table(spark, d, "nation")
    r = driver.table(spark, d, "region")
    dim = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("county"), F.col("r_name").alias("region_name"))
    m = driver.members(spark, d).select("member_id", "county")
    return lookup(m, dim, "county", "region_name", default="Unassigned")


@query
def cohort_eligible(spark, d):
    return rep.eligible_cohort(driver.screenings(spark, d)).select(
        "screening_id", "member_id", "scn_region", "screening_date", "primary_need_type")


@query
def cohort_skipped(spark, d):
    return rep.cohort_counts(driver.screenings(spark, d))


@query
def age_years(spark, d):
    return rep.with_age(stages(spark, d).stg_members, AS_OF).select(
        "member_id", "date_of_birth", "age_years")


@query
def merge_submissions(spark, d):
    first, again = driver.screening_batches(spark, d)
    return rawsrc.merge_submissions(first, again, batch_col="submission_batch").select(
        "screening_id", "screening_date", "screener_role", "submission_batch")


@query
def table_summary(spark, d):
    return rep.table_summary(stages(spark, d).stg_screenings,
                         ["hrsn_flag", "invalid_tool_flag", "null_date_flag"],
                         ["scn_region", "screening_tool", "primary_need_type"])


# --- sampling --------------------------------------------------------------
@query
def stratified_sample(spark, d):
    m = stages(spark, d).stg_members
    return smp.stratified_sample(m, "risk_tier", SAMPLE_RATES, "member_id")


@query
def sample_share(spark, d):
    return smp.sample_share(stages(spark, d).stg_screenings, 0.02, "screening_id")


@query
def sample_exact(spark, d):
    return smp.sample_exact(stages(spark, d).stg_members, SAMPLE_SIZE, "member_id")


@query
def sample_exact_per_tier(spark, d):
    return smp.sample_exact(stages(spark, d).stg_members, SAMPLE_SIZE // 10, "member_id", stratum="risk_tier")


@query
def distinct_members_rollup(spark, d):
    """Members with a need at every roll-up level of county, region and need."""
    link = stages(spark, d).int_service_linkage.where(F.col("hrsn_flag"))
    return ops.distinct_rollup(link, "member_id", ["county", "scn_region", "primary_need_type"], "members")


# --- what is written and read back ------------------------------------------
def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one of the session."""
    return f"{ensure_checkpoint_dir(spark)}/needbridge-{name}-{uuid.uuid4().hex}"


@query
def published_risk(spark, d):
    """The risk mart as a whole run publishes it: 11 stages written, checked and read back."""
    out = _scratch(spark, "run")
    run_pipeline(spark, driver.load_all(spark, d), out, window=DRIVER_WINDOW, export=False, halt_on_error=False)
    return open_run(spark, out)["mart_renewal_hrsn_risk"]


@query
def quality_results(spark, d):
    """Every check of a run, row rules fused into one aggregate per table."""
    return quality_suite(stages(spark, d))


@query
def exported_gap_index(spark, d):
    """The gap index as its CSV parts hold it."""
    out, mart = _scratch(spark, "csv"), stages(spark, d).mart_service_gap_index
    export_csv({"mart": mart}, out, {"mart": mart_order()["mart_service_gap_index"]}, layout="parts", parts=4)
    return spark.read.schema(mart.schema).option("header", True).csv(f"{out}/mart")


@query
def dedupe_in_batches(spark, d):
    """``dedupe_latest`` reached by merging the second submission into the table of the first."""
    path = _scratch(spark, "latest")
    for batch in driver.screening_batches(spark, d):
        merge_latest(path, ops.stage_screenings(batch))
    return read_latest(spark, path)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
