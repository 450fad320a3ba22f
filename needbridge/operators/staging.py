"""Staging: type and clean each raw source.

Each function is one narrow ``select`` — no shuffle — so Catalyst fuses it
into the scan's whole-stage-codegen span and prunes unused raw columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.functions import (
    allow_list,
    allow_list_violation,
    flag,
    row_sum_flags,
    safe_date,
    trim_spaces,
)
from needbridge.schemas import (
    ALLOWED_TOOLS,
    CHILD_AGE_BELOW,
    DEFAULT_REASON,
    DEFAULT_SUBTYPE,
    DISENROLLED,
    NEED_FLAGS,
    NOT_IDENTIFIED,
    SENIOR_AGE_FROM,
    UNKNOWN,
)

c = F.col


def stage_members(raw: DataFrame) -> DataFrame:
    return raw.select(
        "member_id",
        trim_spaces("first_name").alias("first_name"),
        trim_spaces("last_name").alias("last_name"),
        safe_date("date_of_birth").alias("date_of_birth"),
        c("age").cast("int").alias("age"),
        F.coalesce(c("gender"), F.lit(UNKNOWN)).alias("gender"),
        F.coalesce(c("race_ethnicity"), F.lit(UNKNOWN)).alias("race_ethnicity"),
        "county",
        "scn_region",
        "zip_code",
        "eligibility_group",
        "risk_tier",
        safe_date("enrollment_date").alias("enrollment_date"),
        "managed_care_plan",
        "primary_language",
        flag(c("age") < CHILD_AGE_BELOW).alias("is_child"),
        flag(c("age") >= SENIOR_AGE_FROM).alias("is_senior"),
        c("member_id").isNull().alias("member_id_null_flag"),
    )


def stage_screenings(
    raw: DataFrame,
    allowed_tools: Sequence[str] = ALLOWED_TOOLS,
    flag_on: str = "raw",
) -> DataFrame:
    """Type screenings.

    ``flag_on='raw'`` keeps the reference's behaviour (Q1): the null-date
    flag looks at the submitted text, so an unparseable non-null date gets
    a NULL date but flag FALSE.  ``flag_on='parsed'`` flags it as missing.
    """
    date = safe_date("screening_date")
    date_missing = c("screening_date").isNull() if flag_on == "raw" else date.isNull()
    return raw.select(
        "screening_id",
        "member_id",
        "scn_region",
        "county",
        date.alias("screening_date"),
        allow_list("screening_tool", allowed_tools, UNKNOWN).alias("screening_tool"),
        "screener_role",
        c("hrsn_flag").cast("boolean").alias("hrsn_flag"),
        F.coalesce(c("primary_need_type"), F.lit(NOT_IDENTIFIED)).alias("primary_need_type"),
        *[c(f).cast("boolean").alias(f) for f in NEED_FLAGS],
        row_sum_flags(NEED_FLAGS).alias("needs_count"),
        date_missing.alias("null_date_flag"),
        c("member_id").isNull().alias("null_member_flag"),
        allow_list_violation("screening_tool", allowed_tools).alias("invalid_tool_flag"),
    )


def stage_services(raw: DataFrame) -> DataFrame:
    return raw.select(
        "service_id",
        "member_id",
        "screening_id",
        "scn_region",
        "county",
        safe_date("service_date").alias("service_date"),
        "service_type",
        F.coalesce(c("service_subtype"), F.lit(DEFAULT_SUBTYPE)).alias("service_subtype"),
        "cbo_provider",
        c("days_to_service").cast("int").alias("days_to_service"),
        c("within_30_days").cast("boolean").alias("within_30_days"),
        "service_outcome",
        c("follow_up_scheduled").cast("boolean").alias("follow_up_scheduled"),
        c("member_id").isNull().alias("null_member_flag"),
        c("service_date").isNull().alias("null_date_flag"),
    )


def stage_renewals(raw: DataFrame, lapsed_value: str = DISENROLLED) -> DataFrame:
    return raw.select(
        "renewal_id",
        "member_id",
        "county",
        "scn_region",
        "risk_tier",
        "eligibility_group",
        safe_date("renewal_date").alias("renewal_date"),
        "renewal_outcome",
        F.coalesce(c("disenrollment_reason"), F.lit(DEFAULT_REASON)).alias("disenrollment_reason"),
        c("outreach_attempts").cast("int").alias("outreach_attempts"),
        c("language_barrier_flag").cast("boolean").alias("language_barrier_flag"),
        flag(c("renewal_outcome") == lapsed_value).alias("is_disenrolled"),
    )
