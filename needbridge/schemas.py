"""Raw source schemas and the fixed values the staging rules depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values — these must equal the reference's for right results.
# ---------------------------------------------------------------------------
ALLOWED_TOOLS = ("AHC-HRSN", "PRAPARE", "WellRx", "HealthLeads")
NEED_TYPES = ("Housing", "Nutrition", "Transportation", "Case Management")
UNKNOWN = "Unknown"
NOT_IDENTIFIED = "Not Identified"
DEFAULT_SUBTYPE = "General"
DEFAULT_REASON = "N/A"
DISENROLLED = "Disenrolled"
TIER_ON_TRACK = "On track"
TIER_AT_RISK = "At risk"
TIER_BEHIND = "Behind milestone"
# (fraction of the base that must be screened in the window, label), in order
MILESTONE_TIERS = ((0.25, TIER_ON_TRACK), (0.15, TIER_AT_RISK))
MILESTONE_DEFAULT = TIER_BEHIND
# DY26 milestone window of the reference (inclusive)
DY26_WINDOW = ("2024-04-01", "2025-03-31")
CHILD_AGE_BELOW = 18
SENIOR_AGE_FROM = 65
SERVICE_SLA_DAYS = 30
NEED_FLAGS = (
    "food_insecurity",
    "housing_instability",
    "transportation_need",
    "utility_need",
    "interpersonal_safety",
)

S, I, B = T.StringType(), T.IntegerType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw layer: dates arrive as text; typing happens in staging.
MEMBERS = _schema(
    ("member_id", S), ("first_name", S), ("last_name", S), ("date_of_birth", S),
    ("age", I), ("gender", S), ("race_ethnicity", S), ("county", S),
    ("scn_region", S), ("zip_code", S), ("eligibility_group", S), ("risk_tier", S),
    ("enrollment_date", S), ("managed_care_plan", S), ("primary_language", S),
)

SCREENINGS = _schema(
    ("screening_id", S), ("member_id", S), ("scn_region", S), ("county", S),
    ("screening_date", S), ("screening_tool", S), ("screener_role", S),
    ("hrsn_flag", B), ("primary_need_type", S), ("food_insecurity", B),
    ("housing_instability", B), ("transportation_need", B), ("utility_need", B),
    ("interpersonal_safety", B), ("needs_count", I), ("data_issue_flag", B),
)

SERVICES = _schema(
    ("service_id", S), ("member_id", S), ("screening_id", S), ("scn_region", S),
    ("county", S), ("service_date", S), ("service_type", S), ("service_subtype", S),
    ("cbo_provider", S), ("days_to_service", I), ("within_30_days", B),
    ("service_outcome", S), ("follow_up_scheduled", B),
)

RENEWALS = _schema(
    ("renewal_id", S), ("member_id", S), ("county", S), ("scn_region", S),
    ("risk_tier", S), ("eligibility_group", S), ("renewal_date", S),
    ("renewal_outcome", S), ("disenrollment_reason", S), ("outreach_attempts", I),
    ("language_barrier_flag", B),
)

RAW_SCHEMAS = {
    "members": MEMBERS,
    "screenings": SCREENINGS,
    "services": SERVICES,
    "renewals": RENEWALS,
}

# Share of each risk tier that the source programme screens.
SAMPLE_RATES = {"Low": 0.52, "Medium": 0.72, "High": 0.87, "Very High": 0.94}
# ---------------------------------------------------------------------------
