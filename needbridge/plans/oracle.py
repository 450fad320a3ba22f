"""Independent SQL twins of the registered queries (DuckDB dialect).

The driver pre-registers the TPC-H-style tables as views; every query
here first derives the four programme sources with the same expressions
as ``needbridge.sources.driver`` and then states the rules by other means
than the Spark plans: DISTINCT ON for the latest submission, positions in
sorted lists for the sequence, lateral aggregates for follow-ups, an as-of
join for the next service, literal fan-out for the member pairs.

Oracle conventions: integer sums and row numbers cast to BIGINT, explicit
NULLS LAST, and the same tie-breaks as the Spark operators.
"""

from __future__ import annotations

from needbridge.plans.catalog import AS_OF, DRIVER_WINDOW, SAMPLE_SIZE
from needbridge.schemas import SAMPLE_RATES

LO, HI = DRIVER_WINDOW
TOOLS = "('AHC-HRSN', 'PRAPARE', 'WellRx', 'HealthLeads')"
NEEDS = "['Housing', 'Nutrition', 'Transportation', 'Case Management']"
NEEDS_IN = "('Housing', 'Nutrition', 'Transportation', 'Case Management')"
ELIG = "['Group-1', 'Group-2', 'Group-3', 'Group-4', 'Group-5', 'Group-6']"
LANGS = "['Language-1', 'Language-2', 'Language-3', 'Language-4', 'Language-5', 'Language-6', 'Language-7']"
ROLES = "['Role-1', 'Role-2', 'Role-3', 'Role-4']"
OUTCOMES = "['Result-1', 'Result-2', 'Result-3', 'Result-4', 'Result-5']"
REASONS = "['Reason-1', 'Reason-2', 'Reason-3', 'Reason-4']"
RISK = ("CASE WHEN c_acctbal < 3000 THEN 'Low' WHEN c_acctbal < 6000 THEN 'Medium' "
        "WHEN c_acctbal < 8500 THEN 'High' ELSE 'Very High' END")

# name -> (body, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


cte("geo", """
    SELECT n.n_nationkey, n.n_regionkey, n.n_name AS county, r.r_name AS scn_region
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("cust", """
    SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
           g.n_regionkey, g.county, g.scn_region
    FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey""", "geo")

cte("src_members", f"""
    SELECT printf('MBR%07d', c_custkey) AS member_id,
           ' ' || c_name || ' ' AS first_name,
           c_mktsegment || '  ' AS last_name,
           CASE WHEN c_custkey % 89 = 0 THEN 'unknown'
                ELSE CAST(DATE '1940-01-01' + CAST((c_custkey * 97) % 30000 AS INTEGER) AS VARCHAR)
           END AS date_of_birth,
           CAST(CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey % 86 END AS INTEGER) AS age,
           CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Male'
                WHEN c_custkey % 3 = 1 THEN 'Female' ELSE 'Non-binary' END AS gender,
           CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_mktsegment END AS race_ethnicity,
           county, scn_region,
           printf('%05d', (c_custkey * 7919) % 100000) AS zip_code,
           ({ELIG})[c_custkey % 6 + 1] AS eligibility_group,
           {RISK} AS risk_tier,
           CAST(DATE '2018-01-01' + CAST((c_custkey * 13) % 1800 AS INTEGER) AS VARCHAR) AS enrollment_date,
           'Plan-' || CAST(c_custkey % 6 AS VARCHAR) AS managed_care_plan,
           ({LANGS})[c_nationkey % 7 + 1] AS primary_language
    FROM cust""", "cust")

cte("scr_base", """
    SELECT o.o_orderkey AS k, o.o_custkey,
           CAST(o.o_orderdate AS DATE)
             + CASE WHEN o.o_orderkey % 5 > c.n_regionkey THEN 400 ELSE 0 END AS day,
           o.o_orderpriority, c.county, c.scn_region
    FROM orders o JOIN cust c ON o.o_custkey = c.c_custkey""", "cust")

cte("scr_rows", """
    SELECT *, 1 AS batch FROM scr_base
    UNION ALL
    SELECT *, 2 AS batch FROM scr_base WHERE k % 50 = 0""", "scr_base")

cte("src_screenings", f"""
    SELECT printf('SCR%08d', k) AS screening_id,
           CASE WHEN k % 103 = 0 THEN NULL WHEN k % 107 = 0 THEN printf('MBX%07d', o_custkey)
                ELSE printf('MBR%07d', o_custkey) END AS member_id,
           scn_region, county,
           CASE WHEN batch = 2 AND k % 100 = 0 THEN CAST(day + 3 AS VARCHAR)
                WHEN k % 37 = 0 THEN NULL
                WHEN k % 41 = 0 THEN 'not-a-date'
                WHEN k % 43 = 0 THEN replace(CAST(day AS VARCHAR), '-', '/')
                ELSE CAST(day AS VARCHAR) END AS screening_date,
           CASE WHEN k % 97 = 0 THEN NULL
                WHEN o_orderpriority = '1-URGENT' THEN 'AHC-HRSN'
                WHEN o_orderpriority = '2-HIGH' THEN 'PRAPARE'
                WHEN o_orderpriority = '3-MEDIUM' THEN 'WellRx'
                WHEN o_orderpriority = '5-LOW' THEN 'HealthLeads'
                ELSE 'UNKNOWN_TOOL' END AS screening_tool,
           CASE WHEN batch = 2 THEN 'Role-4' ELSE ({ROLES})[k % 4 + 1] END AS screener_role,
           k % 20 < 11 AS hrsn_flag,
           CASE WHEN k % 20 < 11 AND k % 33 <> 0 THEN ({NEEDS})[k % 4 + 1] END AS primary_need_type,
           (k % 20 < 11) AND (k % 3 = 0) AS food_insecurity,
           (k % 20 < 11) AND (k % 7 < 2) AS housing_instability,
           (k % 20 < 11) AND (k % 9 < 2) AS transportation_need,
           CASE WHEN k % 59 = 0 THEN NULL ELSE (k % 20 < 11) AND (k % 13 < 2) END AS utility_need,
           (k % 20 < 11) AND (k % 10 = 0) AS interpersonal_safety,
           CAST(NULL AS INTEGER) AS needs_count,
           k % 12 = 0 AS data_issue_flag,
           batch
    FROM scr_rows""", "scr_rows")

cte("src_services", f"""
    SELECT printf('SVC%08d', l.l_orderkey) || '-' || CAST(l.l_linenumber AS VARCHAR) AS service_id,
           printf('MBR%07d', o.o_custkey) AS member_id,
           printf('SCR%08d', l.l_orderkey) AS screening_id,
           c.scn_region, c.county,
           CASE WHEN l.l_orderkey % 31 = 0 AND l.l_linenumber = 2 THEN 'pending'
                ELSE CAST(CAST(o.o_orderdate AS DATE)
                          + CAST(CASE WHEN l.l_linenumber = 1 THEN l.l_partkey % 90 + 1
                                      ELSE l.l_suppkey % 90 + 1 END AS INTEGER) AS VARCHAR)
           END AS service_date,
           ({NEEDS})[l.l_partkey % 4 + 1] AS service_type,
           CASE WHEN l.l_partkey % 5 = 0 THEN NULL
                ELSE 'Subtype-' || CAST(l.l_partkey % 15 AS VARCHAR) END AS service_subtype,
           'CBO-' || CAST(l.l_suppkey % 11 AS VARCHAR) AS cbo_provider,
           CAST(l.l_partkey % 90 + 1 AS INTEGER) AS days_to_service,
           l.l_partkey % 90 + 1 <= 30 AS within_30_days,
           ({OUTCOMES})[l.l_orderkey % 5 + 1] AS service_outcome,
           l.l_partkey % 2 = 0 AS follow_up_scheduled
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN cust c ON o.o_custkey = c.c_custkey""", "cust")

cte("src_renewals", f"""
    SELECT printf('RNW%07d', c_custkey) AS renewal_id,
           printf('MBR%07d', c_custkey) AS member_id,
           county, scn_region,
           {RISK} AS risk_tier,
           ({ELIG})[c_custkey % 6 + 1] AS eligibility_group,
           CAST(DATE '2023-06-01' + CAST((c_custkey * 11) % 670 AS INTEGER) AS VARCHAR) AS renewal_date,
           CASE WHEN c_custkey % 50 < 29 THEN 'Kept' WHEN c_custkey % 50 < 40 THEN 'Disenrolled'
                WHEN c_custkey % 50 < 46 THEN 'Open' ELSE 'Moved' END
               AS renewal_outcome,
           CASE WHEN c_custkey % 50 >= 29 AND c_custkey % 50 < 40 AND c_custkey % 7 <> 0
                THEN ({REASONS})[c_custkey % 4 + 1] END AS disenrollment_reason,
           CAST(c_custkey % 6 AS INTEGER) AS outreach_attempts,
           c_mktsegment = 'BUILDING' AND c_custkey % 3 = 0 AS language_barrier_flag
    FROM cust""", "cust")

# --- staging: the raw rows with the fields that the rules type or fill replaced ----
cte("stg_members", """
    SELECT * REPLACE (
             trim(first_name) AS first_name, trim(last_name) AS last_name,
             TRY_CAST(date_of_birth AS DATE) AS date_of_birth,
             TRY_CAST(enrollment_date AS DATE) AS enrollment_date,
             ifnull(gender, 'Unknown') AS gender,
             ifnull(race_ethnicity, 'Unknown') AS race_ethnicity),
           ifnull(age BETWEEN 0 AND 17, FALSE) AS is_child,
           age IS NOT NULL AND NOT age < 65 AS is_senior,
           member_id IS NULL AS member_id_null_flag
    FROM src_members""", "src_members")

_FLAGS = "[food_insecurity, housing_instability, transportation_need, utility_need, interpersonal_safety]"

cte("stg_screenings", f"""
    SELECT * EXCLUDE (batch, data_issue_flag, known_tool) REPLACE (
             TRY_CAST(screening_date AS DATE) AS screening_date,
             if(known_tool, screening_tool, 'Unknown') AS screening_tool,
             ifnull(primary_need_type, 'Not Identified') AS primary_need_type,
             if(list_count({_FLAGS}) = 5, list_sum({_FLAGS}::INTEGER[]), NULL)::INTEGER AS needs_count),
           screening_date IS NULL AS null_date_flag,
           member_id IS NULL AS null_member_flag,
           NOT known_tool AS invalid_tool_flag
    FROM (SELECT *, screening_tool IS NULL OR screening_tool IN {TOOLS} AS known_tool FROM src_screenings)""",
    "src_screenings")

cte("stg_services", """
    SELECT * REPLACE (TRY_CAST(service_date AS DATE) AS service_date,
                      ifnull(service_subtype, 'General') AS service_subtype),
           service_date IS NULL AS null_date_flag, member_id IS NULL AS null_member_flag
    FROM src_services""", "src_services")

cte("stg_renewals", """
    SELECT * REPLACE (TRY_CAST(renewal_date AS DATE) AS renewal_date,
                      ifnull(disenrollment_reason, 'N/A') AS disenrollment_reason),
           renewal_outcome IS NOT DISTINCT FROM 'Disenrolled' AS is_disenrolled
    FROM src_renewals""", "src_renewals")

# --- one row per screening, visits in order, follow-ups, outcomes -------------------
#: After the latest date these decide, ascending, which of several submissions stays.
_TIES = ("member_id", "scn_region", "county", "screening_tool", "screener_role", "hrsn_flag",
         "primary_need_type", "food_insecurity", "housing_instability", "transportation_need",
         "utility_need", "interpersonal_safety", "needs_count", "null_date_flag",
         "null_member_flag", "invalid_tool_flag")

cte("latest", f"""
    SELECT DISTINCT ON (screening_id) * FROM stg_screenings
    ORDER BY screening_id, screening_date DESC NULLS LAST, {", ".join(f"{t} NULLS LAST" for t in _TIES)}""",
    "stg_screenings")

# a member's visits as one sorted list: place and predecessor come from list positions
cte("visit_lists", """
    SELECT member_id, list({'id': screening_id, 'day': screening_date}
                           ORDER BY screening_date NULLS LAST, screening_id NULLS LAST) AS visits
    FROM latest WHERE NOT null_date_flag AND NOT null_member_flag GROUP BY member_id""", "latest")

cte("placed", """
    SELECT visits[i]['id'] AS screening_id, i AS screening_seq, visits[i - 1]['day'] AS prior_screening_date
    FROM (SELECT visits, unnest(range(1, len(visits) + 1)) AS i FROM visit_lists)""", "visit_lists")

cte("visits", """
    SELECT screening_id, member_id, race_ethnicity, age, is_child, is_senior, eligibility_group,
           risk_tier, managed_care_plan, primary_language, latest.scn_region, latest.county,
           screening_date, screening_tool, hrsn_flag, primary_need_type, needs_count,
           food_insecurity, housing_instability, transportation_need, utility_need,
           interpersonal_safety, screening_seq, prior_screening_date
    FROM placed JOIN latest USING (screening_id) JOIN stg_members USING (member_id)""",
    "placed", "latest", "stg_members")

cte("linked", """
    SELECT screening_id, member_id, scn_region, county, race_ethnicity, risk_tier, screening_date,
           hrsn_flag, primary_need_type, needs_count, first_service_date, days_to_first_service,
           total_services,
           ifnull(hrsn_flag AND first_service_date IS NULL, FALSE) AS no_service_flag,
           ifnull(hrsn_flag, FALSE) AND (first_service_date IS NULL
             OR ifnull(days_to_first_service > 30, FALSE)) AS service_gap_flag
    FROM visits, LATERAL (
        SELECT min(sv.service_date) AS first_service_date,
               min(sv.days_to_service) AS days_to_first_service, count(*) AS total_services
        FROM stg_services sv
        WHERE sv.member_id = visits.member_id AND sv.screening_id = visits.screening_id) followups""",
    "visits", "stg_services")

cte("outcomes", """
    SELECT stg_renewals.*, hrsn_flag, primary_need_type, needs_count, service_gap_flag, no_service_flag,
           ifnull(is_disenrolled AND hrsn_flag, FALSE) AS lapsed_and_unmet_hrsn
    FROM stg_renewals LEFT JOIN linked ON linked.member_id = stg_renewals.member_id""",
    "stg_renewals", "linked")


# --- marts: members first, then groups ----------------------------------------------
def _pct(n: str, d: str) -> str:
    return f"round({n}::DOUBLE * 100 / nullif({d}, 0)::DOUBLE, 2)"


def _tier(reached: str, base: str) -> str:
    """The label of the greatest share of ``base`` that was reached."""
    return (f"ifnull((SELECT max_by(label, share) FROM (VALUES (0.25, 'On track'), (0.15, 'At risk')) "
            f"steps(share, label) WHERE {reached} >= share * {base}), 'Behind milestone')")


cte("by_member", f"""
    SELECT scn_region, member_id, bool_or(ifnull(screening_date >= '{LO}' AND screening_date <= '{HI}', FALSE)) AS timely,
           count(*) FILTER (hrsn_flag) AS positive, sum(needs_count) AS needs, count(needs_count) AS known
    FROM visits GROUP BY ALL""", "visits")

cte("by_region", """
    SELECT scn_region, count(member_id) AS total_screened,
           count(member_id) FILTER (timely) AS screened_dy26, sum(positive)::BIGINT AS hrsn_positive,
           round(sum(needs)::DOUBLE / nullif(sum(known), 0)::DOUBLE, 2) AS avg_needs_count
    FROM by_member GROUP BY ALL""", "by_member")

cte("milestones", f"""
    SELECT enrolled.*, total_screened, screened_dy26, hrsn_positive, avg_needs_count,
           {_pct("total_screened", "total_members")} AS screening_rate_pct,
           {_pct("hrsn_positive", "total_screened")} AS hrsn_prevalence_pct,
           {_pct("total_screened", "(SELECT sum(total_screened) FROM by_region WHERE scn_region IN (SELECT scn_region FROM stg_members))")}
             AS pct_of_state_volume,
           {_tier("screened_dy26", "total_members")} AS dy26_milestone_status
    FROM (SELECT scn_region, count(member_id) AS total_members
          FROM (SELECT DISTINCT scn_region, member_id FROM stg_members) GROUP BY ALL) enrolled
    LEFT JOIN by_region USING (scn_region)""", "by_region", "stg_members")


def _gap_select(keys: str, extra: str = "") -> str:
    """Need rows per ``keys`` (none: all of them), counted first and divided after."""
    listed = f"{keys}, " if keys else ""
    return f"""
    SELECT {listed}{extra}screened_with_need, no_service_count, gap_within_30d_count, avg_days_to_service,
           {_pct("gap_within_30d_count", "screened_with_need")} AS service_gap_rate_pct,
           {_pct("no_service_count", "screened_with_need")} AS no_service_rate_pct
    FROM (SELECT {listed}count(*) AS screened_with_need, count(*) FILTER (no_service_flag) AS no_service_count,
                 count(*) FILTER (service_gap_flag) AS gap_within_30d_count,
                 round(avg(days_to_first_service), 1) AS avg_days_to_service
          FROM linked WHERE hrsn_flag AND primary_need_type <> 'Not Identified'
          {f"GROUP BY {keys}" if keys else ""})"""


cte("gaps", _gap_select("county, scn_region, primary_need_type"), "linked")

cte("gap_by_county", _gap_select("county"), "linked")

cte("risks", """
    SELECT outcomes.*, race_ethnicity
    FROM outcomes LEFT JOIN (SELECT member_id, race_ethnicity FROM stg_members) USING (member_id)""",
    "outcomes", "stg_members")

#: Output column and the rows that it counts.
_RISKS = {"coverage_lapsed": "is_disenrolled", "hrsn_positive": "hrsn_flag",
          "lapsed_with_unmet_hrsn": "lapsed_and_unmet_hrsn",
          "lapsed_language_barrier": "language_barrier_flag AND is_disenrolled"}


def _risk_select(keys: str, most: str = "count(*)") -> str:
    """Per group; a member counts with ``count(*)`` rows, or once with ``least(count(*), 1)``."""
    inner = ", ".join(f"{most.replace('count(*)', f'count(*) FILTER ({rows})')} AS {n}" for n, rows in _RISKS.items())
    return f"""
    SELECT *, {_pct("coverage_lapsed", "total_members")} AS disenrollment_rate_pct,
           {_pct("lapsed_with_unmet_hrsn", "total_members")} AS high_risk_rate_pct
    FROM (SELECT {keys}, count(member_id) AS total_members, {", ".join(f"sum({n})::BIGINT AS {n}" for n in _RISKS)}
          FROM (SELECT {keys}, member_id, {inner} FROM risks GROUP BY {keys}, member_id) GROUP BY {keys})"""


cte("risk_mart", _risk_select("county, scn_region, race_ethnicity"), "risks")

# the nearest service day on or after each distinct event
cte("followup_groups", """
    SELECT ev.*, sv.service_date AS first_service_date
    FROM (SELECT DISTINCT member_id, county, primary_need_type, screening_date FROM visits WHERE hrsn_flag) ev
    ASOF LEFT JOIN (SELECT DISTINCT member_id, service_date FROM stg_services WHERE service_date IS NOT NULL) sv
      ON ev.member_id = sv.member_id AND ev.screening_date <= sv.service_date""", "visits", "stg_services")


def build(final: str, *deps: str) -> str:
    """WITH <needed CTEs in dependency order> <final>."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for d in CTES[name][1]:
            visit(d)
        order.append(name)

    for d in deps:
        visit(d)
    body = ",\n".join(f"{n} AS ({CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def _dq(check: str, layer: str, scope: str, observed: str, threshold: float, severity: str,
        passed: str) -> str:
    return (f"SELECT {check} AS \"check\", '{layer}' AS layer, {scope} AS scope, "
            f"CAST({observed} AS DOUBLE) AS observed, CAST({threshold} AS DOUBLE) AS threshold, "
            f"'{severity}' AS severity, {passed} AS passed")


def _null_rate(table: str, col: str) -> str:
    rate = f"AVG(CAST({col} IS NULL AS INTEGER))"
    return _dq(f"'null_rate:{col}'", "staging", f"'{table}'", rate, 0.0, "error",
               f"COALESCE({rate} <= 0.0, FALSE)") + f" FROM {table}"


def _null_rate_by_region(col: str) -> str:
    rate = f"AVG(CAST({col} IS NULL AS INTEGER))"
    return (_dq(f"'null_rate:{col}'", "staging", "COALESCE(scn_region, '<null>')", rate, 0.0,
                "error", f"{rate} <= 0.0")
            + " FROM stg_screenings GROUP BY scn_region")


def _dup(table: str, layer: str, scope: str = "stg_screenings") -> str:
    return (_dq("'duplicates:screening_id'", layer, f"'{scope}'", "COUNT(*)", 0.0, "error",
                "COUNT(*) = 0")
            + f" FROM (SELECT screening_id FROM {table} GROUP BY screening_id HAVING COUNT(*) > 1) d")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for name in ("stg_members", "stg_screenings", "stg_services", "stg_renewals"):
        q[name] = build(f"SELECT * FROM {name}", name)
    q["dedupe_latest"] = build("FROM latest", "latest")
    q["sequence_events"] = build("FROM visits", "visits")
    q["sequence_hot_split"] = q["sequence_events"]
    q["link_first_followup"] = build("FROM linked", "linked")
    q["outcome_join"] = build("FROM outcomes", "outcomes")
    q["milestone_performance"] = build("FROM milestones", "milestones")
    q["milestone_by_screened"] = build(f"""
        SELECT scn_region, total_screened, screened_dy26, hrsn_positive AS members_with_need,
               {_pct("total_screened", "(SELECT sum(total_screened) FROM by_region)")} AS pct_of_state_total,
               {_tier("screened_dy26", "total_screened")} AS dy26_milestone_status
        FROM by_region""", "by_region")
    q["share_of_total"] = build(f"""
        SELECT county, count(*) AS screenings,
               {_pct("count(*)", "(SELECT count(*) FROM visits)")} AS pct_of_screenings
        FROM visits GROUP BY county""", "visits")
    q["gap_index"] = build("FROM gaps", "gaps")
    q["gap_by_need"] = build(_gap_select("primary_need_type"), "linked")
    q["gap_by_county"] = build("FROM gap_by_county", "gap_by_county")
    q["gap_grouping_sets"] = build(" UNION ALL BY NAME ".join([
        _gap_select("county, scn_region, primary_need_type", "0::BIGINT AS grouping_level, "),
        _gap_select("county, scn_region", "1::BIGINT AS grouping_level, "),
        _gap_select("county", "3::BIGINT AS grouping_level, "),
        _gap_select("", "7::BIGINT AS grouping_level, ")]), "linked")
    # these two rates divide first, then round half to even
    gap_after = """
        SELECT *, round_even(unmet_within_30d::DOUBLE / screened_with_need * 100, 2) AS service_gap_rate_pct
        FROM (SELECT county, primary_need_type, count(*) AS screened_with_need,
                     count(*) FILTER (ifnull(first_service_date > screening_date + 30, TRUE)) AS unmet_within_30d
              FROM followup_groups GROUP BY ALL)"""
    q["followup_after_range"] = build(gap_after, "followup_groups")
    q["followup_after_join"] = q["followup_after_range"]
    q["followup_hot_split"] = build("FROM followup_groups", "followup_groups")
    q["risk_intersection"] = build("FROM risk_mart", "risk_mart")
    q["risk_from_members"] = build("""
        SELECT *, round_even(lapsed_with_unmet_hrsn::DOUBLE / nullif(total_members, 0) * 100, 2) AS high_risk_rate_pct
        FROM (SELECT stg_members.county, stg_members.race_ethnicity,
                     count(DISTINCT stg_members.member_id) AS total_members,
                     count(*) FILTER (renewal_outcome = 'Disenrolled') AS coverage_lapsed,
                     count(*) FILTER (renewal_outcome = 'Disenrolled' AND visits.hrsn_flag) AS lapsed_with_unmet_hrsn
              FROM stg_members LEFT JOIN outcomes USING (member_id) LEFT JOIN visits USING (member_id)
              GROUP BY 1, 2)""",
        "stg_members", "outcomes", "visits")
    q["lapse_by_county"] = build(_risk_select("county"), "risks")
    q["risk_by_member_grain"] = build(
        _risk_select("county, scn_region, race_ethnicity", "least(count(*), 1)"), "risks")
    q["top10_gap"] = build(
        "SELECT * FROM gaps ORDER BY service_gap_rate_pct DESC NULLS LAST, "
        "county ASC NULLS LAST, scn_region ASC NULLS LAST, primary_need_type ASC NULLS LAST "
        "LIMIT 10", "gaps")
    q["top10_risk"] = build(
        "SELECT * FROM risk_mart ORDER BY high_risk_rate_pct DESC NULLS LAST, "
        "county ASC NULLS LAST, scn_region ASC NULLS LAST, race_ethnicity ASC NULLS LAST "
        "LIMIT 10", "risk_mart")

    # data quality
    q["dq_null_rates"] = build(" UNION ALL ".join(
        _null_rate(t, col) for t in ("stg_members", "stg_screenings")
        for col in ("member_id", "scn_region")), "stg_members", "stg_screenings")
    q["dq_null_rates_by_region"] = build(" UNION ALL ".join(
        _null_rate_by_region(col) for col in ("member_id", "screening_date", "screening_tool")),
        "stg_screenings")
    q["dq_allowed_values"] = build(
        _dq("'allowed_values:primary_need_type'", "staging", "'stg_screenings'",
            f"COUNT(*) FILTER (WHERE NOT COALESCE(primary_need_type IN {NEEDS_IN}, FALSE))", 0.0,
            "error",
            f"COUNT(*) FILTER (WHERE NOT COALESCE(primary_need_type IN {NEEDS_IN}, FALSE)) = 0")
        + " FROM stg_screenings WHERE hrsn_flag", "stg_screenings")
    q["dq_duplicates"] = build(
        _dup("stg_screenings", "staging") + " UNION ALL "
        + _dup("latest", "intermediate", "int_screenings_deduped"), "stg_screenings",
        "latest")
    share = "COUNT(m.k) / NULLIF(COUNT(*), 0)"
    q["dq_referential"] = build(
        _dq("'referential:member_id'", "intermediate", "'screenings->members'", share, 1.0,
            "error", f"COALESCE({share} >= 1.0, FALSE)")
        + " FROM (SELECT member_id FROM latest WHERE member_id IS NOT NULL) s"
          " LEFT JOIN (SELECT DISTINCT member_id AS k FROM stg_members"
          " WHERE member_id IS NOT NULL) m ON s.member_id = m.k",
        "latest", "stg_members")
    comp = "COUNT(dy26_milestone_status) / NULLIF(COUNT(*), 0)"
    q["dq_completeness"] = build(
        _dq("'completeness:dy26_milestone_status'", "marts", "'mart_scn_performance'", comp, 1.0,
            "error", f"COALESCE({comp} >= 1.0, FALSE)") + " FROM milestones", "milestones")
    q["dq_gap_alert"] = build(
        _dq("'gap_rate_anomaly'", "marts", "county", "service_gap_rate_pct", 80.0, "warn",
            "COALESCE(service_gap_rate_pct <= 80.0, TRUE)") + " FROM gap_by_county",
        "gap_by_county")
    q["dq_milestone_alert"] = build(
        _dq("'milestone_threshold'", "marts", "scn_region",
            "screened_dy26 / NULLIF(total_members, 0)", 0.25, "warn",
            "COALESCE(dy26_milestone_status = 'On track', FALSE)") + " FROM milestones",
        "milestones")
    deduped_keys = build(_dup("latest", "intermediate", "int_screenings_deduped"), "latest")
    q["quality_results"] = " UNION ALL BY NAME ".join(f"SELECT * FROM ({part})" for part in (
        deduped_keys, *[q[f"dq_{name}"] for name in ("null_rates", "allowed_values", "referential", "completeness",
                                                     "gap_alert", "milestone_alert")]))

    # written and read back
    q["published_risk"] = q["risk_intersection"]
    q["exported_gap_index"] = q["gap_index"]
    q["dedupe_in_batches"] = q["dedupe_latest"]

    # lookups, cohorts, summaries, submissions
    q["region_lookup"] = build("""
        SELECT m.member_id, m.county, COALESCE(d.region_name, 'Unassigned') AS region_name
        FROM src_members m
        LEFT JOIN (SELECT n.n_name AS county, r.r_name AS region_name
                   FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) d
          ON m.county = d.county""", "src_members")
    q["cohort_eligible"] = build("""
        SELECT screening_id, member_id, scn_region, TRY_CAST(screening_date AS DATE) AS screening_date,
               primary_need_type
        FROM src_screenings
        WHERE hrsn_flag AND TRY_CAST(screening_date AS DATE) IS NOT NULL""", "src_screenings")
    q["cohort_skipped"] = build("""
        SELECT scn_region,
               COUNT(*) FILTER (WHERE hrsn_flag AND TRY_CAST(screening_date AS DATE) IS NOT NULL)
                   AS eligible,
               COUNT(*) FILTER (WHERE hrsn_flag AND TRY_CAST(screening_date AS DATE) IS NULL)
                   AS skipped_no_date
        FROM src_screenings GROUP BY scn_region""", "src_screenings")
    q["age_years"] = build(f"""
        SELECT member_id, date_of_birth,
               CAST(FLOOR(DATE_DIFF('day', date_of_birth, DATE '{AS_OF}') / 365) AS INTEGER)
                   AS age_years
        FROM stg_members""", "stg_members")
    q["merge_submissions"] = build("""
        SELECT screening_id, screening_date, screener_role, CAST(batch AS INTEGER) AS submission_batch
        FROM src_screenings""", "src_screenings")
    q["table_summary"] = build("""
        SELECT COUNT(*) AS row_count,
               AVG(CAST(hrsn_flag AS INTEGER)) AS hrsn_flag_rate,
               AVG(CAST(invalid_tool_flag AS INTEGER)) AS invalid_tool_flag_rate,
               AVG(CAST(null_date_flag AS INTEGER)) AS null_date_flag_rate,
               COUNT(DISTINCT scn_region) AS scn_region_distinct,
               COUNT(DISTINCT screening_tool) AS screening_tool_distinct,
               COUNT(DISTINCT primary_need_type) AS primary_need_type_distinct
        FROM stg_screenings""", "stg_screenings")
    def position(key: str, seed: int) -> str:
        return f"('0x' || substr(md5({key} || ':{seed}'), 1, 8))::BIGINT / 4294967296.0"

    rates = " ".join(f"WHEN '{tier}' THEN {rate}" for tier, rate in SAMPLE_RATES.items())
    q["stratified_sample"] = build(
        f"SELECT * FROM stg_members WHERE {position('member_id', 42)} < CASE risk_tier {rates} ELSE 0 END", "stg_members")
    q["sample_share"] = build(
        f"SELECT * FROM stg_screenings WHERE {position('screening_id', 7)} < 0.02", "stg_screenings")
    q["sample_exact"] = build(
        f"SELECT * FROM stg_members ORDER BY md5(member_id || ':11') LIMIT {SAMPLE_SIZE}", "stg_members")
    q["sample_exact_per_tier"] = build(
        "SELECT * FROM stg_members QUALIFY row_number() OVER "
        f"(PARTITION BY risk_tier ORDER BY md5(member_id || ':11')) <= {SAMPLE_SIZE // 10}", "stg_members")
    q["distinct_members_rollup"] = build("""
        SELECT county, scn_region, primary_need_type, count(DISTINCT member_id) AS members,
               grouping(county, scn_region, primary_need_type)::BIGINT AS grouping_level
        FROM linked WHERE hrsn_flag GROUP BY ROLLUP (county, scn_region, primary_need_type)""", "linked")
    return q
