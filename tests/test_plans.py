"""Physical-plan properties over raw Parquet sources: pruning, pushdown, no extra shuffles."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from needbridge import operators as ops
from needbridge.operators import quality as dq
from needbridge.operators import rules as ru
from needbridge.plans.catalog import DRIVER_WINDOW
from needbridge.plans.pipeline import stage_rules
from needbridge.plans.stages import Stages
from needbridge.schemas import NEED_TYPES
from needbridge.sources import driver
from needbridge.sources.raw import read_sources
from needbridge.sources.sinks import write_parquet
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stages(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    root = tempfile.mkdtemp(prefix="nb-plan-")
    for name, fn in driver.SOURCES.items():
        write_parquet(fn(spark, SF_SMALL), f"{root}/{name}")
    return lambda: Stages(read_sources(spark, root), window=DRIVER_WINDOW)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(p, table):
    return [ln for ln in p.split("\n") if "FileScan parquet" in ln and f"/{table}]" in ln]


def read_schema(line):
    return re.search(r"ReadSchema: struct<([^>]*)>", line).group(1)


def test_mart_reads_only_needed_member_columns(stages):
    p = plan(stages().mart_scn_performance)
    cols = {c.split(":")[0] for s in scans(p, "members") for c in read_schema(s).split(",")}
    # members feed the region totals (member_id, region) and the member attributes of T6
    assert "first_name" not in cols and "zip_code" not in cols and "enrollment_date" not in cols
    assert {"member_id", "scn_region"} <= cols


def test_staging_drops_unused_raw_column_at_scan(stages):
    p = plan(stages().mart_service_gap_index)
    for s in scans(p, "screenings"):
        assert "data_issue_flag" not in read_schema(s)


def test_filter_pushed_to_scan(stages):
    df = dq.allowed_values(stages().stg_screenings, "primary_need_type", NEED_TYPES, "staging",
                           "stg_screenings", where=F.col("hrsn_flag"))
    p = plan(df)
    (scan,) = scans(p, "screenings")
    assert "EqualTo(hrsn_flag,true)" in scan


def test_dedupe_limits_before_shuffle(stages):
    p = plan(stages().int_screenings_deduped)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_no_nested_loop_joins(stages, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (stages().mart_scn_performance, stages().mart_renewal_hrsn_risk,
                   stages().mart_service_gap_index):
            assert "NestedLoopJoin" not in plan(df) and "CartesianProduct" not in plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("build", [
    lambda s: s.int_renewal_hrsn,
    lambda s: s.mart_renewal_hrsn_risk,
    lambda s: ops.risk_from_linkage(s.stg_renewals, s.int_service_linkage, s.stg_members, ["county"]),
    lambda s: ops.risk_from_linkage(s.stg_renewals, s.int_service_linkage, s.stg_members, grain="member"),
    lambda s: ops.risk_from_members_linkage(s.stg_members, s.stg_renewals, s.int_service_linkage),
])
def test_outcomes_read_each_source_once(stages, build):
    p = plan(build(stages()))
    # the counts per member need no service: that join is pruned away
    assert len(scans(p, "renewals")) == len(scans(p, "screenings")) == 1
    assert len(scans(p, "services")) <= 1


def test_totals_come_from_one_evaluation(stages):
    s = stages()
    share = ops.share_of_total(s.int_member_screenings.groupBy("county").agg(F.count("*").alias("n")), "n", "pct")
    for df in (s.mart_scn_performance, ops.milestone_by_screened(s.int_member_screenings, window=DRIVER_WINDOW), share):
        p = plan(df)
        assert len(scans(p, "screenings")) == 1
        assert len(re.findall(r"WindowGroupLimit \[[^]]*\], .*, Partial", p)) == 1
        # no window gathers all rows in one partition
        assert "SinglePartition" not in p


def test_followups_form_no_pairs(stages, spark):
    s = stages()
    events, services = s.int_member_screenings, s.stg_services
    tracker = spark.sparkContext.statusTracker()
    jobs = tracker.getJobIdsForGroup()
    p = plan(ops.gap_after_screening(events, services))
    assert len(scans(p, "services")) == 1
    assert "Join" in p and ">=" not in "".join(ln for ln in p.split("\n") if "Join" in ln)
    # no job runs while the plan is built
    assert tracker.getJobIdsForGroup() == jobs


def test_rollups_expand_groups_not_rows(stages):
    link = stages().int_service_linkage
    for df in (ops.gap_rollup(link), ops.distinct_rollup(link, "member_id", ["county", "primary_need_type"], "n")):
        lines = plan(df).split("\n")
        expand = next(i for i, ln in enumerate(lines) if "Expand" in ln)
        assert "Aggregate" in lines[expand + 1]


def test_quality_suite_row_rules_share_a_scan(stages):
    s = stages()
    p = plan(ru.profile(s.stg_screenings, stage_rules()["stg_screenings"], "staging", "stg_screenings"))
    assert len(scans(p, "screenings")) == 1 and p.count("partial_avg") + p.count("partial_count") >= 3


def test_line_items_are_shuffled_once_for_services(spark):
    """Orders meet their customer before the line items, so the longest table goes through one exchange."""
    root = tempfile.mkdtemp(prefix="nb-plan-")
    for name, cols in {
        "nation": "0L n_nationkey, 'N' n_name, 0L n_regionkey",
        "region": "0L r_regionkey, 'R' r_name",
        "customer": "1L c_custkey, 0L c_nationkey",
        "orders": "1L o_orderkey, 1L o_custkey, date'1997-01-01' o_orderdate",
        "lineitem": "1L l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber",
    }.items():
        spark.sql(f"select {cols}").write.parquet(f"{root}/{name}.parquet")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan(driver.services(spark, root)).split("\n")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    at = next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "lineitem.parquet" in ln)
    depth = [re.search(r"[A-Za-z(*]", ln).start() if re.search(r"[A-Za-z(*]", ln) else 0 for ln in lines]
    above, low = 0, depth[at]
    for i in range(at - 1, -1, -1):  # the scan's ancestors
        if depth[i] < low:
            low, above = depth[i], above + (" Exchange hashpartitioning" in " " + lines[i][depth[i]:])
    assert above == 1
