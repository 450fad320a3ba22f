"""Hand-written edge rows per rule (FIXTURES §3) and operator invariants."""

import datetime as dt
import glob
import os
import random
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from needbridge import operators as ops
from needbridge.operators.heavy import heavy_keys, salted_left_join
from needbridge.operators.increment import id_range, merge_latest, read_latest
from needbridge.operators.linkage import first_at_or_after, follow_up_days
from needbridge.schemas import RAW_SCHEMAS
from tests.conftest import rows

D = dt.date


def raw(spark, name, records):
    schema = RAW_SCHEMAS[name]
    full = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(full, schema)


def scr(sid, mid, date, **kw):
    base = dict(screening_id=sid, member_id=mid, scn_region="R", county="C", screening_date=date,
                screening_tool="PRAPARE", screener_role="Nurse", hrsn_flag=True,
                primary_need_type="Housing", food_insecurity=False, housing_instability=False,
                transportation_need=False, utility_need=False, interpersonal_safety=False)
    base.update(kw)
    return base


def mem(mid, **kw):
    base = dict(member_id=mid, first_name=" A ", last_name="B", date_of_birth="1990-01-01", age=30,
                race_ethnicity="X", county="C", scn_region="R", risk_tier="Low")
    base.update(kw)
    return base


# --- staging ---------------------------------------------------------------

def test_unparseable_date_passes_validity_filter(spark):
    """Q1: null date but flag false, so the row reaches member screenings."""
    s = ops.stage_screenings(raw(spark, "screenings", [scr("S1", "M1", "not-a-date")]))
    r = s.first()
    assert r["screening_date"] is None and r["null_date_flag"] is False
    ms = ops.member_screenings(ops.dedupe_latest(s),
                               ops.stage_members(raw(spark, "members", [mem("M1")])))
    assert ms.count() == 1
    strict = ops.stage_screenings(raw(spark, "screenings", [scr("S1", "M1", "not-a-date")]),
                                  flag_on="parsed")
    assert strict.first()["null_date_flag"] is True


def test_age_bands(spark):
    m = ops.stage_members(raw(spark, "members", [mem(f"M{a}", age=a) for a in (17, 18, 64, 65)]
                              + [mem("Mn", age=None)]))
    got = {r["member_id"]: (r["is_child"], r["is_senior"]) for r in m.collect()}
    assert got == {"M17": (True, False), "M18": (False, False), "M64": (False, False),
                   "M65": (False, True), "Mn": (False, False)}


def test_renewal_flag_case_sensitive(spark):
    r = ops.stage_renewals(raw(spark, "renewals", [
        dict(renewal_id="R1", member_id="M1", renewal_outcome="Disenrolled"),
        dict(renewal_id="R2", member_id="M2", renewal_outcome="disenrolled"),
        dict(renewal_id="R3", member_id="M3", renewal_outcome=None)]))
    assert {x["renewal_id"]: x["is_disenrolled"] for x in r.collect()} == {
        "R1": True, "R2": False, "R3": False}


# --- dedupe ------------------------------------------------------------------

def test_dedupe_latest_nulls_last(spark):
    s = ops.stage_screenings(raw(spark, "screenings", [
        scr("S1", "M1", "2024-03-01"), scr("S1", "M1", "2024-05-01"), scr("S1", "M1", None)]))
    out = ops.dedupe_latest(s).collect()
    assert len(out) == 1 and out[0]["screening_date"] == D(2024, 5, 1)


def test_dedupe_tie_is_partition_invariant(spark):
    recs = [scr("S1", "M1", "2024-05-01", screener_role=role)
            for role in ("Nurse", "Social Worker", "Care Coordinator")]
    s = ops.stage_screenings(raw(spark, "screenings", recs))
    winners = set()
    for n in (1, 4, 64):
        winners.add(ops.dedupe_latest(s.repartition(n)).first()["screener_role"])
    assert winners == {"Care Coordinator"}


def test_dedupe_plans_partial_group_limit(spark):
    s = ops.stage_screenings(raw(spark, "screenings", [scr("S1", "M1", "2024-05-01")]))
    plan = ops.dedupe_latest(s)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_batches_merge_to_the_full_run(spark):
    recs = [scr(f"SCR{i % 57:05d}", f"M{i % 7}", None if i % 11 == 0 else str(D(2024, 1, 1) + dt.timedelta(days=i * 37 % 60)),
                screener_role=f"role {i % 5}") for i in range(300)]
    s = ops.stage_screenings(raw(spark, "screenings", recs))
    number = F.row_number().over(Window.orderBy("screening_id", "screening_date", "screener_role"))
    batches = s.withColumn("__b", number % 3)
    path = tempfile.mkdtemp(prefix="nb-latest-") + "/table"
    for b in range(3):
        merge_latest(path, batches.where(F.col("__b") == b).drop("__b"), range_of=id_range("screening_id", 1))
    assert rows(read_latest(spark, path).select(*s.columns)) == rows(ops.dedupe_latest(s))


def test_a_batch_rewrites_only_touched_ranges(spark):
    s = ops.stage_screenings(raw(spark, "screenings", [scr(f"SCR{i:05d}", "M1", "2024-01-01") for i in range(50)]))
    path = tempfile.mkdtemp(prefix="nb-latest-") + "/table"
    merge_latest(path, s, range_of=id_range("screening_id", 1))
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/key_range=*/*.parquet")}
    again = ops.stage_screenings(raw(spark, "screenings", [scr("SCR00031", "M2", "2024-02-01")]))
    merge_latest(path, again, range_of=id_range("screening_id", 1))
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/key_range=*/*.parquet")}
    assert {f for f in before if f not in after} == {f for f in before if "key_range=SCR0003/" in f}
    assert all(before[f] == after[f] for f in before if f in after)
    got = {r["screening_id"]: r["member_id"] for r in read_latest(spark, path).collect()}
    assert len(got) == 50 and got["SCR00031"] == "M2" and got["SCR00030"] == "M1"


# --- sequence ------------------------------------------------------------------

def test_sequence_nulls_last(spark):
    s = ops.stage_screenings(raw(spark, "screenings", [
        scr("S1", "M1", "not-a-date"), scr("S2", "M1", "2024-02-01"), scr("S3", "M1", "2024-01-01")]))
    ms = ops.member_screenings(s, ops.stage_members(raw(spark, "members", [mem("M1")])))
    got = {r["screening_id"]: (r["screening_seq"], r["prior_screening_date"]) for r in ms.collect()}
    assert got == {"S3": (1, None), "S2": (2, D(2024, 1, 1)), "S1": (3, D(2024, 2, 1))}


def _random_events(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    recs = []
    for i in range(n):
        # member 0 holds about a third of all rows, with many same-day ties
        m = 0 if rnd.random() < 0.34 else rnd.randrange(1, 60)
        d = None if rnd.random() < 0.05 else D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(40))
        recs.append((f"M{m}", f"E{i:05d}", d))
    return spark.createDataFrame(recs, "member_id string, screening_id string, screening_date date")


def test_sequence_hot_split_equals_plain(spark):
    ev = _random_events(spark)
    plain = ops.sequence_events(ev, hot_key_rows=None)
    split = ops.sequence_events(ev, hot_key_rows=50, num_chunks=7)
    assert rows(plain) == rows(split)


def test_sequence_repartition_invariant(spark):
    ev = _random_events(spark, n=800)
    base = rows(ops.sequence_events(ev, hot_key_rows=None))
    for n in (1, 4, 64):
        assert rows(ops.sequence_events(ev.repartition(n), hot_key_rows=None)) == base


# --- linkage -------------------------------------------------------------------

def _linkage(spark, screens, services):
    s = ops.stage_screenings(raw(spark, "screenings", screens))
    members = {r["member_id"] for r in screens}
    ms = ops.member_screenings(s, ops.stage_members(raw(spark, "members", [mem(m) for m in members])))
    sv = ops.stage_services(raw(spark, "services", services))
    return ops.link_first_followup(ms, sv)


def svc(sid, mid, scid, date, days):
    return dict(service_id=sid, member_id=mid, screening_id=scid, service_date=date, days_to_service=days)


def test_gap_flags(spark):
    screens = [scr("S30", "M1", "2024-01-01"), scr("S31", "M1", "2024-01-02"),
               scr("S0", "M1", "2024-01-03"), scr("SN", "M1", "2024-01-04", hrsn_flag=False)]
    services = [svc("V1", "M1", "S30", "2024-01-31", 30), svc("V2", "M1", "S31", "2024-02-02", 31)]
    got = {r["screening_id"]: (r["service_gap_flag"], r["no_service_flag"], r["total_services"])
           for r in _linkage(spark, screens, services).collect()}
    assert got == {"S30": (False, False, 1), "S31": (True, False, 1), "S0": (True, True, 0),
                   "SN": (False, False, 0)}


def test_independent_minima(spark):
    """Q7: earliest date and fewest days come from different services."""
    services = [svc("V1", "M1", "S1", "2024-05-01", 9), svc("V2", "M1", "S1", "2024-05-03", 2)]
    r = _linkage(spark, [scr("S1", "M1", "2024-04-20")], services).first()
    assert (r["first_service_date"], r["days_to_first_service"], r["total_services"]) == (
        D(2024, 5, 1), 2, 2)


def _random_services(spark, n=700, seed=5):
    rnd = random.Random(seed)
    return spark.createDataFrame(
        [(f"M{0 if rnd.random() < 0.3 else rnd.randrange(1, 60)}",
          None if rnd.random() < 0.05 else D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(45)))
         for _ in range(n)] + [(None, D(2024, 1, 5))], "member_id string, service_date date")


def test_followup_methods_equal_range_join(spark):
    ev = _random_events(spark, n=600).withColumn("county", F.lit("C")) \
        .withColumn("primary_need_type", F.when(F.col("screening_id") > "E00300", "Housing"))
    ev = ev.unionByName(ev.limit(3).withColumn("member_id", F.lit(None).cast("string")))
    sv = _random_services(spark)
    want = rows(ops.first_followup_after(ev, sv, method="join"))
    assert rows(ops.first_followup_after(ev, sv)) == want
    assert rows(ops.first_followup_after(ev, sv, method="scan")) == want


def test_followup_same_day_and_before(spark):
    ev = spark.createDataFrame([("M1", "C", "H", D(2024, 1, 10)), ("M1", "C", "H", None), ("M2", "C", "H", D(2024, 1, 1))],
                               "member_id string, county string, primary_need_type string, screening_date date")
    sv = spark.createDataFrame([("M1", D(2024, 1, 9)), ("M1", D(2024, 1, 10)), ("M1", D(2024, 1, 11))],
                               "member_id string, service_date date")
    for method in ("days", "scan"):
        got = {(r["member_id"], r["screening_date"]): r["first_service_date"]
               for r in ops.first_followup_after(ev, sv, method=method).collect()}
        assert got == {("M1", D(2024, 1, 10)): D(2024, 1, 10), ("M1", None): None, ("M2", D(2024, 1, 1)): None}


def test_binary_search_finds_every_place(spark):
    days = [D(2024, 1, 1) + dt.timedelta(days=3 * i) for i in range(37)]
    df = spark.createDataFrame([(days[:n], days[0] + dt.timedelta(days=k)) for n in (0, 1, 2, 3, 8, 37)
                                for k in range(-2, 115)], "a array<date>, d date")
    for r in df.select("a", "d", first_at_or_after(F.col("a"), F.col("d")).alias("f")).collect():
        assert r["f"] == min((x for x in r["a"] if x >= r["d"]), default=None)


def test_hot_member_days_are_reduced_before_they_meet(spark):
    """200,000 services of one member on one day reach the shuffle as one row a task."""
    sv = spark.range(200_000, numPartitions=4).select(F.lit("M0").alias("member_id"), F.lit(D(2024, 2, 1)).alias("service_date"))
    days = follow_up_days(sv, "member_id", "service_date")
    assert [(r[0], list(r[1])) for r in days.collect()] == [("M0", [D(2024, 2, 1)])]
    lines = days._jdf.queryExecution().executedPlan().toString().split("\n")
    deepest = [ln for ln in lines if "Exchange" in ln or "HashAggregate" in ln]
    # below the first exchange stands the partial distinct
    assert "HashAggregate" in deepest[-1] and "Exchange" in deepest[-2]
    ev = spark.createDataFrame([("M0", "C", "H", D(2024, 1, 10))],
                               "member_id string, county string, primary_need_type string, screening_date date")
    assert ops.first_followup_after(ev, sv).first()["first_service_date"] == D(2024, 2, 1)


# --- heavy keys ----------------------------------------------------------------

def test_heavy_keys_are_exact(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "warm").when(
        F.col("id") % 7 == 2, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 4000)).alias("k"))
    counts = {r["k"]: r["count"] for r in df.where("k is not null").groupBy("k").count().collect()}
    total = sum(counts.values())
    for share in (0.2, 0.01, 0.001):
        found = heavy_keys(df, "k", share, min_rows=0)
        assert found.column == "k"
        assert set(found.parts) == {k for k, n in counts.items() if n > share * total}
        assert all(p >= 2 for p in found.parts.values())
    assert heavy_keys(df.where("false"), "k").parts == {}
    assert heavy_keys(df, "k", 0.001, min_rows=counts["hot"]).parts == {}
    # candidates from a superset: counted in the table itself
    some = df.where("k <> 'warm'")
    assert set(heavy_keys(some, "k", 0.01, min_rows=0, candidates_from=df).parts) == {"hot"}


def test_salted_join_equals_left_join(spark):
    rnd = random.Random(8)
    left = spark.createDataFrame([(f"M{i}" if i < 70 else None, i) for i in range(75)] + [("M0", 99)], "member_id string, x int")
    right = spark.createDataFrame([("M0" if rnd.random() < 0.4 else f"M{rnd.randrange(1, 50)}", i) for i in range(900)]
                                  + [(None, -1)], "member_id string, y int")
    heavy = heavy_keys(right, "member_id", 0.1, min_rows=0)
    assert set(heavy.parts) == {"M0"}
    assert rows(salted_left_join(left, right, heavy)) == rows(left.join(right, "member_id", "left"))


# --- outcomes / marts -------------------------------------------------------

def test_outcome_fanout_and_counts_equal(spark):
    screens = [scr("S1", "M1", "2024-01-01"), scr("S2", "M1", "2024-02-01")]
    link = _linkage(spark, screens, [])
    ren = ops.stage_renewals(raw(spark, "renewals", [
        dict(renewal_id="R1", member_id="M1", county="C", scn_region="R", renewal_outcome="Disenrolled"),
        dict(renewal_id="R2", member_id="M2", county="C", scn_region="R", renewal_outcome="Renewed")]))
    safe = ops.join_outcomes(ren, link)
    assert rows(safe) == rows(ops.join_outcomes(ren, link, heavy=heavy_keys(link, "member_id", 0.3, min_rows=0)))
    assert safe.count() == 3  # M1 fans out to 2 rows; M2 kept once with NULL need
    m = ops.stage_members(raw(spark, "members", [mem("M1"), mem("M2")]))
    risk = {r["race_ethnicity"]: r for r in ops.risk_intersection(safe, m).collect()}
    r = risk["X"]
    assert (r["total_members"], r["coverage_lapsed"], r["disenrollment_rate_pct"]) == (2, 2, 100.0)
    grain = ops.risk_intersection(safe, m, grain="member").first()
    assert grain["coverage_lapsed"] == 1
    for unmet in ("need", "gap"):
        for how in ("row", "member"):
            want = rows(ops.risk_intersection(ops.join_outcomes(ren, link, unmet), m, grain=how))
            assert rows(ops.risk_from_linkage(ren, link, m, grain=how, unmet=unmet)) == want


def test_milestone_empty_group_and_window(spark):
    members = ops.stage_members(raw(spark, "members", [mem("M1", scn_region="A"), mem("M2", scn_region="A"),
                                                       mem("M3", scn_region="B")]))
    s = ops.stage_screenings(raw(spark, "screenings", [
        scr("S1", "M1", "2024-03-31", scn_region="A"), scr("S2", "M2", "2024-04-01", scn_region="A")]))
    ms = ops.member_screenings(s, members)
    perf = {r["scn_region"]: r for r in ops.milestone_performance(members, ms).collect()}
    assert perf["A"]["screened_dy26"] == 1 and perf["A"]["total_screened"] == 2
    assert perf["A"]["dy26_milestone_status"] == "On track"  # 1 of 2 members >= 25 %
    b = perf["B"]
    assert b["total_screened"] is None and b["dy26_milestone_status"] == "Behind milestone"
    order = [r["scn_region"] for r in ops.milestone_performance(members, ms).collect()]
    assert order == ["A", "B"]  # NULL rate sorts last


def test_risk_from_members_counts_pairs_without_blowup(spark):
    """Q17: N renewal rows × M screening rows are counted, not formed."""
    members = ops.stage_members(raw(spark, "members", [mem("M1")]))
    screens = [scr(f"S{i}", "M1", f"2024-01-0{i}") for i in range(1, 4)]
    link = _linkage(spark, screens, [])
    ren = ops.stage_renewals(raw(spark, "renewals", [
        dict(renewal_id="R1", member_id="M1", county="C", scn_region="R", renewal_outcome="Disenrolled")]))
    out = ops.join_outcomes(ren, link)  # 3 rows for M1
    ms = ops.member_screenings(ops.stage_screenings(raw(spark, "screenings", screens)), members)
    r = ops.risk_from_members(members, out, ms).first()
    assert (r["total_members"], r["coverage_lapsed"], r["lapsed_with_unmet_hrsn"]) == (1, 9, 9)
    assert ops.risk_from_members_linkage(members, ren, link).first() == r


def test_member_screenings_pre_join_hot_split_equals_plain(spark):
    rnd = random.Random(11)
    recs, mids = [], set()
    for i in range(1500):
        m = "M0" if rnd.random() < 0.34 else f"M{rnd.randrange(1, 40)}"
        mids.add(m)
        d = "not-a-date" if rnd.random() < 0.03 else str(D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(30)))
        recs.append(scr(f"S{i:05d}", m, d, hrsn_flag=rnd.random() < 0.5))
    s = ops.dedupe_latest(ops.stage_screenings(raw(spark, "screenings", recs)))
    m = ops.stage_members(raw(spark, "members", [mem(x, age=len(x)) for x in sorted(mids)]))
    plain = ops.member_screenings(s, m, hot_key_rows=None)
    split = ops.member_screenings(s, m, hot_key_rows=100, num_chunks=5)
    assert rows(plain) == rows(split)


def test_hot_split_reads_the_screenings_once(spark):
    n = 40
    recs = [scr(f"S{i:02d}", "M1" if i % 2 else f"M{i}", f"2024-01-{i % 28 + 1:02d}") for i in range(n)]
    s = ops.stage_screenings(raw(spark, "screenings", recs))
    m = ops.stage_members(raw(spark, "members", [mem(x) for x in {r["member_id"] for r in recs}]))
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x

    watched = s.withColumn("county", F.udf(look, "string").asNondeterministic()("county"))
    got = ops.member_screenings(watched, m, hot_key_rows=5, num_chunks=3, counts_from=s)
    assert rows(got) == rows(ops.member_screenings(s, m, hot_key_rows=None))
    assert seen.value == n


def test_hot_keys_are_counted_once(spark):
    from needbridge.operators.skew import split_hot

    ev, seen = _random_events(spark, n=300), spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x

    counted = ev.withColumn("member_id", F.udf(look, "string").asNondeterministic()("member_id"))
    split = split_hot(ev, "member_id", 50, counted.select("member_id"))
    assert split.cold.count() + split.hot.count() == 300
    assert seen.value == 300
