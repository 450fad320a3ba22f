"""End-to-end run, invariants and arithmetic goldens."""

import csv
import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from needbridge.functions import pct
from needbridge.plans.catalog import DRIVER_WINDOW, stages
from needbridge.operators import rules as ru
from needbridge.operators.quality import QualityError
from needbridge.plans.pipeline import LAYERS, drop_unpublished, open_run, quality_suite, run_pipeline, stage_rules
from needbridge.plans.stages import Stages
from needbridge.sources import driver
from needbridge.sources.manifest import Manifest, PublishConflict
from needbridge.sources.raw import read_sources
from needbridge.sources.sinks import export_csv, preview, write_parquet
from tests.conftest import SF_SMALL, rows
from tests.test_operators import mem, raw, scr, svc


def test_invariants(spark):
    s = stages(spark, SF_SMALL)
    dd = s.int_screenings_deduped
    assert dd.groupBy("screening_id").count().where("count > 1").count() == 0
    n6 = s.int_member_screenings.count()
    assert n6 <= dd.count()
    assert s.int_service_linkage.count() == n6
    link = s.int_service_linkage
    assert link.where(F.col("no_service_flag") & ~F.col("service_gap_flag")).count() == 0
    assert s.int_renewal_hrsn.count() >= s.stg_renewals.count()
    t9 = s.mart_scn_performance.agg(F.sum("total_members")).first()[0]
    t11 = s.mart_renewal_hrsn_risk.agg(F.sum("total_members")).first()[0]
    assert t9 == t11 == s.stg_members.count()


def out_folder():
    return tempfile.mkdtemp(prefix="nb-pipe-")


def clean_sources(spark, n=40):
    """Four sources without a defect: n members, two screenings each, a service and a renewal."""
    members, screens, services, renewals = [], [], [], []
    for i in range(n):
        place = {"county": f"C{i % 3}", "scn_region": f"R{i % 2}"}
        members.append(mem(f"M{i:03d}", race_ethnicity="XY"[i % 2], **place))
        for k in range(2):
            screens.append(scr(f"S{i:03d}{k}", f"M{i:03d}", f"2024-0{5 + k}-1{i % 9}", hrsn_flag=i % 3 > 0, **place))
            if i % 4:
                services.append(svc(f"V{i:03d}{k}", f"M{i:03d}", f"S{i:03d}{k}", f"2024-0{6 + k}-01", 10 + i))
        renewals.append(dict(renewal_id=f"R{i:03d}", member_id=f"M{i:03d}", renewal_outcome="Renewed" if i % 5 else
                             "Disenrolled", language_barrier_flag=False, **place))
    return {"members": raw(spark, "members", members), "screenings": raw(spark, "screenings", screens),
            "services": raw(spark, "services", services), "renewals": raw(spark, "renewals", renewals)}


def stored(spark, sources):
    root = out_folder()
    for name, df in sources.items():
        write_parquet(df, f"{root}/{name}")
    return root


def published(out):
    manifests = sorted(glob.glob(f"{out}/_manifests/*.json"))
    return json.load(open(manifests[-1]))["stages"] if manifests else {}


def test_run_pipeline_writes_stages_and_csv(spark):
    out = out_folder()
    res = run_pipeline(spark, driver.load_all(spark, SF_SMALL), out, window=DRIVER_WINDOW, halt_on_error=False)
    names = [n for _, layer in LAYERS for n in layer]
    assert len(names) == 11 and sorted(res.paths) == sorted(names) == sorted(published(out))
    s = stages(spark, SF_SMALL)
    for name in names:
        assert rows(spark.read.parquet(res.paths[name])) == rows(getattr(s, name)), name
        assert res.rows[name] == spark.read.parquet(res.paths[name]).count()
    files = glob.glob(f"{out}/exports/mart_scn_performance/*.csv")
    assert len(files) == 1
    with open(files[0]) as fh:
        got = list(csv.DictReader(fh))
    assert got and "dy26_milestone_status" in got[0]
    rates = [float(r["screening_rate_pct"]) for r in got if r["screening_rate_pct"]]
    assert rates == sorted(rates, reverse=True)
    assert res.skipped_exports == [] and res.skipped_stages == {}
    # the same checks as the suite over the lazy stages
    assert rows(res.quality.select("check", "scope", "passed")) == rows(
        quality_suite(s).select("check", "scope", "passed"))
    assert not res.quality.where("check = 'null_rate:member_id' and scope = 'stg_screenings'").first()["passed"]


def test_clean_run_passes_and_named_views(spark):
    out = out_folder()
    res = run_pipeline(spark, clean_sources(spark), out)
    assert res.quality.where("severity = 'error' and not passed").count() == 0
    tables = open_run(spark, out, views=True)
    assert len(tables) == 11
    assert spark.sql("SELECT count(*) FROM int_service_linkage").first()[0] == 80
    assert preview(tables["mart_scn_performance"], 1)[0]["total_members"] == 20


def test_one_bad_row_halts_staging(spark):
    out = out_folder()
    src = clean_sources(spark)
    bad = raw(spark, "screenings", [scr("S9990", None, "2024-05-05")])
    with pytest.raises(QualityError, match="staging: .*null_rate:member_id@stg_screenings"):
        run_pipeline(spark, {**src, "screenings": src["screenings"].unionByName(bad)}, out)
    assert published(out) == {} and not os.path.exists(f"{out}/exports")
    assert sorted(os.listdir(f"{out}/stages")) == sorted(LAYERS[0][1])
    (report,) = glob.glob(f"{out}/_halted/*.json")
    assert json.load(open(report))["layer"] == "staging"


def test_one_bad_row_halts_intermediate(spark):
    out = out_folder()
    src = clean_sources(spark)
    orphan = raw(spark, "screenings", [scr("S9990", "M-unknown", "2024-05-05")])
    with pytest.raises(QualityError, match="intermediate: .*referential:member_id"):
        run_pipeline(spark, {**src, "screenings": src["screenings"].unionByName(orphan)}, out)
    assert sorted(published(out)) == sorted(LAYERS[0][1])
    assert not any(n.startswith("mart_") for n in os.listdir(f"{out}/stages"))
    assert not os.path.exists(f"{out}/exports")


def test_one_bad_row_halts_marts(spark):
    out = out_folder()
    src = clean_sources(spark)
    odd = {**stage_rules(), "mart_scn_performance": [
        *stage_rules()["mart_scn_performance"], ru.complete("total_screened")]}
    alone = raw(spark, "members", [mem("M999", scn_region="R-empty")])
    with pytest.raises(QualityError, match="marts: .*completeness:total_screened"):
        run_pipeline(spark, {**src, "members": src["members"].unionByName(alone)}, out, rules=odd)
    assert sorted(published(out)) == sorted([*LAYERS[0][1], *LAYERS[1][1]])
    assert not os.path.exists(f"{out}/exports")


def test_empty_sources_fail_their_checks(spark):
    src = {n: df.where("false") for n, df in clean_sources(spark, 2).items()}
    res = run_pipeline(spark, src, out_folder(), halt_on_error=False)
    failed = {(r["check"], r["scope"]) for r in res.quality.where("severity = 'error' and not passed").collect()}
    assert {("null_rate:member_id", "stg_members"), ("referential:member_id", "screenings->members"),
            ("completeness:dy26_milestone_status", "mart_scn_performance")} <= failed
    assert set(res.rows.values()) == {0}


def test_resume_after_a_run_that_died(spark, monkeypatch):
    root, out = stored(spark, clean_sources(spark)), out_folder()

    def die(*_):
        raise KeyboardInterrupt

    # the third layer's first stage dies, after two layers were published
    monkeypatch.setattr(Stages, "mart_scn_performance", property(die))
    with pytest.raises(KeyboardInterrupt):
        run_pipeline(spark, read_sources(spark, root), out)
    monkeypatch.undo()
    assert sorted(published(out)) == sorted([*LAYERS[0][1], *LAYERS[1][1]])
    before = published(out)
    res = run_pipeline(spark, read_sources(spark, root), out)
    assert sorted(res.reused) == sorted(before)
    assert all(published(out)[n] == before[n] for n in before) and len(published(out)) == 11
    again = run_pipeline(spark, read_sources(spark, root), out)
    assert len(again.reused) == 11 and again.quality.count() == res.quality.count()
    # another window changes every stage's parameters
    assert run_pipeline(spark, read_sources(spark, root), out, window=("2024-05-01", "2024-05-31")).reused == []


def test_changed_source_recomputes_what_depends_on_it(spark):
    src = clean_sources(spark)
    root, out = stored(spark, src), out_folder()
    run_pipeline(spark, read_sources(spark, root), out)
    write_parquet(src["renewals"].limit(5), f"{root}/renewals")
    res = run_pipeline(spark, read_sources(spark, root), out)
    assert sorted(set(published(out)) - set(res.reused)) == ["int_renewal_hrsn", "mart_renewal_hrsn_risk", "stg_renewals"]
    assert res.rows["stg_renewals"] == 5
    gone = drop_unpublished(spark, out)
    assert len(gone) == 3 and all(os.path.isdir(e["path"]) for e in published(out).values())


def test_absent_source_is_skipped_and_named(spark):
    out = out_folder()
    res = run_pipeline(spark, {**clean_sources(spark), "renewals": None}, out)
    assert res.skipped_stages == {n: ["renewals"] for n in ("stg_renewals", "int_renewal_hrsn", "mart_renewal_hrsn_risk")}
    assert res.skipped_exports == ["mart_renewal_hrsn_risk"]
    assert sorted(os.listdir(f"{out}/exports")) == ["mart_scn_performance", "mart_service_gap_index"]
    assert res.quality.where("check = 'referential:member_id'").count() == 1


def test_publish_is_exclusive(spark):
    out = out_folder()
    a, b = Manifest(spark, out), Manifest(spark, out)
    a.publish({"x": {"path": "p"}}, "run-a")
    with pytest.raises(PublishConflict):
        b.publish({"x": {"path": "q"}}, "run-b")
    assert Manifest(spark, out).stages == {"x": {"path": "p"}}
    assert not [f for f in os.listdir(f"{out}/_manifests") if f.endswith(".tmp")]


def test_export_layouts(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("k"))
    out = out_folder()
    assert export_csv({"a": df, "b": None}, out, {"a": [F.col("v").desc()]}, layout="parts", parts=5) == ["b"]
    order = json.load(open(f"{out}/a/_order.json"))
    assert len(order) == 5 and sum(p["rows"] for p in order) == 1000
    got = [int(r["v"]) for p in order for r in csv.DictReader(open(f"{out}/a/{p['file']}"))]
    assert got == list(range(999, -1, -1))
    export_csv({"a": df}, f"{out}/s", {"a": ["v"]})
    (one,) = glob.glob(f"{out}/s/a/*.csv")
    assert [int(r["v"]) for r in csv.DictReader(open(one))] == list(range(1000))


# Rows of the reference's published marts (counts -> percentages).
GOLDEN = [
    # scn performance: total_members, total_screened, hrsn_positive -> rate, prevalence
    ("perf", 2508, 1721, 967, 68.62, 56.19),
    ("perf", 2466, 1684, 882, 68.29, 52.38),
    ("perf", 5014, 3416, 1810, 68.13, 52.99),
    ("perf", 2510, 1703, 944, 67.85, 55.43),
    # gap index: screened_with_need, no_service, gap -> gap rate, no-service rate
    ("gap", 255, 177, 195, 76.47, 69.41),
    ("gap", 184, 121, 138, 75.0, 65.76),
    ("gap", 159, 107, 119, 74.84, 67.3),
    ("gap", 275, 182, 205, 74.55, 66.18),
    # renewal risk: total_members, lapsed, lapsed_with_unmet -> disenroll rate, high-risk rate
    ("risk", 77, 22, 12, 28.57, 15.58),
    ("risk", 93, 24, 13, 25.81, 13.98),
    ("risk", 79, 23, 11, 29.11, 13.92),
    ("risk", 123, 30, 17, 24.39, 13.82),
]


def test_golden_arithmetic(spark):
    data = []
    for kind, a, b, c, r1, r2 in GOLDEN:
        if kind == "perf":
            data.append((b, a, c, b, r1, r2))
        elif kind == "gap":
            data.append((c, a, b, a, r1, r2))
        else:
            data.append((b, a, c, a, r1, r2))
    df = spark.createDataFrame(data, "n1 long, d1 long, n2 long, d2 long, r1 double, r2 double")
    for r in df.select(pct("n1", "d1").alias("p1"), pct("n2", "d2").alias("p2"), "r1", "r2").collect():
        assert (r["p1"], r["p2"]) == (r["r1"], r["r2"])
