"""End-to-end run: raw sources → staging → intermediate → marts → exports.

Layer by layer.  Each stage is written to a folder of the run, and the row
rules on it are observed by that same write.  When a layer's stages are there,
the checks that need groups or a second table run on their files (key columns
only).  Only if no error check failed is the layer published, by one new
manifest file; otherwise the run halts, the earlier published state stays as
it was, and no later stage or export is written.

Stages are re-read from their files, which cuts lineage: a lost executor
recomputes from the layer before.  A stage whose inputs, parameters and rules
are those of the published one is not computed again, so a run that died
resumes after its last published layer.  Sources that are absent take the stages that
need them out of the run; their names are in the result.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from needbridge.operators import gap_index
from needbridge.operators import quality as dq
from needbridge.operators import rules as ru
from needbridge.plans.stages import Stages
from needbridge.schemas import NEED_TYPES
from needbridge.sources import manifest as mf
from needbridge.sources.raw import register
from needbridge.sources.sinks import export_csv

#: Changes when a stage's meaning does, so that older outputs are not taken for its result.
VERSION = 1

LAYERS = (("staging", Stages.STAGING), ("intermediate", Stages.INTERMEDIATE), ("marts", Stages.MARTS))

NEEDS = {
    "stg_members": ("members",),
    "stg_screenings": ("screenings",),
    "stg_services": ("services",),
    "stg_renewals": ("renewals",),
    "int_screenings_deduped": ("stg_screenings",),
    "int_member_screenings": ("int_screenings_deduped", "stg_members"),
    "int_service_linkage": ("int_member_screenings", "stg_services"),
    "int_renewal_hrsn": ("stg_renewals", "int_service_linkage"),
    "mart_scn_performance": ("stg_members", "int_member_screenings"),
    "mart_service_gap_index": ("int_service_linkage",),
    "mart_renewal_hrsn_risk": ("stg_renewals", "int_service_linkage", "stg_members"),
}


def stage_rules() -> dict[str, list[ru.Rule]]:
    """Row rules observed while a stage is written."""
    ids = [ru.null_rate("member_id"), ru.null_rate("scn_region")]
    return {
        "stg_members": ids,
        "stg_screenings": [*ids, ru.allowed("primary_need_type", NEED_TYPES, where=F.col("hrsn_flag"))],
        "mart_scn_performance": [ru.complete("dy26_milestone_status")],
    }


def mart_order() -> dict[str, list]:
    """Export order of each mart: metric descending, then its keys."""
    return {
        "mart_scn_performance": [F.col("screening_rate_pct").desc_nulls_last(), "scn_region"],
        "mart_service_gap_index": [F.col("service_gap_rate_pct").desc_nulls_last(), "county",
                                   "scn_region", "primary_need_type"],
        "mart_renewal_hrsn_risk": [F.col("high_risk_rate_pct").desc_nulls_last(), "county",
                                   "scn_region", "race_ethnicity"],
    }


def _screening_keys(s: Stages) -> DataFrame:
    return dq.suite(
        dq.duplicates(s.int_screenings_deduped, "screening_id", "intermediate", "int_screenings_deduped"),
        dq.referential(s.int_screenings_deduped, s.stg_members, "member_id", "intermediate", "screenings->members"))


#: Checks that need groups or two tables (D5, D6, D8, D9): the stage judged, the stages read, the check.
TABLE_CHECKS = (
    ("int_screenings_deduped", ("int_screenings_deduped", "stg_members"), _screening_keys),
    ("mart_service_gap_index", ("int_service_linkage",),
     lambda s: dq.gap_alert(gap_index(s.int_service_linkage, ["county"]))),
    ("mart_scn_performance", ("mart_scn_performance",), lambda s: dq.milestone_alert(s.mart_scn_performance)),
)


def quality_suite(s: Stages) -> DataFrame:
    """The README's checks over one pipeline run (§2.10), one aggregate per table for the row rules."""
    layer_of = {name: layer for layer, names in LAYERS for name in names}
    return dq.suite(
        *[ru.profile(getattr(s, name), rules, layer_of[name], name) for name, rules in stage_rules().items()],
        *[check(s) for _, _, check in TABLE_CHECKS])


@dataclass
class RunResult:
    run_id: str
    paths: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    reused: list[str] = field(default_factory=list)
    skipped_stages: dict[str, list[str]] = field(default_factory=dict)
    skipped_exports: list[str] = field(default_factory=list)
    quality: DataFrame | None = None


RESULT_SCHEMA = ("check string, layer string, scope string, observed double, threshold double, "
                 "severity string, passed boolean")


def _fingerprints(raw: Mapping[str, DataFrame], params: list, rules: Mapping[str, Sequence[ru.Rule]],
                  given: Mapping[str, str] | None) -> dict[str, str]:
    out = {name: (given or {}).get(name) or mf.input_fingerprint(df) for name, df in raw.items()}
    for name, needs in NEEDS.items():
        if all(n in out for n in needs):
            of_rules = [(r.check, str(r.observed), r.bound, r.at_most, r.severity) for r in rules.get(name, ())]
            out[name] = mf.digest(VERSION, name, params, of_rules, [out[n] for n in needs])
    return out


def run_pipeline(
    spark: SparkSession,
    raw: Mapping[str, DataFrame | None],
    out_dir: str,
    window: tuple[str, str] | None = None,
    export: bool = True,
    halt_on_error: bool = True,
    rules: Mapping[str, Sequence[ru.Rule]] | None = None,
    layout: str = "single",
    fingerprints: Mapping[str, str] | None = None,
) -> RunResult:
    """Run, check and publish all stages below ``out_dir``.

    ``halt_on_error=False`` publishes a layer in spite of failed checks.
    ``rules`` replaces ``stage_rules()``; ``fingerprints`` may give a source's
    version (a snapshot id) in place of its files.
    """
    raw = {n: df for n, df in raw.items() if df is not None}
    rules = stage_rules() if rules is None else rules
    s = Stages(raw, **({"window": window} if window else {}))
    res = RunResult(run_id=uuid.uuid4().hex[:12])
    state = mf.Manifest(spark, out_dir)
    marks = _fingerprints(raw, [list(s.window)], rules, fingerprints)
    checked: list[dict] = []
    for layer, names in LAYERS:
        entries: dict[str, dict] = {}
        seen: set[str] = set()
        # the raw sources that a stage lacks, through all stages before it
        res.skipped_stages |= {n: _lacking(n, marks) for n in names if n not in marks}
        for wave in _waves([n for n in names if n in marks]):
            jobs = {}
            for name in wave:
                old = state.current(name, marks[name])
                # a reused stage passes on the verdicts it was published with
                if old and not (halt_on_error and _failures(old["checks"])):
                    entries[name] = old
                    res.reused.append(name)
                else:
                    jobs[name] = _write_job(s, name, layer, rules.get(name, ()), marks[name],
                                            f"{out_dir}/stages/{name}/{res.run_id}")
            entries |= _run_together(jobs)
            seen |= set(jobs)
            # consumers read the written stages instead of recomputing them
            s.__dict__.update({n: spark.read.parquet(entries[n]["path"]) for n in wave})
        for name, needs, check in TABLE_CHECKS:
            if name in seen and all(n in marks for n in needs):
                entries[name]["checks"] += [r.asDict() for r in check(s).collect()]
        verdicts = [v for e in entries.values() for v in e["checks"]]
        checked += verdicts
        failed = _failures(verdicts)
        if failed and halt_on_error:
            mf.write_new_text(spark, f"{out_dir}/_halted/{res.run_id}.json", json.dumps(
                {"layer": layer, "stages": entries, "failed": failed}, indent=1, sort_keys=True))
            raise dq.QualityError(f"{layer}: {dq.describe(failed)}")
        if seen:
            state.publish(entries, res.run_id)
        res.paths |= {n: e["path"] for n, e in entries.items()}
        res.rows |= {n: e["rows"] for n, e in entries.items()}
    res.quality = spark.createDataFrame(checked, RESULT_SCHEMA)
    if export:
        marts = {n: spark.read.parquet(res.paths[n]) if n in res.paths else None for n in Stages.MARTS}
        res.skipped_exports = export_csv(marts, f"{out_dir}/exports", order_by=mart_order(), layout=layout)
    return res


def _waves(names: Sequence[str]) -> list[list[str]]:
    """Stages of a layer in groups that do not need each other."""
    out: list[list[str]] = []
    left = list(names)
    while left:
        wave = [n for n in left if not set(NEEDS[n]) & set(left)]
        out.append(wave)
        left = [n for n in left if n not in wave]
    return out


def _write_job(s: Stages, name: str, layer: str, rules: Sequence[ru.Rule], mark: str, path: str) -> Callable[[], dict]:
    """Plan one stage; the returned call writes it and gives its manifest entry."""
    table, obs = ru.watch(getattr(s, name), rules, f"{name}-{path.rsplit('/', 1)[-1]}")

    def write() -> dict:
        table.write.mode("errorifexists").parquet(path)
        seen = obs.get
        return {"path": path, "fingerprint": mark, "rows": int(seen["rows"]),
                "checks": ru.verdicts(rules, seen, layer, name)}

    return write


def _run_together(jobs: Mapping[str, Callable[[], dict]]) -> dict[str, dict]:
    """The jobs' results; Spark runs their tasks side by side."""
    if len(jobs) < 2:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: r.result() for name, r in running.items()}


def _lacking(name: str, marks: Mapping[str, str]) -> list[str]:
    if name not in NEEDS:
        return [] if name in marks else [name]
    return sorted({x for n in NEEDS[name] for x in _lacking(n, marks)})


def _failures(verdicts: Sequence[dict]) -> list[dict]:
    return [v for v in verdicts if v["severity"] == dq.ERROR and not v["passed"]]


def open_run(spark: SparkSession, out_dir: str, views: bool = False) -> dict[str, DataFrame]:
    """The published stages as DataFrames; as temporary views of their names too if ``views`` (S3)."""
    tables = {n: spark.read.parquet(e["path"]) for n, e in mf.Manifest(spark, out_dir).stages.items()}
    if views:
        register(tables)
    return tables


def drop_unpublished(spark: SparkSession, out_dir: str) -> list[str]:
    """Remove stage folders that the current manifest does not name (failed or replaced runs)."""
    keep = {e["path"] for e in mf.Manifest(spark, out_dir).stages.values()}
    gone = [p for name in mf.children(spark, f"{out_dir}/stages") for run in mf.children(spark, f"{out_dir}/stages/{name}")
            if (p := f"{out_dir}/stages/{name}/{run}") not in keep]
    for p in gone:
        mf.delete(spark, p)
    return gone
