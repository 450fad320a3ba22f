"""Data-quality checks with a halt.

Every check returns rows of one shape::

    check, layer, scope, observed (double), threshold (double), severity, passed

so a suite is a ``unionByName`` of checks and is itself a DataFrame.  Each
check is one aggregate pass over its input (partial aggregation, no
collect); only ``enforce`` brings the (small) result table to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.operators import rules as ru
from needbridge.operators.rules import ERROR, WARN
from needbridge.schemas import TIER_ON_TRACK

c = F.col
RESULT_COLS = ("check", "layer", "scope", "observed", "threshold", "severity", "passed")


class QualityError(RuntimeError):
    """Raised by ``enforce`` when an error-severity check failed."""


def _rows(df: DataFrame, check, layer: str, scope, observed, threshold: float,
          severity: str, passed) -> DataFrame:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    return df.select(
        lit(check).cast("string").alias("check"),
        F.lit(layer).alias("layer"),
        lit(scope).cast("string").alias("scope"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(severity).alias("severity"),
        passed.alias("passed"),
    )


def null_rates(df: DataFrame, cols: Sequence[str], layer: str, scope: str,
               max_rate: float = 0.0) -> DataFrame:
    """Null share per column (D1, D2), all columns in one aggregate; an empty table fails."""
    return ru.profile(df, [ru.null_rate(x, max_rate) for x in cols], layer, scope)


def null_rates_by_group(df: DataFrame, group: str, cols: Sequence[str], layer: str,
                        max_rate: float = 0.0) -> DataFrame:
    """Null share per column within each group (D3)."""
    agg = df.groupBy(group).agg(*[F.avg(c(x).isNull().cast("int")).alias(x) for x in cols])
    stacked = agg.select(group, F.explode(F.array(*[
        F.struct(F.lit(x).alias("col"), c(x).alias("rate")) for x in cols])).alias("r"))
    return _rows(stacked, F.concat(F.lit("null_rate:"), c("r.col")), layer,
                 F.coalesce(c(group), F.lit("<null>")), c("r.rate"), max_rate, ERROR,
                 c("r.rate") <= max_rate)


def allowed_values(df: DataFrame, col: str, allowed: Sequence[str], layer: str, scope: str,
                   where=None) -> DataFrame:
    """Rows whose value is outside ``allowed`` (nulls included)."""
    if where is not None:
        df = df.where(where)
    bad = ~F.coalesce(c(col).isin(*allowed), F.lit(False))
    agg = df.agg(F.count_if(bad).alias("n"))
    return _rows(agg, f"allowed_values:{col}", layer, scope, c("n"), 0, ERROR, c("n") == 0)


def duplicates(df: DataFrame, key: str, layer: str, scope: str) -> DataFrame:
    """Number of key values that occur more than once."""
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    agg = dup.agg(F.count(F.lit(1)).alias("n"))
    return _rows(agg, f"duplicates:{key}", layer, scope, c("n"), 0, ERROR, c("n") == 0)


def referential(child: DataFrame, parent: DataFrame, key: str, layer: str, scope: str,
                min_share: float = 1.0) -> DataFrame:
    """Share of child rows (non-null key) whose key exists in the parent.

    The parent keys are reduced to distinct values before the left join, so
    the join is N:1 and the share is one more aggregate.  Without any such row there is
    no share and the check fails.
    """
    keys = parent.select(c(key).alias("__k")).where(c("__k").isNotNull()).distinct() \
        .withColumn("__hit", F.lit(1))
    ch = child.select(key).where(c(key).isNotNull())
    j = ch.join(keys, ch[key] == keys["__k"], "left")
    agg = j.agg(F.count(F.lit(1)).alias("n"), F.count("__hit").alias("hit"))
    share = c("hit") / F.nullif(c("n"), F.lit(0))
    return _rows(agg, f"referential:{key}", layer, scope, share, min_share, ERROR,
                 F.coalesce(share >= min_share, F.lit(False)))


def completeness(df: DataFrame, col: str, layer: str, scope: str, min_share: float = 1.0) -> DataFrame:
    """Share of non-null values (D7); an empty table fails."""
    return ru.profile(df, [ru.complete(col, min_share)], layer, scope)


def gap_alert(gap_by_place: DataFrame, place: str = "county",
              rate: str = "service_gap_rate_pct", max_rate: float = 80.0) -> DataFrame:
    """One warning row per place; fails where the gap rate exceeds the bound."""
    return _rows(gap_by_place, "gap_rate_anomaly", "marts", c(place), c(rate), max_rate, WARN,
                 F.coalesce(c(rate) <= max_rate, F.lit(True)))


def milestone_alert(perf: DataFrame, group: str = "scn_region", tier_col: str = "dy26_milestone_status",
                    on_track: str = TIER_ON_TRACK, target: float = 0.25) -> DataFrame:
    """Per group: share screened in the window; fails below the top tier."""
    share = c("screened_dy26") / F.nullif(c("total_members"), F.lit(0))
    return _rows(perf, "milestone_threshold", "marts", c(group), share, target, WARN,
                 F.coalesce(c(tier_col) == on_track, F.lit(False)))


def suite(*checks: DataFrame) -> DataFrame:
    out = None
    for ch in checks:
        out = ch if out is None else out.unionByName(ch)
    return out


def describe(failed: Sequence[dict], total: int | None = None) -> str:
    names = ", ".join(f"{r['check']}@{r['scope']}={r['observed']}" for r in failed[:100])
    return f"{len(failed) if total is None else total} data-quality checks failed: {names}"


def enforce(results: DataFrame) -> DataFrame:
    """Halt the run if an error-severity check failed.

    A check without a verdict counts as failed.  The message names the total
    and the first 100; the full list is in ``results``.
    """
    failed = results.where((c("severity") == ERROR) & ~F.coalesce(c("passed"), F.lit(False)))
    total = failed.count()
    if total:
        raise QualityError(describe([r.asDict() for r in failed.limit(100).collect()], total))
    return results
