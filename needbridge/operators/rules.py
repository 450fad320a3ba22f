"""Row rules compiled into one aggregate per table.

A ``Rule`` is one aggregate value with a bound.  A list of rules over one table
is either a DataFrame of check results from a single pass (``profile``), or
metrics that an ``Observation`` gathers while the table is written
(``watch`` / ``verdicts``), so checking a stage costs no pass of its own.
Result columns are those of ``needbridge.operators.quality``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"
c = F.col


@dataclass(frozen=True)
class Rule:
    """``observed`` (one aggregate expression) must be at most, or at least, ``bound``.

    A null value (nothing to observe, e.g. an empty table) fails.
    """

    check: str
    observed: Column
    bound: float
    at_most: bool = True
    severity: str = ERROR

    def passed(self, value: float | None) -> bool:
        if value is None:
            return False
        return value <= self.bound if self.at_most else value >= self.bound

    def holds(self, value: Column) -> Column:
        ok = value <= F.lit(float(self.bound)) if self.at_most else value >= F.lit(float(self.bound))
        return F.coalesce(ok, F.lit(False))


def null_rate(col: str, max_rate: float = 0.0) -> Rule:
    """Share of nulls."""
    return Rule(f"null_rate:{col}", F.avg(c(col).isNull().cast("int")), max_rate)


def allowed(col: str, values: Sequence[str], where: Column | None = None) -> Rule:
    """Number of rows (of those ``where`` holds) whose value is outside ``values``, nulls included."""
    bad = ~F.coalesce(c(col).isin(*values), F.lit(False))
    return Rule(f"allowed_values:{col}", F.count_if(bad if where is None else where & bad), 0)


def complete(col: str, min_share: float = 1.0) -> Rule:
    """Share of values present (D7); an empty table has none and fails."""
    share = F.count(col) / F.nullif(F.count(F.lit(1)), F.lit(0))
    return Rule(f"completeness:{col}", share, min_share, at_most=False)


def _values(rules: Sequence[Rule]) -> list[Column]:
    return [r.observed.cast("double").alias(f"m{i}") for i, r in enumerate(rules)]


def profile(df: DataFrame, rules: Sequence[Rule], layer: str, scope: str) -> DataFrame:
    """One result row per rule from one aggregate over ``df``."""
    row = df.agg(*_values(rules))
    results = F.array(*[F.struct(
        F.lit(r.check).alias("check"), F.lit(layer).alias("layer"), F.lit(scope).alias("scope"),
        c(f"m{i}").alias("observed"), F.lit(float(r.bound)).alias("threshold"), F.lit(r.severity).alias("severity"),
        r.holds(c(f"m{i}")).alias("passed")) for i, r in enumerate(rules)])
    return row.select(F.explode(results).alias("r")).select("r.*")


def watch(df: DataFrame, rules: Sequence[Rule], name: str) -> tuple[DataFrame, Observation]:
    """``df`` with the rules' values and the row count observed by whatever action runs it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *_values(rules)), seen


def verdicts(rules: Sequence[Rule], seen: Mapping[str, float | None], layer: str, scope: str) -> list[dict]:
    """Result rows, as plain dictionaries, of the values that ``watch`` observed."""
    out = []
    for i, r in enumerate(rules):
        value = seen.get(f"m{i}")
        out.append({"check": r.check, "layer": layer, "scope": scope, "observed": value,
                    "threshold": float(r.bound), "severity": r.severity, "passed": r.passed(value)})
    return out
