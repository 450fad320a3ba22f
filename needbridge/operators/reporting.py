"""Top-k tables, whole-table summaries, cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.functions import age_years, safe_date

c = F.col


def top_k(df: DataFrame, metric: str, k: int = 10, tiebreak: Sequence[str] = ()) -> DataFrame:
    """First k rows by ``metric`` (desc, nulls last), ties broken by ``tiebreak``.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k and only k rows per task reach the final merge.
    """
    return df.orderBy(c(metric).desc_nulls_last(), *[c(t).asc_nulls_last() for t in tiebreak]).limit(k)


def table_summary(df: DataFrame, flags: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """One row: row count, share of each flag, distinct count of each category.

    The rows are first reduced to the category combinations that occur, with
    counts, so the several distinct counts expand combinations, not rows.
    """
    combos = df.groupBy(*categories).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(f).alias(f"__known{i}") for i, f in enumerate(flags)],
        *[F.count_if(c(f)).alias(f"__true{i}") for i, f in enumerate(flags)])
    return combos.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"),
        *[(F.sum(f"__true{i}") / F.nullif(F.sum(f"__known{i}"), F.lit(0))).alias(f"{f}_rate")
          for i, f in enumerate(flags)],
        *[F.countDistinct(x).alias(f"{x}_distinct") for x in categories],
    )


def eligible_cohort(screenings_raw: DataFrame, need: str = "hrsn_flag",
                    ts: str = "screening_date") -> DataFrame:
    """Rows with a need and a parseable date, date typed."""
    return (screenings_raw.withColumn("__d", safe_date(ts))
            .where(c(need) & c("__d").isNotNull())
            .withColumn(ts, c("__d")).drop("__d"))


def cohort_counts(screenings_raw: DataFrame, group: str = "scn_region", need: str = "hrsn_flag",
                  ts: str = "screening_date") -> DataFrame:
    """Per group: eligible rows and rows skipped for want of a date."""
    d = safe_date(ts)
    return screenings_raw.groupBy(group).agg(
        F.count_if(c(need) & d.isNotNull()).alias("eligible"),
        F.count_if(c(need) & d.isNull()).alias("skipped_no_date"),
    )


def with_age(members: DataFrame, as_of: str, dob: str = "date_of_birth",
             out: str = "age_years") -> DataFrame:
    """Whole years at ``as_of`` (days // 365), null for an unknown birth date."""
    return members.withColumn(out, age_years(dob, as_of))
