"""Parquet and CSV sinks."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.sources.manifest import write_new_text


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrite a stage as Parquet; returns the path for re-reading."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write like ``write_parquet`` and return the row count from the same pass.

    The count is an ``Observation`` metric gathered while the write runs,
    so logging a stage's size (the reference prints it) costs no second job.
    """
    from pyspark.sql import Observation

    obs = Observation("rows")
    write_parquet(df.observe(obs, F.count(F.lit(1)).alias("n")), path, partition_by)
    return int(obs.get["n"])


def export_csv(
    marts: Mapping[str, DataFrame | None],
    out_dir: str,
    order_by: Mapping[str, Sequence] | None = None,
    layout: str = "single",
    parts: int = 16,
) -> list[str]:
    """Write each mart as CSV with a header; return the names of absent (``None``) marts.

    ``layout='single'``: one file in the mart's order.  The rows are sorted in
    one task, whatever their number, so it suits marts (aggregates); the stages
    before it keep their parallelism.
    ``layout='parts'``: ``parts`` files, range-partitioned in the mart's order,
    each sorted, read in the order of ``_order.json`` (file names with row counts), which
    is written last.  The layout is the caller's choice and never depends on the size.
    """
    if layout not in ("single", "parts"):
        raise ValueError(layout)
    skipped = []
    for name, df in marts.items():
        if df is None:
            skipped.append(name)
            continue
        keys = (order_by or {}).get(name) or []
        path = f"{out_dir}/{name}"
        if layout == "parts" and keys:
            df = df.repartitionByRange(parts, *keys)
        else:
            df = df.repartition(1 if layout == "single" else parts)
        if keys:
            df = df.sortWithinPartitions(*keys)
        df.write.mode("overwrite").option("header", True).csv(path)
        if layout == "parts":
            _write_order(df, path)
    return skipped


def _write_order(df: DataFrame, path: str) -> None:
    """``_order.json``: the part files in order with their row counts (one row per file comes back)."""
    spark = df.sparkSession
    rows = spark.read.schema(df.schema).option("header", True).csv(path).groupBy(
        F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")).agg(
        F.count(F.lit(1)).alias("rows")).orderBy("file").collect()
    write_new_text(spark, f"{path}/_order.json", json.dumps([r.asDict() for r in rows], indent=1))


def preview(df: DataFrame, n: int = 10) -> list:
    """First n rows for display (the reference prints head(10))."""
    return df.limit(n).collect()
