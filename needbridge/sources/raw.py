"""Schema-first Parquet scans of the raw sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from needbridge.schemas import RAW_SCHEMAS


def read_source(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Read one raw source with its fixed schema (no inference).

    A column missing from the files comes back null and is then caught by
    the data-quality checks instead of changing the inferred type.
    """
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(path)


def read_sources(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_source(spark, name, f"{root}/{name}") for name in RAW_SCHEMAS}


def register(tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames to SQL as temp views (lazy, no copy)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def merge_submissions(*batches: DataFrame, batch_col: str | None = None) -> DataFrame:
    """UNION ALL of submission batches by column name.

    Columns missing in a batch are filled with nulls.  With ``batch_col``
    each row carries the 1-based number of the batch it came from.
    """
    from pyspark.sql import functions as F

    out = None
    for i, b in enumerate(batches, start=1):
        if batch_col:
            b = b.withColumn(batch_col, F.lit(i))
        out = b if out is None else out.unionByName(b, allowMissingColumns=True)
    return out
