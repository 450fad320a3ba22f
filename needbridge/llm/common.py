"""Helpers shared by the operators: table access, shared scratch tables, components.

Intermediate results that several jobs read are written as Parquet below the
folder the cluster names in ``spark.checkpoint.dir``.  Lineage ends there, so a
lost executor recomputes from those files only; ``drop_scratch`` removes them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where none is set (tests)."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    base = conf or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="nb-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/needbridge-{app}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove every table that this application wrote with ``materialize``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/needbridge-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, tag: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, component).

    ``component`` is the smallest node reachable.  Alternating large-star and
    small-star steps: each round joins every node to its smallest neighbour,
    which shortens paths, until the edges form a star forest.  Each round's
    edges are written, so lineage stays one step long.
    """
    high_low = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    both = materialize(edges.where("a <> b").select(*high_low).distinct(), f"{tag}-edges")
    seen = None
    for _ in range(max_rounds):
        state = both.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        # large star: a node's greater neighbours move to the least of it and its neighbours
        sym = both.union(both.select("b", "a"))
        least = sym.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = sym.join(least, sym["a"] == least["n"]).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its lesser neighbours move to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(least, large["a"] == least["n"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        both = materialize(small.where("a <> b").union(least.select("n", "m")).distinct(), f"{tag}-stars")
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    return both.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        both.select("b", "b")).groupBy("node").agg(F.min("component").alias("component"))
