"""Data-quality checks, the halt, key-hash sampling, lookups."""

import hashlib
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from needbridge.operators import quality as dq
from needbridge.operators.distinct import distinct_rollup
from needbridge.operators.reporting import table_summary
from needbridge.operators.sampling import sample_exact, sample_share, stratified_sample
from needbridge.sources.lookup import checked_broadcast, lookup


def test_checks_and_enforce(spark):
    df = spark.createDataFrame([("a", "R"), (None, "R"), ("a", None)], "k string, region string")
    res = dq.suite(
        dq.null_rates(df, ["k", "region"], "staging", "t"),
        dq.duplicates(df.where("k is not null"), "k", "staging", "t"),
        dq.gap_alert(spark.createDataFrame([("C1", 85.0), ("C2", 10.0)], "county string, service_gap_rate_pct double")),
    )
    got = {(r["check"], r["scope"]): (r["observed"], r["passed"], r["severity"]) for r in res.collect()}
    assert got[("null_rate:k", "t")][:2] == (pytest.approx(1 / 3), False)
    assert got[("duplicates:k", "t")][:2] == (1.0, False)
    assert got[("gap_rate_anomaly", "C1")] == (85.0, False, "warn")
    with pytest.raises(dq.QualityError):
        dq.enforce(res)
    warn_only = dq.gap_alert(spark.createDataFrame([("C1", 85.0)], "county string, service_gap_rate_pct double"))
    dq.enforce(warn_only)  # warnings never halt


def test_referential_share(spark):
    child = spark.createDataFrame([("a",), ("b",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    r = dq.referential(child, parent, "k", "intermediate", "c->p").first()
    assert r["observed"] == pytest.approx(2 / 3) and r["passed"] is False


def test_sampling_is_repeatable_and_keyed(spark):
    df = spark.range(20000).select(F.format_string("K%06d", "id").alias("k"),
                                   (F.col("id") % 2 == 0).alias("even"))
    a = sample_share(df, 0.1, "k")
    b = sample_share(df.repartition(13), 0.1, "k")
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())
    assert 1700 < a.count() < 2300
    df2 = df.withColumn("tier", F.when(F.col("even"), "Low").otherwise("High"))
    s = stratified_sample(df2, "tier", {"Low": 0.5, "High": 0.9}, "k")
    by = {r["tier"]: r["count"] for r in s.groupBy("tier").count().collect()}
    assert 4700 < by["Low"] < 5300 and 8700 < by["High"] < 9300


def test_exact_samples(spark):
    df = spark.range(5000).select(F.format_string("K%06d", "id").alias("k"), F.when(
        F.col("id") % 5 > 0, (F.col("id") % 3).cast("string")).alias("tier")).unionByName(
        spark.createDataFrame([(None, "0")], "k string, tier string"))
    def first(rows, n, seed=11):
        return sorted(sorted(rows, key=lambda r: (hashlib.md5(f"{r['k']}:{seed}".encode()).hexdigest(), r["k"]))[:n])
    known = [r for r in df.collect() if r["k"]]
    for n in (0, 1, 777, 4999, 5000, 9000):
        got = sample_exact(df, n, "k").collect()
        assert sorted(got) == first(known, n) and len(got) == min(n, 5000)
    tiers = {r["tier"] for r in known}
    got = sample_exact(df.repartition(9), 100, "k", stratum="tier").collect()
    for t in tiers:
        assert sorted(r["k"] for r in got if r["tier"] == t) == [r["k"] for r in first(
            [r for r in known if r["tier"] == t], 100)]
    assert sample_exact(df.where("false"), 5, "k").count() == 0


def test_distinct_rollup(spark):
    rnd = random.Random(4)
    rows = [(None if rnd.random() < 0.02 else f"M{int(rnd.random() ** 2 * 900)}", rnd.choice("AB"),
             rnd.choice(["x", "y", None])) for _ in range(4000)] + [(None, "C", "x")]
    df = spark.createDataFrame(rows, "m string, g string, h string")
    got = {(r["g"], r["h"], r["grouping_level"]): r["n"] for r in distinct_rollup(df, "m", ["g", "h"], "n", parts=3).collect()}
    want = {}
    for m, g, h in rows:
        for key in ((g, h, 0), (g, None, 1), (None, None, 3)):
            want.setdefault(key, set()).add(m)
    assert got == {k: len(v - {None}) for k, v in want.items()}


def test_table_summary(spark):
    df = spark.createDataFrame([(True, "a", 1), (None, "a", 2), (False, None, 2), (True, "b", 1)], "f boolean, x string, y int")
    assert tuple(table_summary(df, ["f"], ["x", "y"]).first()) == (4, 2 / 3, 2, 2)
    assert tuple(table_summary(df.where("false"), ["f"], ["x", "y"]).first()) == (0, None, 0, 0)


def test_empty_input_fails(spark):
    df = spark.createDataFrame([], "k string")
    for check in (dq.null_rates(df, ["k"], "l", "s"), dq.completeness(df, "k", "l", "s"),
                  dq.referential(df, df, "k", "l", "s")):
        r = check.first()
        assert r["observed"] is None and r["passed"] is False


def test_bound_is_checked_again_when_files_change(spark):
    path = tempfile.mkdtemp(prefix="nb-dim-")
    def plan():
        dim = checked_broadcast(spark.read.parquet(path), 5)
        return dim._jdf.queryExecution().logical().toString().lower()
    spark.range(3).write.mode("overwrite").parquet(path)
    assert "broadcast" in plan()
    spark.range(20).write.mode("overwrite").parquet(path)
    assert "broadcast" not in plan()


def test_lookup_default_and_checked_broadcast(spark):
    df = spark.createDataFrame([("Bronx",), ("Nowhere",)], "county string")
    dim = spark.createDataFrame([("Bronx", "NYC-North")], "county string, region string")
    got = {r["county"]: r["region"] for r in lookup(df, dim, "county", "region", default="Unassigned").collect()}
    assert got == {"Bronx": "NYC-North", "Nowhere": "Unassigned"}
    big = spark.range(50)
    plan = big.join(checked_broadcast(spark.range(10).withColumnRenamed("id", "k"), 5),
                    F.col("id") == F.col("k"))._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()  # above the bound: no hint
