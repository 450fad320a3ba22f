"""The four programme sources, derived from the driver's TPC-H-style tables.

The reference reads four raw Parquet files (members, screenings, services,
renewals).  Here they are defined as projections of ``customer``, ``orders``
and ``lineitem`` (plus the ``nation``/``region`` dimensions), written so that
an independent SQL engine evaluates exactly the same rows — see
``needbridge.plans.oracle`` for the twin definitions.  Only ``%``, CASE,
string concatenation, zero-padding and day arithmetic are used, and every
derived value depends on a key, so the sources grow with the tables.

The mapping deliberately injects the defects the staging rules exist for:
padded names, missing categories, unparseable or slash-separated dates,
a null and an unknown member id, a tool outside the allow-list, null need
flags, and resubmitted screenings whose later copy differs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from needbridge.functions import padded_id
from needbridge.schemas import DISENROLLED, NEED_TYPES, RAW_SCHEMAS
from needbridge.sources.lookup import checked_broadcast

# Category values of the mapping: placeholders, no rule tests them.
ELIGIBILITY = tuple(f"Group-{i}" for i in range(1, 7))
LANGUAGES = tuple(f"Language-{i}" for i in range(1, 8))
ROLES = tuple(f"Role-{i}" for i in range(1, 5))
OUTCOMES = tuple(f"Result-{i}" for i in range(1, 6))
REASONS = tuple(f"Reason-{i}" for i in range(1, 5))
# Days by which a screening follows its order where the region sees few screenings in the window.
LATE_DAYS = 400
TOOL_BY_PRIORITY = (
    ("1-URGENT", "AHC-HRSN"),
    ("2-HIGH", "PRAPARE"),
    ("3-MEDIUM", "WellRx"),
    ("5-LOW", "HealthLeads"),
)
UNLISTED_TOOL = "UNKNOWN_TOOL"
# Nation and region are fixed-size dimensions (25 and 5 rows at every scale).
GEO_MAX_ROWS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], idx: Column) -> Column:
    """values[idx] for a 0-based integer index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_regionkey", F.col("n_name").alias("county"),
        F.col("r_name").alias("scn_region"))
    return checked_broadcast(geo, GEO_MAX_ROWS)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))


def _risk_tier(acctbal: Column) -> Column:
    return (F.when(acctbal < 3000, "Low").when(acctbal < 6000, "Medium")
            .when(acctbal < 8500, "High").otherwise("Very High"))


def _iso(d: Column) -> Column:
    return d.cast("string")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    df = _customers(spark, sf_dir).select(
        padded_id("MBR", k, 7).alias("member_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("first_name"),
        F.concat(F.col("c_mktsegment"), F.lit("  ")).alias("last_name"),
        F.when(k % 89 == 0, F.lit("unknown"))
        .otherwise(_iso(F.date_add(F.lit("1940-01-01").cast("date"), ((k * 97) % 30000).cast("int"))))
        .alias("date_of_birth"),
        F.when(k % 97 == 0, F.lit(None)).otherwise(k % 86).cast("int").alias("age"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 3 == 0, "Male").when(k % 3 == 1, "Female")
        .otherwise("Non-binary").alias("gender"),
        F.when(k % 20 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("race_ethnicity"),
        "county",
        "scn_region",
        F.lpad(((k * 7919) % 100000).cast("string"), 5, "0").alias("zip_code"),
        pick(ELIGIBILITY, k % 6).alias("eligibility_group"),
        _risk_tier(F.col("c_acctbal")).alias("risk_tier"),
        _iso(F.date_add(F.lit("2018-01-01").cast("date"), ((k * 13) % 1800).cast("int")))
        .alias("enrollment_date"),
        F.concat(F.lit("Plan-"), (k % 6).cast("string")).alias("managed_care_plan"),
        pick(LANGUAGES, F.col("c_nationkey") % 7).alias("primary_language"),
    )
    return df.select([F.col(f.name).cast(f.dataType) for f in RAW_SCHEMAS["members"].fields])


def _screening_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    c = c.join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"))


def _screening_cols(resubmission: bool) -> list[Column]:
    k = F.col("o_orderkey")
    order_day = F.col("o_orderdate").cast("date")
    # regions differ by how many screenings come late, not by how many there are
    day = F.when(k % 5 > F.col("n_regionkey"), F.date_add(order_day, LATE_DAYS)).otherwise(order_day)
    hrsn = k % 20 < 11
    first_date = (
        F.when(k % 37 == 0, F.lit(None).cast("string"))
        .when(k % 41 == 0, F.lit("not-a-date"))
        .when(k % 43 == 0, F.regexp_replace(_iso(day), "-", "/"))
        .otherwise(_iso(day))
    )
    date = F.when(k % 100 == 0, _iso(F.date_add(day, 3))).otherwise(first_date) if resubmission else first_date
    tool = F.lit(UNLISTED_TOOL)
    for prio, name in reversed(TOOL_BY_PRIORITY):
        tool = F.when(F.col("o_orderpriority") == prio, F.lit(name)).otherwise(tool)
    return [
        padded_id("SCR", k, 8).alias("screening_id"),
        F.when(k % 103 == 0, F.lit(None).cast("string"))
        .when(k % 107 == 0, padded_id("MBX", F.col("o_custkey"), 7))
        .otherwise(padded_id("MBR", F.col("o_custkey"), 7)).alias("member_id"),
        "scn_region",
        "county",
        date.alias("screening_date"),
        F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(tool).alias("screening_tool"),
        (F.lit(ROLES[-1]) if resubmission else pick(ROLES, k % 4)).alias("screener_role"),
        hrsn.alias("hrsn_flag"),
        F.when(hrsn & (k % 33 != 0), pick(NEED_TYPES, k % 4)).alias("primary_need_type"),
        (hrsn & (k % 3 == 0)).alias("food_insecurity"),
        (hrsn & (k % 7 < 2)).alias("housing_instability"),
        (hrsn & (k % 9 < 2)).alias("transportation_need"),
        F.when(k % 59 == 0, F.lit(None).cast("boolean")).otherwise(hrsn & (k % 13 < 2)).alias("utility_need"),
        (hrsn & (k % 10 == 0)).alias("interpersonal_safety"),
        F.lit(None).cast("int").alias("needs_count"),
        (k % 12 == 0).alias("data_issue_flag"),
    ]


def screening_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(first submission, resubmission of every 50th screening)."""
    rows = _screening_rows(spark, sf_dir)
    first = rows.select(_screening_cols(False))
    again = rows.where(F.col("o_orderkey") % 50 == 0).select(_screening_cols(True))
    return first, again


def screenings(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, again = screening_batches(spark, sf_dir)
    return first.unionByName(again)


def services(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = (table(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    c = c.join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    # orders meet their customer first: a line item is shuffled once, by its order
    df = li.join(o.join(c, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    k, p, s, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    days = p % 90 + 1
    offset = F.when(ln == 1, days).otherwise(s % 90 + 1).cast("int")
    out = df.select(
        F.concat(padded_id("SVC", k, 8), F.lit("-"), ln.cast("string")).alias("service_id"),
        padded_id("MBR", F.col("o_custkey"), 7).alias("member_id"),
        padded_id("SCR", k, 8).alias("screening_id"),
        "scn_region",
        "county",
        F.when((k % 31 == 0) & (ln == 2), F.lit("pending"))
        .otherwise(_iso(F.date_add(F.col("o_orderdate").cast("date"), offset))).alias("service_date"),
        pick(NEED_TYPES, p % 4).alias("service_type"),
        F.when(p % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Subtype-"), (p % 15).cast("string"))).alias("service_subtype"),
        F.concat(F.lit("CBO-"), (s % 11).cast("string")).alias("cbo_provider"),
        days.cast("int").alias("days_to_service"),
        (days <= 30).alias("within_30_days"),
        pick(OUTCOMES, k % 5).alias("service_outcome"),
        (p % 2 == 0).alias("follow_up_scheduled"),
    )
    return out


def renewals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    m = k % 50
    outcome = (F.when(m < 29, "Kept").when(m < 40, DISENROLLED).when(m < 46, "Open")
               .otherwise("Moved"))
    return _customers(spark, sf_dir).select(
        padded_id("RNW", k, 7).alias("renewal_id"),
        padded_id("MBR", k, 7).alias("member_id"),
        "county",
        "scn_region",
        _risk_tier(F.col("c_acctbal")).alias("risk_tier"),
        pick(ELIGIBILITY, k % 6).alias("eligibility_group"),
        _iso(F.date_add(F.lit("2023-06-01").cast("date"), ((k * 11) % 670).cast("int"))).alias("renewal_date"),
        outcome.alias("renewal_outcome"),
        F.when((m >= 29) & (m < 40) & (k % 7 != 0), pick(REASONS, k % 4)).alias("disenrollment_reason"),
        (k % 6).cast("int").alias("outreach_attempts"),
        ((F.col("c_mktsegment") == "BUILDING") & (k % 3 == 0)).alias("language_barrier_flag"),
    )


SOURCES = {
    "members": members,
    "screenings": screenings,
    "services": services,
    "renewals": renewals,
}


class LazySources(Mapping):
    """The four sources by name, each planned when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = SOURCES[name](self._spark, self._dir)
        return self._built[name]

    def __iter__(self):
        return iter(SOURCES)

    def __len__(self) -> int:
        return len(SOURCES)


def load_all(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return LazySources(spark, sf_dir)
