"""Merkle fixity audit of WARC replicas.

Each archive's records, in offset order, are the leaves of a tree: a leaf is
the SHA-256 of a record's bytes with its offset and length, an inner node the
SHA-256 of its children's hashes and the offset range they cover.  Above the
archives the same tree goes on until one root is left.  Replicas with equal
roots are done; otherwise only children of mismatching nodes are compared,
level by level, down to the damaged records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from needbridge.llm.common import materialize

#: Children of an inner node.
FANOUT = 32
#: Pages that go into one archive of ``records_of``.
PAGES_PER_ARCHIVE = 1000


def records_of(pages: DataFrame) -> DataFrame:
    """Pages as WARC response records: (archive, page_id, seq, offset, length, record).

    An archive holds PAGES_PER_ARCHIVE consecutive page ids, in the order of
    (page_id, url, html); null urls and html are empty.  Rows without an id go
    to archive -1.
    """
    body = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce("url", F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    rows = pages.select(
        F.coalesce(F.floor(F.col("page_id") / PAGES_PER_ARCHIVE), F.lit(-1)).cast("long").alias("archive"),
        F.col("page_id").cast("long").alias("page_id"), F.encode(F.concat(head, body, F.lit("\r\n\r\n")), "utf-8").alias("record"))
    rows = rows.withColumn("length", F.octet_length("record").cast("long"))
    order = Window.partitionBy("archive").orderBy("page_id", "record")
    return rows.withColumn("seq", F.row_number().over(order) - 1).withColumn(
        "offset", F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))


def leaves(records: DataFrame) -> DataFrame:
    """(archive, offset, length, page_id, hash) of each record."""
    return records.select("archive", "offset", "length", "page_id", F.sha2("record", 256).alias("hash"))


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level of nodes (level, archive, node, start, stop, hash)."""
    child = F.struct("node", "start", "stop", "hash")
    return nodes.groupBy("archive", F.floor(F.col("node") / FANOUT).cast("long").alias("up")).agg(
        F.array_sort(F.collect_list(child)).alias("c")).select(
        "archive", F.col("up").alias("node"), F.expr("c[0].start").alias("start"),
        F.expr("array_max(transform(c, x -> x.stop))").alias("stop"),
        F.sha2(F.expr("concat_ws(',', transform(c, x -> concat_ws(':', x.node, x.start, x.stop, x.hash)))"), 256).alias("hash"))


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Damaged records of ``replica``: archive, offset, length, page_id, status, expected, found.

    Both are ``leaves``.  status: damaged (bytes differ), missing (only in the
    primary), extra (only in the replica).  Equal replicas and empty tables
    give no rows.  Records are told apart by (archive, offset); of repeated
    ones the first by (length, hash) counts.
    """
    def single(t: DataFrame) -> DataFrame:
        return t.groupBy("archive", "offset").agg(F.min(F.struct("length", "hash", "page_id")).alias("r")).select(
            "archive", "offset", "r.length", "r.hash", "r.page_id")

    primary, replica = materialize(single(primary), "primary"), materialize(single(replica), "replica")
    places = primary.select("archive", "offset").union(replica.select("archive", "offset")).distinct()
    places = materialize(places.select("archive", "offset", (F.row_number().over(
        Window.partitionBy("archive").orderBy("offset")) - 1).cast("long").alias("node")), "places")
    a, b = _levels(primary, places), _levels(replica, places)
    while len(a) < len(b):
        a.append(materialize(_parents(a[-1]), "nodes"))
    while len(b) < len(a):
        b.append(materialize(_parents(b[-1]), "nodes"))
    # the archives' roots differ where a replica is damaged; descend from there
    wrong = _differing(a[-1], b[-1])
    for k in range(len(a) - 2, -1, -1):
        up = wrong.select(F.col("archive").alias("u_archive"), F.col("node").alias("u_node"))
        below = (F.col("archive") == F.col("u_archive")) & (F.floor(F.col("node") / FANOUT) == F.col("u_node"))
        wrong = materialize(_differing(a[k].join(up, below, "left_semi"), b[k].join(up, below, "left_semi")), "wrong")
    bad = wrong.join(places.withColumnsRenamed({"archive": "p_archive", "node": "p_node"}),
                     (F.col("archive") == F.col("p_archive")) & (F.col("node") == F.col("p_node"))).select("archive", "offset")
    x = primary.select(F.col("archive").alias("xa"), F.col("offset").alias("xo"), F.col("length").alias("xl"),
                       F.col("page_id").alias("xp"), F.col("hash").alias("expected"))
    y = replica.select(F.col("archive").alias("ya"), F.col("offset").alias("yo"), F.col("length").alias("yl"),
                       F.col("page_id").alias("yp"), F.col("hash").alias("found"))
    return (bad.join(x, (F.col("archive") == F.col("xa")) & (F.col("offset") == F.col("xo")), "left")
            .join(y, (F.col("archive") == F.col("ya")) & (F.col("offset") == F.col("yo")), "left")
            .select("archive", "offset", F.coalesce("xl", "yl").alias("length"), F.coalesce("xp", "yp").alias("page_id"),
                    F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra")
                    .otherwise("damaged").alias("status"), "expected", "found"))


def _levels(leaf: DataFrame, places: DataFrame) -> list[DataFrame]:
    """Levels of the archives' trees, the records first; each archive's root is node 0 of the last."""
    at = places.select(F.col("archive").alias("p_archive"), F.col("offset").alias("p_offset"), "node")
    levels = [materialize(leaf.join(at, (F.col("archive") == F.col("p_archive")) & (F.col("offset") == F.col("p_offset"))).select(
        "archive", "node", F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("stop"), "hash"), "leaves")]
    while levels[-1].agg(F.max("node")).first()[0]:
        levels.append(materialize(_parents(levels[-1]), "nodes"))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(archive, node) of the nodes that are not the same in both."""
    x = a.select("archive", "node", F.struct("start", "stop", "hash").alias("x"))
    y = b.select(F.col("archive").alias("ya"), F.col("node").alias("yn"), F.struct("start", "stop", "hash").alias("y"))
    return x.join(y, (F.col("archive") == F.col("ya")) & (F.col("node") == F.col("yn")), "full_outer").where(
        ~F.col("x").eqNullSafe(F.col("y"))).select(
        F.coalesce("archive", "ya").alias("archive"), F.coalesce("node", "yn").alias("node"))


def corpus_root(leaf: DataFrame) -> str | None:
    """Root hash over all archives: their roots, 32 at a time, until one is left; None for no records."""
    places = leaf.select("archive", "offset", (F.row_number().over(
        Window.partitionBy("archive").orderBy("offset", "length", "hash")) - 1).cast("long").alias("node"))
    level = _levels(leaf, materialize(places, "places"))[-1].select(
        F.lit(0).cast("long").alias("archive"), F.col("archive").alias("node"), "start", "stop", "hash")
    while True:
        found = level.agg(F.count("*"), F.first("hash"), F.min("node"), F.max("node")).first()
        if found[0] <= 1:
            return found[1]
        if found[2] < 0:
            level = level.withColumn("node", F.col("node") - found[2])
        level = materialize(_parents(level), "roots")


def damaged_copy(records: DataFrame) -> DataFrame:
    """A replica with faults that hang on a record's own hash: 3 of 256 have a byte changed, 1 of 256 is lost."""
    h = F.sha2("record", 256)
    flipped = F.concat(F.substring("record", 1, 9), F.lit("X").cast("binary"), F.expr("substring(record, 11)"))
    return records.where(~h.startswith("00") & ~h.startswith("80") & ~h.startswith("c0") & ~h.startswith("40")).unionByName(
        records.where(h.startswith("80") | h.startswith("c0") | h.startswith("40")).withColumn("record", flipped))
