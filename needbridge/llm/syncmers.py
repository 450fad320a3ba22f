"""Document fingerprints from closed syncmers.

A k-mer (k code points) is a closed syncmer if the least of its s-mers, by
hash, is its first or its last one.  Whether a k-mer is chosen depends on its
own code points alone, so a passage keeps its anchors wherever it stands, and
the anchors of a text put together from two texts are those of the parts plus
the few that cross the joint (``splice``).  Every stretch of ``window`` k-mers
holds at least one anchor.

Everything is Spark SQL: overlapping s-mers by one look-ahead pattern, sliding
minima by doubling, no Python workers.  Texts are worked through in segments of
``SEGMENT`` code points, so long texts need no long arrays of s-mers.

Defined results: a null text is empty; a text without anchors (too short, or
empty) has one anchor, the hash of the whole text; a null ``doc_id`` comes after
all others; rows that share a ``doc_id`` follow each other by the hash of their
texts and are fingerprinted each; a single document is its own next one; an
empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points of an inner substring, inner substrings of a k-mer, code points of a k-mer.
S, WINDOW = 6, 12
K = S + WINDOW - 1
#: Code points handled at once; bytes of text that one bucket of neighbouring documents aims at.
SEGMENT, BUCKET_BYTES = 8192, 2 << 20
#: Sampled documents per bucket boundary (the sample decides speed only); most boundaries (then buckets grow).
SAMPLES, MAX_BOUNDS = 8, 100_000
_STEP = 256


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _in_segment(segment: Column, offset: Column) -> Column:
    s_mers = F.regexp_extract_all(segment, F.lit(f"(?s)(?=(.{{{S}}}))."), 1)

    def least_of_two(a: Column, apart: int) -> Column:
        later = F.slice(a, apart + 1, F.greatest(F.size(a) - apart, F.lit(0)))
        return F.zip_with(a, later, lambda x, y: F.least(x, y))

    def minima(hashes: Column, width: int, pick) -> Column:
        """``pick(hashes, m)``: ``m[i]`` is the least of ``hashes[i .. i + WINDOW - 1]``."""
        def step(m: Column, done: int) -> Column:
            if done == width:
                return pick(hashes, m)
            apart = min(done, width - done)
            return _let(least_of_two(m, apart), lambda x: step(x, done + apart))
        return step(hashes, 1)

    def pick(h: Column, m: Column) -> Column:
        n = F.size(h) - (WINDOW - 1)
        at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        at = F.filter(at, lambda i: (h[i] == m[i]) | (h[i + (WINDOW - 1)] == m[i]))
        # the s-mers at 0, S, .. and the last one cover the k-mer
        cover = [*range(0, WINDOW - 1, S), WINDOW - 1]
        return F.transform(at, lambda i: F.struct(
            (i + offset).alias("pos"), F.xxhash64(*[h[i + j] for j in cover]).alias("key")))

    return _let(F.transform(s_mers, lambda x: F.xxhash64(x)), lambda h: minima(h, WINDOW, pick))


def anchors(text: Column) -> Column:
    """Closed syncmers of the whole ``text``: array of (pos, key) by position."""
    text = F.coalesce(text, F.lit(""))
    segments = F.sequence(F.lit(0), F.floor(F.length(text) / SEGMENT).cast("int"))
    return F.flatten(F.transform(segments, lambda i: _in_segment(
        F.substring(text, i * SEGMENT + 1, F.lit(SEGMENT + K - 1)), i * SEGMENT)))


def splice(left: Column, keep: Column, right: Column, take: Column, joint: Column) -> Column:
    """Anchors of the first ``keep`` code points of one text followed by the first ``take`` of another.

    ``left`` and ``right`` are the anchors of the whole texts, ``joint`` those
    of the joint (see ``joint_anchors``), placed in the new text already.
    """
    return F.concat(
        F.filter(left, lambda x: x["pos"] + K <= keep), joint,
        F.transform(F.filter(right, lambda x: x["pos"] + K <= take),
                    lambda x: F.struct((x["pos"] + keep).alias("pos"), x["key"].alias("key"))))


def joint_anchors(text: Column, keep: Column) -> Column:
    """Anchors of ``text`` that reach over the place after its first ``keep`` code points."""
    start = F.greatest(keep - (K - 1), F.lit(0))
    return _in_segment(F.substring(text, start + 1, keep - start + K - 1), start)


def keys_of(found: Column, whole: Column) -> Column:
    """Anchor keys by position; the hash of the whole text where there is none."""
    return _let(found, lambda x: F.when(F.size(x) > 0, x["key"]).otherwise(F.array(whole)))


def fingerprint(keys: Column) -> Column:
    """Eight hex digits an anchor, by position."""
    return F.array_join(F.transform(
        keys, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct anchors of the richer text that the other one has too."""
    return _let(F.array_distinct(a), lambda x: _let(F.array_distinct(b), lambda y: F.size(
        F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y))))


def _place(bounds: list, row: Column) -> Column:
    """How many of the sorted ``bounds`` are not above ``row`` (a two-level search)."""
    if not bounds:
        return F.lit(0)

    def literal(items: list) -> Column:
        return F.from_json(F.lit(json.dumps([{"a": a, "b": b, "c": c} for a, b, c in items])),
                           F.lit("array<struct<a:boolean,b:bigint,c:bigint>>"))

    def not_above(items: Column) -> Column:
        return F.size(F.filter(items, lambda x: x <= row))

    return _let(not_above(literal(bounds[::_STEP])) - 1, lambda block: F.when(block < 0, 0).otherwise(
        block * _STEP + not_above(F.slice(literal(bounds), F.greatest(block, F.lit(0)) * _STEP + 1, _STEP))))


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Documents in buckets of neighbours, descending ``doc_id``, each bucket ended by a guest.

    The guest of a bucket is a copy of the first document of the next one (of
    the first one, for the last), so ``lead`` over the returned window gives every
    document's next one.  One shuffle of the texts; bucket boundaries come from
    sampled ids and decide speed only.
    """
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    # descending ids as an ascending key: null last, complement of the id, hash of the text
    keyed = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.struct(
        doc_id.isNull().alias("a"), F.coalesce(F.bitwise_not(doc_id), F.lit(0)).alias("b"),
        F.xxhash64(text).alias("c")).alias("key"))
    count, size = keyed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = int(min(MAX_BOUNDS, max(1, -(-size // BUCKET_BYTES))))
    bounds = []
    if buckets > 1:
        sample = sorted(tuple(r["key"]) for r in keyed.select("key").sample(
            min(1.0, SAMPLES * buckets / count), 11).collect())
        bounds = sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)} if sample else [])
    keyed = keyed.withColumn("bucket", _place(bounds, F.col("key")).cast("int"))
    # at most one row a bucket
    last = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = keyed.groupBy("bucket").agg(F.min("key").alias("first")).select(
        "bucket", "first", F.coalesce(F.lag("bucket").over(Window.orderBy("bucket")),
                                      F.max("bucket").over(last)).alias("before"))
    placed = keyed.join(F.broadcast(firsts), "bucket").select(
        "doc_id", "text", "key", F.explode(F.when(F.col("key") == F.col("first"), F.array(
            F.struct(F.col("bucket"), F.lit(False).alias("guest")),
            F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guest"))))
            .otherwise(F.array(F.struct(F.col("bucket"), F.lit(False).alias("guest"))))).alias("at"))
    rows = placed.select("doc_id", "text", "key", "at.bucket", "at.guest").repartition(buckets, "bucket")
    return rows, Window.partitionBy("bucket").orderBy("guest", "key")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, and that of its edited text.

    The edited text is the text whose last ``floor(n_chars / 2)`` code points
    are replaced by as many leading ones of the next document (all, if it has
    fewer); documents follow each other by descending ``doc_id``, and after the
    last comes the first.  Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, n_anchors.
    """
    rows, by_id = with_next(docs)
    n, half = F.length("text"), F.floor(F.col("n_chars") / 2).cast("int")
    paired = rows.select("*", n.alias("n_chars"), F.lead("text").over(by_id).alias("next_text")).select(
        "*", (F.col("n_chars") - half).alias("keep"),
        F.least(half, F.length("next_text")).alias("take")).select(
        "*", F.concat(F.substring("text", F.lit(1), F.col("keep")),
                      F.substring("next_text", F.lit(1), F.col("take"))).alias("edited"))
    own = paired.select(
        "doc_id", "key", "bucket", "guest", "n_chars", "keep", "take",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.xxhash64(F.lit("whole"), "text").alias("whole"), F.xxhash64(F.lit("whole"), "edited").alias("whole_edited"),
        anchors(F.col("text")).alias("own"), joint_anchors(F.col("edited"), F.col("keep")).alias("joint"))
    met = own.select("*", F.lead("own").over(by_id).alias("next"), F.lead("whole").over(by_id).alias("whole_next"))
    keys = met.where(~F.col("guest")).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        keys_of(F.col("own"), F.col("whole")).alias("mine"), keys_of(F.col("next"), F.col("whole_next")).alias("next"),
        keys_of(splice(F.col("own"), F.col("keep"), F.col("next"), F.col("take"), F.col("joint")),
                F.col("whole_edited")).alias("edited"))
    return keys.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("mine")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("mine"), F.col("edited")).alias("near_edited"),
        likeness(F.col("mine"), F.col("next")).alias("near_next"),
        F.size("mine").alias("n_anchors"))
