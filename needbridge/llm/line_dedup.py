"""Near-duplicate line removal: exact set-similarity join with DataFrame functions only.

A line is the set of its distinct five-word shingles (a shorter line is one
shingle of all its words).  Shingles are ordered by rarity, from the counts of
all shingles in hash buckets; a line's first ``n - need + 1`` shingles are its
prefix.  Two lines whose Jaccard similarity reaches 0.8 share a prefix shingle,
have sizes that allow it, and share it early enough in both (positional
filter); what is left is verified on the whole sets.  A line is removed when an
earlier line, by (doc_id, line number), matches it.

Equal sets are one entry, so copies never form pairs.  Near copies do not
either: first each line is verified against the earliest line of each of its
prefix shingles, and only lines that stay are compared with all earlier ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from needbridge.llm.common import materialize

WIDTH = 5
NUM, DEN = 80, 100
#: Shingle counts are kept for this many hash buckets; they only order shingles.
BUCKETS = 1 << 14
HASH_BITS = 51
#: Ids of lines to verify are broadcast up to this many (12 bytes each); beyond it, joined by shuffle.
BROADCAST_LINES = 2_000_000
SPACE = " \t\r\n\x0b\x0c"


def with_words(lines: DataFrame) -> DataFrame:
    """``lines`` that hold words, with ``w``: their words, a column of its own to be made once."""
    trimmed = F.btrim("line", F.lit(SPACE))
    return lines.where(trimmed != "").withColumn("w", F.split(F.lower(trimmed), r"\s+"))


def with_hashes(lines: DataFrame) -> DataFrame:
    """``lines`` that hold words, with ``h``: the hashes of their words, a column of its own to be made once."""
    return with_words(lines).withColumn("h", F.transform("w", lambda w: F.xxhash64(w))).drop("w")


def starts(words: str) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(words) - WIDTH, F.lit(0)))


def shingles() -> Column:
    """Hashes of the runs of WIDTH words (of all words, if they are fewer: missing ones add nothing), in text order."""
    return F.transform(starts("h"), lambda i: F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(WIDTH)]))


def exploded_shingles(lines: DataFrame) -> DataFrame:
    """(s): ``shingles`` of all ``lines``, a row each.

    Hashed from the words beside the exploded place, which Spark compiles;
    functions over arrays call their lambda for each element.
    """
    words = [F.get("w", F.col("i") + j) for j in range(WIDTH)]
    return with_words(lines).select("w", F.explode(starts("w")).alias("i")).select(
        F.xxhash64(*[F.when(w.isNotNull(), F.xxhash64(w)) for w in words]).alias("s"))


def rarity(docs: DataFrame) -> Column:
    """Class (the higher, the more common) of each hash bucket of shingles, from the counts of all shingles."""
    bucket = F.pmod(F.col("s"), F.lit(BUCKETS)).cast("int")
    counted = (exploded_shingles(lines_of(docs))
               .groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).collect())
    classes = [0] * BUCKETS
    for r in counted:
        classes[r["bucket"]] = int(16 * math.log2(r["n"]))
    return F.split(F.lit(",".join(map(str, classes))), ",").cast("array<int>")


def with_keys(lines: DataFrame, classes: Column) -> DataFrame:
    """``lines`` that hold words, with ``keys``: their sorted distinct shingle keys, the rarest first.

    A key is the class of the shingle's bucket, then the shingle's hash.
    """
    low = F.lit((1 << HASH_BITS) - 1)

    def key(s: Column) -> Column:
        common = F.coalesce(F.get(classes, F.pmod(s, F.lit(BUCKETS)).cast("int")), F.lit(0))
        return F.shiftleft(common.cast("long"), HASH_BITS).bitwiseOR(s.bitwiseAND(low))

    return with_hashes(lines).withColumn(
        "keys", F.sort_array(F.array_distinct(F.transform(shingles(), key)))).drop("h")


def need(n: Column) -> Column:
    return F.ceil(n * NUM / F.lit(DEN)).cast("int")


def lines_of(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _may_match(x: str, y: str) -> Column:
    xn, yn, xat, yat = F.col(f"{x}n"), F.col(f"{y}n"), F.col(f"{x}at"), F.col(f"{y}at")
    least = F.ceil((xn + yn) * NUM / F.lit(NUM + DEN))
    return ((F.least(xn, yn) * DEN >= F.greatest(xn, yn) * NUM)
            & (F.greatest(xat - xn, yat - yn) + least <= 0))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no) of the lines that match an earlier one.

    ``docs`` has doc_id (unique) and text.  Null ids and texts have no lines;
    lines without words match nothing.  Empty table: no rows.
    """
    classes = rarity(docs)
    n = F.size("keys")
    entries = with_keys(lines_of(docs), classes).select("doc_id", "line_no", "keys").select(
        "doc_id", "line_no", n.alias("n"), F.xxhash64("keys").alias("k1"), F.hash("keys").alias("k2"),
        F.slice("keys", 1, n - need(n) + 1).alias("prefix"))
    # the earliest line of each set: at most one row of a set and task is shuffled
    same = Window.partitionBy("k1", "k2", "n").orderBy("doc_id", "line_no")
    entries = materialize(entries.withColumn("nth", F.row_number().over(same)).where("nth = 1").select(
        "doc_id", "line_no", "n", "prefix"), "entries")
    # sets of up to three shingles have no match but equals
    posts = entries.where("n > 3").select("doc_id", "line_no", "n", F.posexplode("prefix").alias("at", "key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select(F.col("key").alias("k"))
    busy = materialize(posts.join(shared, F.col("key") == F.col("k")).drop("k"), "busy")
    place = F.struct("doc_id", "line_no", "n", "at")
    firsts = busy.groupBy("key").agg(F.min(place).alias("f")).select(
        F.col("key").alias("k"), *[F.col(f"f.{c}").alias(f"f_{c}") for c in ("doc_id", "line_no", "n", "at")])
    busy = materialize(busy.join(firsts, F.col("key") == F.col("k")).drop("k"), "busy-firsts")
    named = busy.where(
        "doc_id <> f_doc_id or line_no <> f_line_no").where(_may_match("", "f_")).select(
        "doc_id", "line_no", F.col("f_doc_id").alias("e_doc"), F.col("f_line_no").alias("e_line")).distinct()
    first_gone = materialize(verified(docs, materialize(named, "named"), classes), "gone")
    x = busy.join(first_gone.select(F.col("doc_id").alias("g"), F.col("line_no").alias("gl")),
                  (F.col("doc_id") == F.col("g")) & (F.col("line_no") == F.col("gl")), "left_anti").where(
        "doc_id <> f_doc_id or line_no <> f_line_no").select("key", "doc_id", "line_no", "n", "at")
    y = busy.select(F.col("key").alias("e_key"), F.col("doc_id").alias("e_doc"), F.col("line_no").alias("e_line"),
                    F.col("n").alias("e_n"), F.col("at").alias("e_at"))
    earlier = (F.col("e_doc") < F.col("doc_id")) | ((F.col("e_doc") == F.col("doc_id")) & (F.col("e_line") < F.col("line_no")))
    left = F.least(F.col("n") - F.col("last"), F.col("e_n") - F.col("e_last")) - 1
    pairs = (x.join(y, (F.col("key") == F.col("e_key")) & earlier & _may_match("", "e_"))
             .groupBy("doc_id", "line_no", "e_doc", "e_line", "n", "e_n")
             .agg(F.count("*").alias("shared"), F.max("at").alias("last"), F.max("e_at").alias("e_last"))
             .where((F.col("shared") + left) * (NUM + DEN) >= (F.col("n") + F.col("e_n")) * NUM)
             .select("doc_id", "line_no", "e_doc", "e_line"))
    later_gone = verified(docs, materialize(pairs, "pairs"), classes)
    stay = entries.join(first_gone.unionByName(later_gone), ["doc_id", "line_no"], "left_anti").select(
        F.col("doc_id").alias("s_doc"), F.col("line_no").alias("s_line"))
    return with_hashes(lines_of(docs)).select("doc_id", "line_no").join(
        stay, (F.col("doc_id") == F.col("s_doc")) & (F.col("line_no") == F.col("s_line")), "left_anti")


def verified(docs: DataFrame, pairs: DataFrame, classes: Column) -> DataFrame:
    """(doc_id, line_no) of the lines that match in one of the ``pairs`` (doc_id, line_no, e_doc, e_line) at least."""
    wanted = pairs.select("doc_id", "line_no").union(pairs.select("e_doc", "e_line")).distinct().select(
        F.col("doc_id").alias("w_doc"), F.col("line_no").alias("w_line"))
    wanted = materialize(wanted, "wanted")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_LINES else wanted
    lines = lines_of(docs).join(
        side, (F.col("doc_id") == F.col("w_doc")) & (F.col("line_no") == F.col("w_line")), "left_semi")
    sets = with_keys(lines, classes).select(
        F.col("doc_id").alias("s_doc"), F.col("line_no").alias("s_line"), "keys")
    mine = sets.withColumnRenamed("keys", "x")
    other = sets.select(F.col("s_doc").alias("o_doc"), F.col("s_line").alias("o_line"), F.col("keys").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(mine, (F.col("doc_id") == F.col("s_doc")) & (F.col("line_no") == F.col("s_line")))
            .join(other, (F.col("e_doc") == F.col("o_doc")) & (F.col("e_line") == F.col("o_line")))
            .where(both * DEN >= (F.size("x") + F.size("y") - both) * NUM)
            .select("doc_id", "line_no").distinct())


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed lines cut from the text, n_chars set anew where there is one.

    A document of which no line with words is left goes; one that had none stays.
    """
    gone = removed_lines(docs).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.sort_array(F.collect_list("line_no")).alias("_gone"))
    lines = F.split("text", "\n")
    left = F.filter(lines, lambda _, i: ~F.array_contains("_gone", i))
    out = docs.join(gone, docs["doc_id"] == gone["_doc"], "left").withColumn(
        "_left", F.when(F.col("_gone").isNotNull(), left)).where(
        "_gone is null or exists(_left, x -> trim(x) <> '')").withColumn(
        "text", F.coalesce(F.array_join("_left", "\n"), F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length("text"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
