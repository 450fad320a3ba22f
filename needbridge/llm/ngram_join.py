"""Exact n-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its distinct four-word shingles (64-bit keys).  Two
documents link when their Jaccard similarity is at least ``num / den``.  For a
set of n shingles in a fixed global order (rare first), a linked partner shares
at least m of its first ``n - need + m`` shingles, ``need = ceil(n * num / den)``,
for every m.  Each document picks its own m: it starts at 1 and is raised, with
the prefix, while the expected candidates (from how common the prefix shingles
are) make a longer prefix that asks for more shared shingles cheaper.  A pair
is verified if it shares as many shingles as a linked pair of these sizes must
share within both prefixes: min(m, m') at least, and more the closer the sizes.

Copies (equal sets) become one class first.  Groups of near copies are never
expanded into all pairs: in ``ANCHOR_ROUNDS`` rounds, all at once, each class is verified
against the class that most of its prefix shingles name as their anchor (one
check per class and round at most).  Then only candidates of different components are
verified, all of them; a prefix shingle whose classes are in one component
already brings none.  So components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from needbridge.llm import textkeys as tk
from needbridge.llm.common import components, materialize

WIDTH = 4
NUM, DEN = 85, 100
ANCHOR_ROUNDS = 4
MAX_MATCHES = 4
#: What verifying a pair costs beside meeting it at a shared shingle, for the choice of m.
CHECK_COST = 8
#: How many of the most common shingles are told apart by how common they are; only the order
#: of shingles and the choice of m hang on it, never which pairs are found.
COMMON_SHINGLES = 20_000
#: A batch passes on the shingles that it has at least so often.
MIN_IN_BATCH = 4
#: Classes that one verification task holds beside an anchor.
MEMBERS_PER_GROUP = 64
#: Ids whose texts are wanted are broadcast up to this many (8 bytes each); beyond it, joined by shuffle.
BROADCAST_IDS = 2_000_000


def shingles_of(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct keys; bytes.lower() and bytes.split() change A-Z and split at ASCII white space only."""
    return tk.shingle_set(tk.word_hashes((text or "").encode().lower().split()), width)


def repeated(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of those that occur at least so often; ``keys`` is sorted in place, so that it is not copied."""
    keys.sort()
    upto = max(0, len(keys) - least + 1)
    many = np.unique(keys[:upto][keys[least - 1:] == keys[:upto]])
    return many, np.searchsorted(keys, many, "right") - np.searchsorted(keys, many, "left")


def common_shingles(docs: DataFrame, width: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, counts) of the most common shingles.

    Each Arrow batch counts all its shingles, repeats in a document too, and
    passes on those it has MIN_IN_BATCH times or more, so a sum lacks less than
    that for each batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = repeated(np.concatenate([
                tk.windows(tk.word_hashes((t.as_py() or "").encode().lower().split()), width)
                for t in batch.column(0)] or [tk.EMPTY]), MIN_IN_BATCH)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["k", "n"])

    top = (docs.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "k").limit(keep).toPandas())
    keys = top["k"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], top["n"].to_numpy(np.int64)[order]


def need(n: int, num: int, den: int) -> int:
    return -(-n * num // den)


def adaptive_prefix(keys: np.ndarray, common: tuple[np.ndarray, np.ndarray], num: int, den: int
                    ) -> tuple[np.ndarray, int]:
    """(prefix shingles in global order, chosen m) of a sorted set."""
    n = len(keys)
    short = n - need(n, num, den)  # shingles a partner may lack
    most = short + min(MAX_MATCHES, n - short)
    known = np.zeros(n, bool)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], keys), len(common[0]) - 1)
        known = common[0][at] == keys
    order, count = keys[~known][:most], np.zeros(most, np.int64)
    if len(order) < most:
        late, late_n = keys[known], common[1][at[known]]
        by = np.lexsort((late, late_n))[:most - len(order)]
        count[len(order):] = late_n[by]
        order = np.concatenate([order, late[by]])
    best, chosen = None, 1
    for m in range(1, most - short + 1):
        partners = float(count[:short + m].sum())
        cost = partners + CHECK_COST * partners / m ** 2  # entries met, then candidates to verify
        if best is None or cost < best * 0.8:
            best, chosen = cost, m
    return order[:short + chosen], chosen


def signatures(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, 128-bit key of its set, chosen m and prefix."""
    keys, counts = common_shingles(docs, width, COMMON_SHINGLES)
    shared = docs.sparkSession.sparkContext.broadcast((keys, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = shingles_of(text.as_py(), width)
                prefix, m = adaptive_prefix(own, common, num, den) if len(own) else (tk.EMPTY, 0)
                for col, v in zip(cols, (doc_id, len(own), xxhash.xxh3_128_digest(own.tobytes()), m,
                                         prefix.view(np.int64))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "m", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, m int, prefix array<long>")


def packed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, packed): compressed texts of the documents whose id ``wanted`` (w) holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [pack((t.as_py() or "").encode()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "packed"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    if wanted.count() <= BROADCAST_IDS:
        return texts.join(F.broadcast(wanted), F.col("id") == F.col("w"), "left_semi").mapInArrow(
            run, "id long, packed binary")
    return texts.mapInArrow(run, "id long, packed binary").join(wanted, F.col("id") == F.col("w"), "left_semi")


def _unpacked(packed: bytes, width: int) -> np.ndarray:
    return shingles_of(zstandard.ZstdDecompressor().decompress(packed).decode(), width)


def verify(pairs: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The ``pairs`` (a, b) whose documents link.

    The partners of a are dealt out in groups of at most MEMBERS_PER_GROUP, and
    a's text goes to each group, so a hot a is split over many tasks.
    """
    wanted = materialize(pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct(), "wanted")
    texts = packed_texts(docs, wanted)
    numbered = pairs.select(
        "a", "b", F.pmod(F.xxhash64("b"), F.lit(1 << 30)).alias("h")).join(
        pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_GROUP).alias("parts")).select(
            F.col("a").alias("pa"), "parts"), F.col("a") == F.col("pa")).select(
        "a", "b", F.pmod("h", "parts").cast("int").alias("part"))
    members = numbered.select(
        F.col("b").alias("wanted"), "a", "part", F.lit(False).alias("anchor"))
    anchors = numbered.select("a", "part").distinct().select(
        F.col("a").alias("wanted"), "a", "part", F.lit(True).alias("anchor"))
    rows = members.unionByName(anchors).join(texts, F.col("wanted") == texts["id"]).select(
        "a", "part", "anchor", F.col("wanted").alias("b"), "packed")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = rows.repartition(n, "a", "part").sortWithinPartitions("a", "part", F.desc("anchor"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = tk.EMPTY  # each group's anchor comes first
        for batch in batches:
            linked: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3)]
            for a, anchor, b, packed in zip(*columns, batch.column(4)):
                own = _unpacked(packed.as_py(), width)
                if anchor:
                    mine = own
                    continue
                both = tk.overlap(mine, own)
                if both and den * both >= num * (len(mine) + len(own) - both):
                    linked.append((a, b))
            cols = list(zip(*linked)) or [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b"])

    return grouped.mapInArrow(run, "a long, b long")


def _asked(num: int, den: int, x: str, y: str) -> Column:
    """How many prefix shingles a linked pair shares at least.

    ``x`` and ``y`` prefix the columns n (size) and m.  A link needs
    ``ceil((n + n') * num / (num + den))`` shared shingles, more than each
    prefix was made for, so the same prefixes ask for more than m matches.
    """
    def spare(t: str) -> Column:
        return F.col(f"{t}m") - F.ceil(F.col(f"{t}n") * num / F.lit(den))

    return F.ceil((F.col(f"{x}n") + F.col(f"{y}n")) * num / F.lit(num + den)) + F.least(spare(x), spare(y))


def _may_link(num: int, den: int, x: str, y: str) -> Column:
    """Sizes allow a link, and the shingle both have (at place ``at``) is early enough to be among those asked for."""
    xn, yn = F.col(f"{x}n"), F.col(f"{y}n")
    least = F.ceil((xn + yn) * num / F.lit(num + den))
    late = F.greatest(F.col(f"{x}at") - xn, F.col(f"{y}at") - yn) + least
    return (F.least(xn, yn) * den >= F.greatest(xn, yn) * num) & (late <= _asked(num, den, x, y) - 1)


def anchor_pairs(posts: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b): each class b with the anchor a that most of its shingles name, for each round."""
    # the anchors of a shingle: the classes that seeded hashes put first
    ranks = [F.struct(F.xxhash64("id", F.lit(seed)).alias("h"), "id", "n", "at", "m") for seed in range(ANCHOR_ROUNDS)]
    firsts = posts.groupBy("key").agg(*[F.min(r).alias(f"f{i}") for i, r in enumerate(ranks)]).select(
        F.col("key").alias("k"), F.array(*[f"f{i}" for i in range(ANCHOR_ROUNDS)]).alias("firsts"))
    named = (posts.join(firsts, F.col("key") == F.col("k"))
             .select("id", "n", "at", "m", F.posexplode("firsts").alias("seed", "f")).where("id <> f.id")
             .select("id", "n", "at", "m", "seed", *[F.col(f"f.{c}").alias(f"f_{c}") for c in ("id", "n", "at", "m")])
             .where(_may_link(num, den, "", "f_"))
             .groupBy("id", "seed", "f_id")
             .agg(F.count("*").alias("shared"), F.first(_asked(num, den, "", "f_")).alias("asked"))
             .where("shared >= asked"))
    return named.groupBy("id", "seed").agg(F.max_by("f_id", F.struct("shared", "f_id")).alias("a")).select(
        "a", F.col("id").alias("b")).distinct()


def class_links(sigs: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(classes (set_key, id), components (node, component) of the class ids that have links)."""
    # copies: the smallest doc_id stands for its class
    classes = materialize(sigs.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("id")), "classes")
    posts = sigs.join(classes.select("id"), F.col("doc_id") == F.col("id"), "left_semi").select(
        F.col("doc_id").alias("id"), F.col("n_shingles").cast("int").alias("n"), "m",
        F.posexplode("prefix").alias("at", "key"))
    busy = posts.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select(F.col("key").alias("k"))
    posts = materialize(posts.join(busy, F.col("key") == F.col("k")).drop("k"), "posts")
    links = posts.sparkSession.createDataFrame([], "a long, b long")
    if ANCHOR_ROUNDS:
        links = materialize(
            verify(materialize(anchor_pairs(posts, num, den), "anchors"), docs, width, num, den), "links")
    comp = components(links, "anchor-components")
    # what is left: classes that share prefix shingles over different components
    cols = ("id", "n", "m", "at", "comp")
    tagged = posts.join(comp, F.col("id") == F.col("node"), "left").select(
        "key", "id", "n", "m", "at", F.coalesce("component", "id").alias("comp"))
    mixed = tagged.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select(F.col("key").alias("k"))
    open_posts = materialize(tagged.join(mixed, F.col("key") == F.col("k")).drop("k"), "open")
    left = open_posts.select("key", *[F.col(c).alias(f"x_{c}") for c in cols])
    right = open_posts.select(F.col("key").alias("k"), *[F.col(c).alias(f"y_{c}") for c in cols])
    asked = _asked(num, den, "x_", "y_")
    pairs = (left.join(right, (F.col("key") == F.col("k")) & (F.col("x_comp") < F.col("y_comp"))
                       & _may_link(num, den, "x_", "y_"))
             .groupBy(F.col("x_id").alias("a"), F.col("y_id").alias("b"))
             .agg(F.count("*").alias("shared"), F.first(asked).alias("asked"))
             .where("shared >= asked").select("a", "b"))
    links = links.unionByName(materialize(verify(materialize(pairs, "pairs"), docs, width, num, den), "links"))
    return classes, components(links, "components")


def link_documents(docs: DataFrame, width: int = WIDTH, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id.

    ``docs`` has doc_id and text.  Null texts and those without words have
    n_shingles 0, link with nothing and are their own component.  Repeated
    texts share a class (class_id: its smallest doc_id).  ``doc_id`` must be
    unique; a null one stands for no document and is dropped.  Empty table: no
    rows.
    """
    docs = docs.where(F.col("doc_id").isNotNull())
    sigs = materialize(signatures(docs, width, num, den), "signatures")
    classes, comp = class_links(sigs, docs, width, num, den)
    placed = classes.join(comp, F.col("id") == F.col("node"), "left").select(
        F.col("set_key").alias("sk"), "id", F.coalesce("component", "id").alias("component"))
    return sigs.select("doc_id", "n_shingles", "set_key").join(
        placed, (F.col("set_key") == F.col("sk")) & (F.col("n_shingles") > 0), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("id", "doc_id").alias("class_id"))


def drop_near_copies(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each group kept: that of the smallest doc_id."""
    out = link_documents(docs, width, num, den)
    gone = out.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
