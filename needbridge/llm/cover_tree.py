"""Hard negatives by a cover tree over norm-augmented vectors.

Vectors of one block get one more component, ``sqrt(M^2 - |x|^2)`` with M the
block's greatest norm, so all of them lie on one sphere and an inner product
with a query (whose extra component is 0) falls as the angle grows.  A cover
tree halves the covering radius at each level; a node's centre and covering
radius bound the inner product of everything below it.  A search goes best
bound first, skips nodes whose bounds lie outside a query's window or below the
scores it has found, and verifies leaves with exact integer scores.

Blocks of at most about ``BLOCK`` vectors hold near vectors (cells around pivots
that a bounded sample gives; a cell with more rows, however many, is cut by
hash).  The queries are a stated set, the anchors; each chunk of them meets
every tree, by teams of up to ``TEAM`` trees, and carries the scores it found from
tree to tree of a team; a team's trees are joined to all chunks in one task, so
neither side is broadcast.

Defined results: rows without ``vec_id``, label or vector, or with a null or
non-finite component, take no part; rows that share a ``vec_id`` are one item
(least label, then least vector); vectors of other lengths are never compared;
zero vectors and equal vectors take part, ties go to the smaller ``vec_id``; an
empty table gives no rows; other columns are not read.  Products of 2^53 and
more are computed with Python's integers; scores beyond 64 bits count as
the nearest 64-bit number where they are a positive's.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from needbridge.llm.common import materialize

#: Vectors of a block, of a leaf; anchors' blocks of a chunk; trees of a team, least number of teams.
BLOCK, LEAF, CHUNK_BLOCKS, TEAM, TEAMS = 2048, 32, 12, 64, 24
#: Most tasks that build trees.
MAX_TASKS = 20_000
#: Pivots, vectors sampled for them (they decide speed only); query rows scored at once.
PIVOTS, SAMPLE, ROWS = 64, 4096, 512
_EXACT = float(1 << 53)
_SLACK = 1e-9


def quantized(vectors: DataFrame, levels: int = 256) -> DataFrame:
    """(vec_id, label, vector): components become floor(levels * x), x as double."""
    def level(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(levels))
        # doubles from 2^53 on are integers already
        return F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)
    return vectors.select("vec_id", "label", F.transform("embedding", level).alias("vector"))


def items_of(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector): the rows that take part, one for each ``vec_id``."""
    x = F.col("vector")
    good = vectors.where("vec_id is not null and label is not null and vector is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        x.cast("array<double>").alias("vector")).where(
        F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & (F.size("vector") > 0))
    return good.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("item")).select(
        "vec_id", "item.label", "item.vector")


def _stack(column: pa.Array) -> list[np.ndarray]:
    """A list column's rows as float arrays."""
    flat = np.asarray(column.flatten(), np.float64)
    ends = np.cumsum(np.asarray(pc.list_value_length(column)))
    return np.split(flat, ends[:-1]) if len(ends) else []


# --- blocks ------------------------------------------------------------------

def _pivots(items: DataFrame) -> dict[int, np.ndarray]:
    """Unit pivots by vector length, spread over a bounded sample."""
    count = items.count()
    rows = items.select("vector").sample(min(1.0, 1.2 * SAMPLE / max(count, 1)), 5).limit(SAMPLE).collect()
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r[0]), []).append(r[0])
    out = {}
    for size, some in by_size.items():
        x = _unit(np.array(some, np.float64))
        chosen, near = [0], x @ x[0]
        while len(chosen) < min(PIVOTS, len(x), 1 + len(x) * count // (len(rows) * BLOCK)):
            chosen.append(int(near.argmin()))
            near = np.maximum(near, x @ x[chosen[-1]])
        out[size] = x[chosen]
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def blocks_of(items: DataFrame) -> tuple[DataFrame, int]:
    """``items`` with ``size`` (vector length) and ``block``, and the number of blocks.

    Near vectors share blocks of about ``BLOCK``.
    """
    pivots = _pivots(items)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _stack(batch.column("vector"))
            size = np.array([len(r) for r in rows], np.int32)
            cell = np.zeros(len(rows), np.int32)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                if n in pivots:
                    cell[at] = (_unit(np.stack([rows[i] for i in at])) @ pivots[n].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size), pa.array(cell)],
                                             names=[*batch.schema.names, "size", "cell"])

    celled = materialize(items.mapInArrow(cells, "vec_id long, label long, vector array<double>, size int, cell int"),
                         "cells")
    # one row for each length and cell
    parts = celled.groupBy("size", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    first = F.coalesce(F.sum("parts").over(Window.partitionBy("size").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    placed = celled.join(F.broadcast(parts.withColumn("first", first)), ["size", "cell"]).select(
        "vec_id", "label", "vector", "size",
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int").alias("block"))
    return placed, parts.agg(F.sum("parts")).first()[0] or 0


# --- trees -------------------------------------------------------------------

def build_tree(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> dict:
    """Cover tree as arrays: items in node order; per node its centre, radius, own items and children."""
    norm = np.sqrt((x * x).sum(axis=1))
    top = float(norm.max())
    scale = top or 1.0
    unit = np.concatenate([x / scale, np.sqrt(np.maximum(0.0, 1 - (norm / scale) ** 2))[:, None]], axis=1)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (unit @ unit.T)))
    order, centre, radius, own, kids = [], [], [], [], []
    # (centre, other members, their distances to it, whether it is an item of this node, parent)
    rows = np.arange(1, len(x))
    stack = [(0, rows, apart[0, rows], True, -1)]
    while stack:
        c, rows, far, new, parent = stack.pop()
        node = len(centre)
        reach = float(far.max()) if len(rows) else 0.0
        centre.append(c)
        radius.append(reach)
        kids.append([])
        if parent >= 0:
            kids[parent].append(node)
        begin = len(order)
        if new:
            order.append(c)
        if len(rows) <= LEAF or reach < 1e-7:
            order.extend(rows.tolist())
        else:
            # the centre's own child at half the radius, then a net of the rest; lone points are own items
            inner = far <= reach / 2
            parts = [(c, rows[inner], far[inner], False)] if inner.any() else []
            rest = rows[~inner]
            while len(rest):
                d = apart[rest[0], rest]
                inner = d <= reach / 2
                inner[0] = False
                if inner.any():
                    parts.append((int(rest[0]), rest[inner], d[inner], True))
                else:
                    order.append(int(rest[0]))
                keep = ~inner
                keep[0] = False
                rest = rest[keep]
            stack += [(*part, node) for part in parts]
        own.append((begin, len(order)))
    return {"ids": ids[order], "labels": labels[order], "x": x[order], "unit": unit[centre], "radius": np.array(radius),
            "own": own, "kids": [np.array(k, np.int64) for k in kids], "top": top}


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by size and block; one block is held at a time."""
    key, ids, labels, rows = None, [], [], []

    def tree() -> pa.RecordBatch:
        order = np.argsort(np.array(ids))
        made = build_tree(np.array(ids, np.int64)[order], np.array(labels, np.int64)[order], np.stack(rows)[order])
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                           pa.array([pickle.dumps(made, 5)], pa.binary())], names=["size", "block", "tree"])

    for batch in batches:
        for i, label, x, size, block in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(),
                                            _stack(batch.column("vector")), batch.column("size").to_pylist(),
                                            batch.column("block").to_pylist()):
            if (size, block) != key:
                if ids:
                    yield tree()
                key, ids, labels, rows = (size, block), [], [], []
            ids.append(i)
            labels.append(label)
            rows.append(x)
    if ids:
        yield tree()


# --- search ------------------------------------------------------------------

def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)))
    bound = np.sqrt((a * a).sum(axis=1).max()) * np.sqrt((b * b).sum(axis=1).max())
    if bound < _EXACT / 2:
        return a @ b.T
    def whole(m):
        return np.array([[int(v) for v in r] for r in m], object)
    return whole(a) @ whole(b).T


class Found:
    """The best ``k`` (score, id) of each query row so far, score descending, id ascending."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.best: list[list[tuple]] = [[] for _ in range(rows)]
        self.least = np.full(rows, -np.inf)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        """``scores``: query rows x items; ``fits`` says which count."""
        fits = fits & (scores >= self.least[rows][:, None])
        fits = fits.astype(bool)
        many = np.flatnonzero(fits.sum(axis=1) > 4 * self.k)
        if len(many):
            # keep what reaches the k-th best score of the row, ties included
            some = np.where(fits[many], scores[many].astype(np.float64), -np.inf)
            kth = -np.partition(-some, self.k - 1, axis=1)[:, self.k - 1]
            fits[many] &= some >= kth[:, None] - np.abs(kth[:, None]) * 1e-12
        for r in np.flatnonzero(fits.any(axis=1)).tolist():
            at = np.flatnonzero(fits[r])
            row = int(rows[r])
            got = self.best[row] + [(-int(s), int(i)) for s, i in zip(scores[r, at], ids[at])]
            got.sort()
            self.best[row] = got = got[:self.k]
            if len(got) == self.k:
                least = float(-got[-1][0])
                self.least[row] = least if abs(least) < _EXACT else np.nextafter(least, -np.inf)


def search(tree: dict, q: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray,
           counts: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], found: Found) -> int:
    """Best-first descent for all query rows at once; the number of scores computed.

    Row r asks for scores of vector ``q[anchor[r]]`` from ``low[r]`` to
    ``high[r]``; ``counts(rows, ids, labels)`` says which items may answer.
    """
    reach = np.sqrt((q * q).sum(axis=1))[anchor] * tree["top"]
    slack = _SLACK * (reach + 1)
    work = 0

    def bounds(rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score below each node (rows x nodes)."""
        uniq, back = np.unique(anchor[rows], return_inverse=True)
        length = np.sqrt((q[uniq] ** 2).sum(axis=1))
        unit = q[uniq] / np.where(length > 0, length, 1.0)[:, None]
        cos = np.clip(unit @ tree["unit"][nodes][:, :-1].T, -1.0, 1.0)
        angle = np.arccos(cos)[back]
        # points within a chord r of a centre lie within this angle of it
        cap = 2 * np.arcsin(np.clip(tree["radius"][nodes] / 2, 0.0, 1.0)) + 1e-7
        scale = reach[rows][:, None]
        upper = np.cos(np.maximum(angle - cap, 0.0)) * scale + slack[rows][:, None]
        lower = np.cos(np.minimum(angle + cap, np.pi)) * scale - slack[rows][:, None]
        return lower, upper

    everyone = np.arange(len(anchor))
    lower, upper = bounds(everyone, np.zeros(1, np.int64))
    heap = [(-float(upper.max()), 0, everyone, lower[:, 0], upper[:, 0])] if len(anchor) else []
    while heap:
        _, node, rows, lower, upper = heapq.heappop(heap)
        open_ = (upper >= np.maximum(low[rows], found.least[rows])) & (lower <= high[rows])
        rows = rows[open_]
        if not len(rows):
            continue
        begin, end = tree["own"][node]
        ids, labels, x = tree["ids"][begin:end], tree["labels"][begin:end], tree["x"][begin:end]
        for part in np.split(rows, range(ROWS, len(rows), ROWS)):
            uniq, back = np.unique(anchor[part], return_inverse=True)
            scores = _scores(q[uniq], x)[back]
            work += len(uniq) * len(x)
            fits = (scores >= low[part][:, None]) & (scores <= high[part][:, None])
            found.add(part, scores, ids, fits & counts(part, ids, labels))
        kids = tree["kids"][node]
        for some in np.split(kids, range(256, len(kids), 256)) if len(kids) else ():
            lower, upper = bounds(rows, some)
            work += len(rows) * len(some)
            open_ = (upper >= np.maximum(low[rows], found.least[rows])[:, None]) & (lower <= high[rows][:, None])
            for j in np.flatnonzero(open_.any(axis=0)).tolist():
                at = np.flatnonzero(open_[:, j])
                heapq.heappush(heap, (-float(upper[at, j].max()), int(some[j]), rows[at], lower[at, j], upper[at, j]))
    return work


_LONG = (1 << 63) - 1


def _long(x: int) -> int:
    return max(-_LONG - 1, min(_LONG, x))


def _descend(same_label: bool, k: int, low_percent: int = 0, high_percent: int = 0) -> Callable:
    """Search of (anchors, tree) rows: best ``k`` per anchor, or per anchor and positive, of each run of a chunk."""
    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = None

        def results() -> pa.RecordBatch:
            rows = [(*name, -s, i) for name, best in zip(names, found.best) for s, i in best]
            return pa.RecordBatch.from_arrays(
                [pa.array([_long(r[c]) if c == 3 else r[c] for r in rows], pa.int64()) for c in range(5)],
                names=["anchor_id", "positive_id", "positive_score", "score", "id"])

        for batch in batches:
            keys = zip(batch.column("size").to_pylist(), batch.column("team").to_pylist(), batch.column("chunk").to_pylist())
            for at, key in enumerate(keys):
                if key != chunk:
                    if chunk is not None:
                        yield results()
                    chunk = key
                    anchors = batch.column("anchors")[at].values
                    ids = np.asarray(anchors.field("vec_id"))
                    labels = np.asarray(anchors.field("label"))
                    q = np.asarray(anchors.field("vector").flatten(), np.float64).reshape(len(ids), -1)
                    if same_label:
                        names = [(i, None, None) for i in ids.tolist()]
                        anchor = np.arange(len(ids))
                        low, high = np.full(len(ids), -np.inf), np.full(len(ids), np.inf)
                    else:
                        asked = [(a, r["positive_id"], r["score"]) for a, rows in enumerate(
                            anchors.field("positives").to_pylist()) for r in rows]
                        names = [(int(ids[a]), p, s) for a, p, s in asked]
                        anchor = np.array([a for a, _, _ in asked], np.int64)
                        low = np.array([-(-low_percent * s // 100) for _, _, s in asked], object)
                        high = np.array([high_percent * s // 100 for _, _, s in asked], object)
                        if all(abs(s) < 1 << 52 for _, _, s in asked):
                            low, high = low.astype(np.float64), high.astype(np.float64)
                    found = Found(len(names), k)

                    def counts(rows, of, label, ids=ids, labels=labels, anchor=anchor):
                        a = anchor[rows]
                        if same_label:
                            return (labels[a][:, None] == label) & (ids[a][:, None] != of)
                        return labels[a][:, None] != label
                search(pickle.loads(batch.column("tree")[at].as_py()), q, anchor, low, high, counts, found)
        if chunk is not None:
            yield results()

    return descend


_FOUND = "anchor_id long, positive_id long, positive_score long, score long, id long"


def _meet(anchors: DataFrame, trees: DataFrame, teams: int) -> DataFrame:
    """Every chunk of anchors with every tree of its vector length.

    A merge join streams the chunks of a team's task past the team's trees, so
    the pairs of a chunk come one after the other and are never shuffled.
    """
    spread = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(teams - 1))).alias("team")).repartition(
        teams, "size", "team")
    return spread.join(trees.repartition(teams, "size", "team").hint("merge"), ["size", "team"]).select(
        "size", "team", "chunk", "anchors", "tree")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
         low_percent: int = 50, high_percent: int = 95) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, label, vector of integer-valued numbers.  An anchor's
    positives are its ``positives`` other rows of the same label with the highest
    scores (inner products); for each, the first ``negatives`` rows of other labels whose
    score is between ``low_percent`` and ``high_percent`` of the positive's.
    """
    placed, count = blocks_of(items_of(vectors))
    placed = materialize(placed, "placed")
    teams = max(TEAMS, -(-count // TEAM))
    trees = materialize(
        placed.repartition(min(MAX_TASKS, max(1, count)), "size", "block").sortWithinPartitions("size", "block").mapInArrow(
            _trees, "size int, block int, tree binary").withColumn("team", F.pmod("block", F.lit(teams))), "trees")
    chosen = placed.where(is_anchor).withColumn("chunk", F.floor(F.col("block") / CHUNK_BLOCKS).cast("int"))
    first = chosen.groupBy("size", "chunk").agg(F.collect_list(F.struct("vec_id", "label", "vector")).alias("anchors"))

    def best(anchors: DataFrame, keys: list[str], k: int, *how) -> DataFrame:
        rows = _meet(anchors, trees, teams).mapInArrow(_descend(*how), _FOUND)
        return rows.withColumn("rank", F.row_number().over(
            Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)

    near = materialize(best(first, ["anchor_id"], positives, True, positives).select(
        "anchor_id", F.col("id").alias("positive_id"), "score"), "positives")
    # a window without a number in it has no negatives
    ask = near.where(-F.floor(-F.col("score").cast("decimal(38,0)") * low_percent / 100)
                     <= F.floor(F.col("score").cast("decimal(38,0)") * high_percent / 100)).groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "score")).alias("positives"))
    second = chosen.join(ask, chosen["vec_id"] == ask["anchor_id"]).groupBy("size", "chunk").agg(
        F.collect_list(F.struct("vec_id", "label", "vector", "positives")).alias("anchors"))
    return best(second, ["anchor_id", "positive_id"], negatives, False, negatives, low_percent, high_percent).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
