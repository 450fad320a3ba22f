"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2 t) of each other, and
so do their projections on any orthonormal directions.  Vectors of a label are
sorted by their grid cells (side eps) on the leading principal directions and
cut into sequence intervals (blocks) of bounded size.  Interval pairs whose
bounding boxes are farther apart than eps are skipped; the others are joined
recursively, halving the longer interval and skipping distant halves, down to
small pieces whose cosines are computed in double precision.

The directions come from a bounded sample and affect speed only.  Equal
vectors are one entry with a count.  A block pair returns link counts and a
spanning forest of its links, so groups of near copies make no pair rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.llm.common import components, materialize

COSINE = 0.98
#: Leading directions of the grid; cells of the first two pair up blocks.
DIRECTIONS = 8
#: Vectors of a block, of a piece whose cosines are computed at once, and of the sample for the directions.
BLOCK, LEAF, SAMPLE = 512, 64, 20_000
_SLACK = 1e-9


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding as doubles) of the rows that can link."""
    e = F.col("embedding")
    return vectors.where("vec_id is not null and label is not null and embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", e.cast("array<double>").alias("embedding")).where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("embedding", lambda x: x != 0))


def directions(vectors: DataFrame, n: int = SAMPLE) -> dict[int, np.ndarray]:
    """Principal directions by vector length, from at most ``n`` vectors."""
    total = vectors.count()
    some = vectors.select("embedding").sample(False, min(1.0, 1.2 * n / max(total, 1)), 7).limit(n).toPandas()["embedding"]
    by_dim: dict[int, list] = {}
    for v in some:
        v = np.asarray(v, np.float64)
        by_dim.setdefault(len(v), []).append(v / np.abs(v).max())
    out = {}
    for dim, rows in by_dim.items():
        x = np.stack(rows)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        out[dim] = np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:DIRECTIONS]
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _project(x: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    z = np.zeros((len(x), DIRECTIONS))
    if axes is not None:
        z[:, :len(axes)] = x @ axes.T
    return z


def blocks(classes: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """Sequence intervals in epsilon grid order: (block, grp, dim, lo, hi, ids, copies, data)."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(axes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in batch.column(3).to_pylist():
                x = _unit(np.frombuffer(raw, np.float64)[None])
                out.append(np.floor(_project(x, shared.value.get(x.shape[1])) / eps)[0].astype(np.int32).tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "cell"])

    celled = classes.select("grp", "id", "copies", "raw").mapInArrow(
        cells, "grp string, id long, copies long, raw binary, cell array<int>")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = materialize(celled, "cells").repartitionByRange(n, "grp", "cell", "id").sortWithinPartitions("grp", "cell", "id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(grp: str, held: list[tuple]) -> pa.RecordBatch:
            ids, copies, raws = zip(*held)
            x = np.stack([np.frombuffer(r, np.float64) for r in raws])
            z = _project(_unit(x), shared.value.get(x.shape[1]))
            return pa.RecordBatch.from_arrays(
                [pa.array([grp]), pa.array([ids[0]], pa.int64()), pa.array([z.min(0).tolist()], pa.list_(pa.float64())),
                 pa.array([z.max(0).tolist()], pa.list_(pa.float64())), pa.array([list(ids)], pa.list_(pa.int64())),
                 pa.array([list(copies)], pa.list_(pa.int64())), pa.array([b"".join(raws)], pa.binary())],
                names=["grp", "block", "lo", "hi", "ids", "copies", "data"])

        grp, held = None, []
        for batch in batches:
            for g, i, c, raw in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if held and (g != grp or len(held) == BLOCK):
                    yield packed(grp, held)
                    held = []
                grp = g
                held.append((i, c, raw))
        if held:
            yield packed(grp, held)

    return ordered.mapInArrow(
        cut, "grp string, block long, lo array<double>, hi array<double>, ids array<long>, copies array<long>, data binary")


def _near(z1: np.ndarray, z2: np.ndarray, eps: float) -> bool:
    gap = np.maximum(0, np.maximum(z1.min(0) - z2.max(0), z2.min(0) - z1.max(0)))
    return bool((gap ** 2).sum() <= eps * eps + _SLACK)


def join_intervals(x: np.ndarray, z: np.ndarray, y: np.ndarray, w: np.ndarray, eps: float, cosine: float) -> np.ndarray:
    """Link matrix of two intervals (unit vectors x, y; projections z, w), joined recursively."""
    links = np.zeros((len(x), len(y)), bool)
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if not _near(z[a:b], w[c:d], eps):
            continue
        if max(b - a, d - c) <= LEAF:
            links[a:b, c:d] = x[a:b] @ y[c:d].T >= cosine
        elif b - a >= d - c:
            todo += [(a, (a + b) // 2, c, d), ((a + b) // 2, b, c, d)]
        else:
            todo += [(a, b, c, (c + d) // 2), (a, b, (c + d) // 2, d)]
    return links


def _forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what ``links`` connects: each node with the least node of its component."""
    a, b = left.copy(), right.copy()
    some = links.any(1)
    big = np.iinfo(np.int64).max
    while some.any():
        na = np.minimum(a, np.where(links, b[None, :], big).min(1))
        nb = np.minimum(b, np.where(links, na[:, None], big).min(0))
        if (na == a).all() and (nb == b).all():
            break
        a, b = na, nb
    return [(int(i), int(j)) for i, j in [*zip(left, a), *zip(right, b)] if i != j]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``vectors`` has vec_id, embedding and label.  Only vectors of one label (not
    null) and one length are compared.  Null, empty and zero vectors and those
    with null or non-finite components link with nothing and are kept.
    Repeated rows are vectors each.  A row without vec_id is dropped.  Empty
    table: no rows.
    """
    spark = vectors.sparkSession
    eps = float(np.sqrt(2 - 2 * cosine) + 1e-7)
    good = usable(vectors)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [np.asarray(v, np.float64).tobytes() for v in batch.column(2).to_pylist()]
            grp = [f"{label}/{len(r) // 8}" for label, r in zip(batch.column(1).to_pylist(), raws)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(grp), pa.array([xxhash.xxh3_128_digest(r) for r in raws], pa.binary()),
                 pa.array(raws, pa.binary())], names=["vec_id", "grp", "key", "raw"])

    rows = materialize(good.mapInArrow(keyed, "vec_id long, grp string, key binary, raw binary"), "vectors")
    classes = materialize(rows.groupBy("grp", "key").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("raw").alias("raw")), "classes")
    parts = materialize(blocks(classes, directions(good), eps), "blocks")
    side = F.lit(eps)

    def tiles(spread: int) -> DataFrame:
        def span(k: int) -> F.Column:
            return F.sequence(F.floor(F.get("lo", k) / side) - spread, F.floor(F.get("hi", k) / side) + spread)

        return parts.select("grp", "block", "lo", "hi", F.explode(span(0)).alias("c0")).select(
            "grp", "block", "lo", "hi", "c0", F.explode(span(1)).alias("c1"))

    x = tiles(0)
    y = tiles(1).select(*[F.col(c).alias(f"y_{c}") for c in ("grp", "block", "lo", "hi", "c0", "c1")])
    gap = F.aggregate(
        F.sequence(F.lit(0), F.lit(DIRECTIONS - 1)), F.lit(0.0),
        lambda acc, k: acc + F.pow(F.greatest(F.lit(0.0), F.get("lo", k) - F.get("y_hi", k), F.get("y_lo", k) - F.get("hi", k)), 2))
    pairs = x.join(y, (F.col("grp") == F.col("y_grp")) & (F.col("c0") == F.col("y_c0")) & (F.col("c1") == F.col("y_c1"))
                   & (F.col("block") <= F.col("y_block"))).where(gap <= eps * eps + _SLACK).select(
        "grp", F.col("block").alias("x_block"), "y_block").distinct()
    body = ("ids", "copies", "data")
    left = parts.select(F.col("grp").alias("lg"), F.col("block").alias("lb"), *[F.col(c).alias(f"l_{c}") for c in body])
    right = parts.select(F.col("grp").alias("rg"), F.col("block").alias("rb"), *[F.col(c).alias(f"r_{c}") for c in body])
    work = (materialize(pairs, "block-pairs")
            .join(left, (F.col("grp") == F.col("lg")) & (F.col("x_block") == F.col("lb")))
            .join(right, (F.col("grp") == F.col("rg")) & (F.col("y_block") == F.col("rb")))
            .select("x_block", "y_block", *[f"{s}_{c}" for s in "lr" for c in body]))
    shared = spark.sparkContext.broadcast(directions(good))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out: list[tuple] = []
                ids = [np.asarray(row[f"{s}_ids"], np.int64) for s in "lr"]
                copies = [np.asarray(row[f"{s}_copies"], np.int64) for s in "lr"]
                x, y = (_unit(np.frombuffer(row[f"{s}_data"], np.float64).reshape(len(i), -1)) for s, i in zip("lr", ids))
                z, w = (_project(v, shared.value.get(v.shape[1])) for v in (x, y))
                links = join_intervals(x, z, y, w, eps, cosine)
                same = row["x_block"] == row["y_block"]
                if same:
                    np.fill_diagonal(links, False)
                n = links @ copies[1]
                out += [(int(i), None, int(k)) for i, k in zip(ids[0], n) if k]
                if not same:
                    out += [(int(i), None, int(k)) for i, k in zip(ids[1], links.T @ copies[0]) if k]
                out += [(i, j, 0) for i, j in _forest(links, *ids)]
                cols = list(zip(*out)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "n"])

    found = materialize(work.repartition("x_block", "y_block").mapInArrow(link, "a long, b long, n long"), "found")
    comp = components(found.where("b is not null").select("a", "b"), "components")
    counts = found.where("b is null").groupBy(F.col("a").alias("c_id")).agg(F.sum("n").alias("others"))
    of_class = classes.select("grp", "key", "id", "copies").join(comp, F.col("id") == F.col("node"), "left").join(
        counts, F.col("id") == F.col("c_id"), "left").select(
        F.col("grp").alias("g"), F.col("key").alias("k"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    linked = rows.select("vec_id", "grp", "key").join(
        of_class, (F.col("grp") == F.col("g")) & (F.col("key") == F.col("k"))).select("vec_id", "n_links", "component_id")
    ok = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
          & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
          & F.exists("embedding", lambda x: x != 0))
    alone = vectors.where(F.col("vec_id").isNotNull() & ~F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").cast("long").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
