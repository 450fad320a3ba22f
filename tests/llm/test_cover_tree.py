"""Cover tree search against all pairs."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from needbridge.llm import cover_tree as ct
from needbridge.llm import queries
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, label int, embedding array<float>, size string, block string, team int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, la, e, "s", "b", 1, "x") for i, la, e in rows], SCHEMA)


def plain(rows, every=3, positives=5, negatives=3, low=50, high=95, levels=256):
    items = {}
    for i, la, e in rows:
        if i is None or la is None or not e or any(x is None or not np.isfinite(x) for x in e):
            continue
        v = (la, [int(np.floor(levels * np.float64(np.float32(x)))) for x in e])
        items[i] = min(items.get(i, v), v)
    out = []
    for a, (la, va) in items.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, lb) for i, (lb, v) in items.items()
                        if i != a and len(v) == len(va))
        for p, pid, _ in [s for s in scored if s[2] == la][:positives]:
            neg = [(i, -s) for s, i, lb in scored if lb != la and low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(a, pid, r, i, -p, s) for r, (i, s) in enumerate(neg, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def mined(spark, rows, every=3):
    return found(ct.mine(ct.quantized(frame(spark, rows)), F.col("vec_id") % every == 0))


def clustered(n, dim, seed, groups=9):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    x = centres[rng.integers(0, groups, n)] + 0.3 * rng.normal(size=(n, dim))
    return [(int(i), int(rng.integers(0, 4)), [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("block,leaf", [(2048, 32), (40, 4)])
def test_against_all_pairs(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(ct, "BLOCK", block)
    monkeypatch.setattr(ct, "LEAF", leaf)
    rows = clustered(400, 6, 1)
    want = plain(rows)
    assert len(want) > 500
    assert mined(spark, rows) == want


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(ct, "BLOCK", 30)
    rows = clustered(80, 4, 2)
    e = rows[5][2]
    rows += [(100 + i, i % 3, e) for i in range(60)]  # equal vectors: ties by id
    rows += [(None, 1, e), (300, None, e), (303, 1, None), (306, 1, []), (309, 1, [1.0, None, 2.0, 3.0]),
             (312, 1, [float("nan")] * 4), (315, 2, [float("inf")] * 4), (318, 1, [0.0] * 4), (321, 2, [0.0] * 4),
             (324, 1, [1.0, 2.0]), (327, 1, [2.0, 2.0]), (330, 2, [1.5, 1.0]), (333, 3, [-1.0] * 4), (-6, 3, [-0.9] * 4)]
    rows += rows[:7] + [(9, 0, [9.0, 1.0, 1.0, 0.0]), (12, 3, rows[12][2])]  # repeated rows and ids
    assert mined(spark, rows) == plain(rows)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 2, [float(np.float32(v)) for v in rng.normal(size=3) * 3e5]) for i in range(40)]
    assert max(r[5] for r in mined(spark, rows)) > 2**52
    assert mined(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert mined(spark, clustered(3, 2, 1)[:0]) == []
    assert found(ct.mine(ct.quantized(frame(spark, clustered(3, 2, 1)).where("false")), F.lit(True))) == []


def test_bounds_hold_and_search_skips():
    rows = clustered(1500, 5, 4, groups=30)
    x = np.floor(256 * np.array([r[2] for r in rows]))
    ids, labels = np.arange(len(x)), np.array([r[1] for r in rows])
    tree = ct.build_tree(ids, labels, x)
    assert sorted(tree["ids"].tolist()) == ids.tolist()
    q = x[::100]
    best = ct.Found(len(q), 5)
    anyone = np.full(len(q), -np.inf), np.full(len(q), np.inf)
    work = ct.search(tree, q, np.arange(len(q)), *anyone, lambda r, i, la: np.ones((len(r), len(i)), bool), best)
    for r, got in enumerate(best.best):
        assert got == sorted((-int(s), int(i)) for s, i in zip(x @ q[r], ids))[:5]
    assert work < 0.7 * len(q) * len(x)


def test_against_oracle_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    res = con.execute(queries.oracle_sql()["op13_cover_tree_negatives"])
    want = sorted(res.fetchall())
    got = queries.op13_cover_tree_negatives(spark, SF_SMALL)
    assert got.columns == [d[0] for d in res.description]
    assert found(got) == want and want
