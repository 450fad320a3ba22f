import numpy as np

from needbridge.llm import ego_join as ego


def brute(rows):
    ok = [r[2] is not None and r[1] is not None and None not in r[1] and len(r[1]) > 0
          and np.isfinite(np.asarray(r[1], float)).all() and np.any(np.asarray(r[1], float)) for r in rows]
    n = len(rows)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.asarray(np.float32(rows[k][1]), np.float64) for k in (i, j))
                link[i, j] = link[j, i] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98
    comp = list(range(n))
    while True:
        new = [min([comp[i]] + [comp[j] for j in np.flatnonzero(link[i])]) for i in range(n)]
        if new == comp:
            break
        comp = new
    return {rows[i][0]: (int(link[i].sum()), rows[comp[i]][0]) for i in range(n)}


def data(n=260, dim=12):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(20)] + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.12, 0.4])
        rows.append((i, [float(x) for x in np.float32(v * rng.choice([1, 1, 3]))], int(rng.integers(3))))
    rows += [(n, None, 1), (n + 1, [0.0] * dim, 1), (n + 2, rows[0][1], None), (n + 3, rows[0][1], rows[0][2]),
             (n + 4, [1.0, None] + [0.0] * (dim - 2), 1), (n + 5, [float("nan")] * dim, 0),
             (n + 6, [float("inf")] + [1.0] * (dim - 1), 0), (n + 7, [1.0, 2.0], 0), (n + 8, [1.0, 2.0], 0), (n + 9, [], 0)]
    return rows


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ego, "BLOCK", 24)
    rows = data()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, n string")
    got = ego.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)
    assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_distant_intervals_are_skipped():
    z = np.zeros((200, 3))
    assert not ego._near(z, z + 0.3, 0.2) and ego._near(z, z + 0.1, 0.2)


def test_empty_table(spark):
    assert ego.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
