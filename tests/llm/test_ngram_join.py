import random

import numpy as np
import pytest

from llm_docs import docs
from needbridge.llm import ngram_join as nj
from needbridge.llm.common import components


def sets(texts, k):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        j = min(k, len(w))
        out.append({tuple(w[i:i + j]) for i in range(len(w) - j + 1)} if j else set())
    return out


def root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute(texts, k=4, num=85, den=100):
    s = sets(texts, k)
    parent = list(range(len(s)))
    for i in range(len(s)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and den * both >= num * (len(s[i]) + len(s[j]) - both):
                a, b = sorted((root(parent, i), root(parent, j)))
                parent[b] = a
    return {(i, len(s[i]), root(parent, i)) for i in range(len(s))}


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    prose = lambda n: [rnd.choice(vocab) for _ in range(n)]
    shared = prose(60)
    out = [None, "", " \t\n", "One two", "ONE\x0btwo", "one two", "Ä b", "ä b", "a b c d", "a b c d a b c d"]
    for n in (12, 40, 150, 400):
        for _ in range(6):
            base = prose(n) + (shared if rnd.random() < 0.5 else [])
            out.append(" ".join(base))
            for _ in range(rnd.choice([0, 3, 9])):  # near copies around the threshold, chains of them too
                copy = list(base)
                for _ in range(rnd.choice([0, 1, 1, 2, n // 40 + 1, n // 25 + 1])):
                    copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
                out.append(("\n" if rnd.random() < 0.3 else " ").join(copy).upper())
                if rnd.random() < 0.4:
                    base = copy
    rnd.shuffle(out)
    return out


def test_equals_brute_force(spark, texts):
    got = nj.link_documents(docs(spark, texts)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute(texts)
    assert len(got) == len(texts)


def test_five_words_at_080(spark, texts):
    got = nj.link_documents(docs(spark, texts), 5, 80, 100).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute(texts, 5, 80)


def test_without_anchor_rounds_and_without_common_counts(spark, texts, monkeypatch):
    monkeypatch.setattr(nj, "ANCHOR_ROUNDS", 0)
    monkeypatch.setattr(nj, "COMMON_SHINGLES", 1)
    got = nj.link_documents(docs(spark, texts)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute(texts)


def test_common_prefixes_ask_for_more_matches():
    keys = np.arange(1, 101, dtype=np.uint64)
    common = (keys[80:], np.full(20, 500))
    assert nj.adaptive_prefix(keys, (keys[:0], keys[:0]), 85, 100)[1] == 1
    prefix, m = nj.adaptive_prefix(keys[80:], common, 85, 100)
    assert m > 1 and len(prefix) == 3 + m
    # rare shingles first, common ones after them by count and key
    assert nj.adaptive_prefix(keys[76:], common, 85, 100)[0].tolist() == [77, 78, 79, 80]


def test_one_of_each_group_stays(spark, texts):
    d = docs(spark, texts)
    out = nj.drop_near_copies(d)
    assert out.columns == d.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, _, c in brute(texts, 5, 80)})


def test_empty_table(spark):
    assert nj.link_documents(docs(spark, [])).collect() == []


def test_components_of_a_long_path(spark):
    rnd = random.Random(3)
    ids = list(range(200))
    rnd.shuffle(ids)
    edges = [(a, b) for a, b in zip(ids, ids[1:])] + [(500, 400), (400, 500), (7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    want = {(i, 0) for i in ids} | {(500, 400), (400, 400)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_repeated_keys_are_counted_in_place():
    rnd = np.random.default_rng(3)
    for size in (0, 1, 3, 4, 5, 500):
        keys = rnd.integers(0, max(1, size // 4), size).astype(np.uint64)
        want, n = np.unique(keys, return_counts=True)
        got, m = nj.repeated(keys, 4)
        assert got.tolist() == want[n >= 4].tolist() and m.tolist() == n[n >= 4].tolist()
        assert m.dtype == np.int64 and keys.tolist() == sorted(keys.tolist())
