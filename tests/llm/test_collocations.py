"""Collocations against a plain count of all n-grams."""

import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from needbridge.llm import collocations as col
from needbridge.llm import queries
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, n string, phrase int, rank string, f string"
UPPER = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER))]


def plain_counts(texts):
    f = Counter()
    for t in texts:
        for w in pieces(t):
            f[()] += len(w)
            for n in (1, 2, 3):
                f.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return f


def plain(rows, least=10, top=2000, subsumed=50):
    out = []
    for lang in {r[1] or "und" for r in rows}:
        f = plain_counts([t for t, x in rows if (x or "und") == lang])
        cand = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in cand.items():
            if any(len(b) > len(g) and 100 * fb >= subsumed * a and
                   any(b[i:i + len(g)] == g for i in range(len(b) - len(g) + 1)) for b, fb in cand.items()):
                continue
            score, k = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, f[()], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, "n", 1, "r", "f") for i, (t, x) in enumerate(rows)], SCHEMA)


def found(df):
    return sorted(tuple(r) for r in df.collect())


LINE = "The quick brown fox jumps over the lazy dog, the quick brown cat; and the lazy\tdog sleeps: a B c. "
ROWS = ([(LINE * 3, "en")] * 7 + [(LINE.upper(), None)] * 12 + [(None, "en"), ("", "fr"), ("one", "fr"), (" .,\n", None)]
        + [("the the the the the the the", "de")] * 4 + [("été ÉTÉ\r\nété ÉTÉ l'été", "fr")] * 11)


@pytest.mark.parametrize("least,top,subsumed", [(10, 2000, 50), (3, 5, 50), (1, 2000, 100), (2, 2000, 0)])
def test_against_plain_counts(spark, least, top, subsumed):
    assert found(col.collocations(frame(spark, ROWS), least, top, subsumed)) == plain(ROWS, least, top, subsumed)


def test_small_blocks_and_slices(spark, monkeypatch):
    for name, value in {"SUM_BYTES": 500, "TASK_BYTES": 900}.items():
        monkeypatch.setattr(col, name, value)
    want = plain(ROWS, 2)
    assert found(col.collocations(frame(spark, ROWS).repartition(7), 2)) == want


def test_against_oracle_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    res = con.execute(queries.oracle_sql()["op12_prefix_free_phrases"])
    want = sorted(res.fetchall())
    got = queries.op12_prefix_free_phrases(spark, SF_SMALL)
    assert got.columns == [d[0] for d in res.description]
    assert found(got) == want and len(want) > 100


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(4 * 10**9, 4 * 10**9 + 1, 5 * 10**9), (10**14, 10**14, 10**14)], "a long, l long, r long")
    got = [r[0] for r in df.select(col._quotient(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [10**6 * 16 * 10**18 // ((4 * 10**9 + 1) * 5 * 10**9), 10**6]


def test_empty_table(spark):
    assert col.collocations(frame(spark, ROWS[:1]).where("false")).count() == 0


@given(st.text(alphabet="ab .\n\t", max_size=400), st.integers(1, 40))
def test_parse_covers_every_start_once(text, slice_bytes):
    old, col.SLICE, col.EVERY = (col.SLICE, col.EVERY), slice_bytes, 3
    try:
        chunks = list(col.chunks_of(text.encode()))
    finally:
        col.SLICE, col.EVERY = old
    grams = Counter()
    for chunk, ends in chunks:
        words = chunk.split(b" ")
        for i in range(len(words) if ends else len(words) - col.OVERLAP):
            for n in (1, 2, 3):
                g = words[i:i + n]
                if len(g) == n and b"\n" not in g:
                    grams[tuple(w.decode() for w in g)] += 1
    want = plain_counts([text])
    del want[()]
    assert grams == want
    assert sum(e for _, e in chunks) == (1 if chunks else 0)


def test_parse_is_prefix_free():
    texts = [LINE * 5, LINE[20:] * 4, LINE[::-1] * 3]
    chunks = {c + b" " for t in texts for c, ends in col.chunks_of(t.encode()) if not ends}
    assert not any(a != b and b.startswith(a) for a in chunks for b in chunks)
