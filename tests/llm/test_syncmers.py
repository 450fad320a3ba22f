"""Closed syncmers against a plain implementation of the definition."""

import hashlib
import struct

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from needbridge.llm import syncmers
from needbridge.llm.syncmers import K, S, WINDOW
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, n_chars string, key string, bucket int, next string"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h(text, seed=42):
    return xxhash.xxh64_intdigest(text.encode(), seed)


def plain_anchors(text):
    out = []
    hs = [signed(h(text[i:i + S])) for i in range(len(text) - S + 1)]
    for i in range(len(text) - K + 1):
        inner = hs[i:i + WINDOW]
        if min(inner) in (inner[0], inner[-1]):
            key = 42
            for j in sorted({*range(0, WINDOW - 1, S), WINDOW - 1}):
                key = xxhash.xxh64_intdigest(struct.pack("<q", inner[j]), key)
            out.append((i, signed(key)))
    return out


def plain_keys(text):
    found = [k for _, k in plain_anchors(text)]
    return found or [signed(xxhash.xxh64_intdigest(text.encode(), h("whole")))]


def plain_print(keys):
    return "".join(f"{k & 0xFFFFFFFF:08x}" for k in keys)


def plain_near(a, b):
    return len(set(a) & set(b)) / max(len(set(a)), len(set(b)))


def expected(rows):
    """rows: (doc_id, text); unique ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed(h(r[1]))))
    out = {}
    for at, (i, t) in enumerate(rows):
        nxt = rows[(at + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, b, c = plain_keys(t), plain_keys(edited), plain_keys(nxt)
        out.setdefault(i, []).append((len(t), hashlib.sha256(edited.encode()).hexdigest(), plain_print(a),
                                      plain_print(b), plain_near(a, b), plain_near(a, c)))
    return {i: sorted(v) for i, v in out.items()}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in (
            "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")))
    return {i: sorted(v) for i, v in out.items()}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 3, "z") for i, t in rows], SCHEMA)


LONG = "".join(chr(97 + (i * i * 7 + i // 13) % 26) + (" " if i % 6 == 5 else "") for i in range(9000))
CASES = [(7, None), (3, ""), (12, "short"), (5, LONG), (4, LONG[::-1]), (9, "é😀\n" * 40 + "tail of the text"),
         (8, "a" * 300), (1, "x" * K), (-4, "x" * (K - 1)), (10, LONG[:60]), (11, LONG[:60]),
         (None, "no id"), (None, "no id either, but a text of some length"), (20, "one line\r\n\ttwo " * 9)]


def test_against_definition(spark):
    assert found(syncmers.fingerprint_edits(frame(spark, CASES))) == expected(CASES)


def test_many_buckets_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "BUCKET_BYTES", 700)
    monkeypatch.setattr(syncmers, "SAMPLES", 1000)
    assert found(syncmers.fingerprint_edits(frame(spark, CASES))) == expected(CASES)


def test_many_buckets_of_the_table(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    monkeypatch.setattr(syncmers, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(syncmers, "_STEP", 8)
    assert found(syncmers.fingerprint_edits(docs.repartition(5))) == want


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a text that stands twice in the table"), (1, "a text that stands twice in the table"),
            (1, "another text of the same id, of more words"), (2, LONG[:200])]
    assert found(syncmers.fingerprint_edits(frame(spark, rows))) == expected(rows)


def test_empty_table_and_single_row(spark):
    assert syncmers.fingerprint_edits(frame(spark, []).where("false")).count() == 0
    one = [(5, LONG[:100])]
    assert found(syncmers.fingerprint_edits(frame(spark, one))) == expected(one)


def test_segments_do_not_show(spark, monkeypatch):
    df = frame(spark, [(1, LONG)])
    whole = [(r["pos"], r["key"]) for r in df.select(syncmers.anchors(F.col("text"))).first()[0]]
    assert whole == plain_anchors(LONG)
    monkeypatch.setattr(syncmers, "SEGMENT", 50)
    assert [(r["pos"], r["key"]) for r in df.select(syncmers.anchors(F.col("text"))).first()[0]] == whole


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n", max_size=70), min_size=1, max_size=5))
def test_random_texts(spark, texts):
    rows = list(enumerate(texts))
    assert found(syncmers.fingerprint_edits(frame(spark, rows))) == expected(rows)


def test_window_guarantee():
    at = [i for i, _ in plain_anchors(LONG)]
    assert max(b - a for a, b in zip(at, at[1:])) <= WINDOW
