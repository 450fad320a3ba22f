import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from llm_docs import DOC_SCHEMA
from needbridge.llm import kneser_ney as kn


def brute_model(texts):
    """Modified Kneser-Ney by its definition, in plain Python: p(gram)."""
    order = kn.ORDER
    c = {order: Counter()}
    for t in texts:
        t = kn.prepared(t)
        for i in range(order - 1, len(t)):
            c[order][t[i - order + 1:i + 1]] += 1
    for k in range(order - 1, 0, -1):
        c[k] = Counter(g[1:] for g in c[k + 1])
    held, total, disc = {}, {}, {}
    for k in c:
        n = [0] + [sum(v == j for v in c[k].values()) for j in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        disc[k] = []
        for j in (1, 2, 3):
            raw = j - (j + 1) * y * n[j + 1] / n[j] if y is not None and n[j] else 0.5 * j
            disc[k].append(min(max(raw, 0.1 * j), 0.95 * j))
        held[k], total[k] = defaultdict(float), Counter()
        for g, v in c[k].items():
            held[k][g[:-1]] += disc[k][min(v, 3) - 1]
            total[k][g[:-1]] += v

    def p(g):
        k = len(g)
        if not k:
            return 1 / kn.ALPHABET
        h = g[:-1]
        if not total[k][h]:
            return p(g[1:])
        v = c[k][g]
        return (v - disc[k][min(v, 3) - 1] if v else 0) / total[k][h] + held[k][h] / total[k][h] * p(g[1:])
    return p


def corpus():
    rnd = random.Random(2)
    words = {"en": "the of and tion ing stone river under".split(), "fr": "le la été que rivière sous".split()}
    rows, labels = [], []
    for i in range(160):
        lang = rnd.choice(["en", "fr"])
        text = " ".join(rnd.choice(words[lang]) for _ in range(rnd.randrange(5, 60))) + "."
        junk = i % 8 == 0
        if junk:
            text = "".join(rnd.choice("#%&XQZ|! ") for _ in range(200))
        rows.append((i, text, lang, "s", len(text)))
        if i % 3 and i % 7:
            labels.append((i, 0 if junk else 1, 0))
    rows += [(200, None, "en", "s", 0), (201, "", None, "s", 0), (202, "the of", None, "s", 6), (203, "été\n12", "de", "s", 6)]
    labels += [(0, 1, 1), (9, None, 0), (None, 1, 0), (3, 1, None)]
    return rows, labels


def test_equals_the_definition(spark, monkeypatch):
    monkeypatch.setattr(kn, "CHUNK_CHARS", 2000)
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    good = {i for i in {x[0] for x in labels} if i is not None
            and all(q == 1 and not t for d, q, t in labels if d == i)}
    got = {r.doc_id: r for r in kn.judge(docs, lab).collect()}
    assert set(got) == {r[0] for r in rows}
    models = {lang: brute_model([r[1] for r in rows if r[0] in good and r[2] == lang]) for lang in ("en", "fr")}
    for i, text, lang, *_ in rows:
        if not text:
            assert got[i].perplexity is None and got[i].kept
        elif lang in models:
            t = kn.prepared(text)
            logs = [math.log(models[lang](t[j - kn.ORDER + 1:j + 1])) for j in range(kn.ORDER - 1, len(t))]
            assert math.isclose(got[i].perplexity, math.exp(-sum(logs) / len(logs)), rel_tol=1e-3), i
        assert got[i].kept == (got[i].perplexity is None or got[i].perplexity <= got[i].threshold)
    held_out = [r[0] for r in rows if r[0] < 160 and r[0] not in good]
    right = sum(got[i].kept == (i % 8 != 0) for i in held_out)
    assert right / len(held_out) > 0.95


def test_keep_good_keeps_columns_and_handles_empty_tables(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = kn.keep_good(docs, lab)
    assert out.columns == docs.columns and 100 < out.count() < len(rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert kn.keep_good(docs, none).count() == len(rows)
    assert kn.judge(docs.limit(0), lab).count() == 0


def test_threshold_is_of_held_out_perplexities(spark):
    rnd = random.Random(4)
    syllables = "ka mo ri te lu sa ne po vi du".split()
    vocabulary = ["".join(rnd.choice(syllables) for _ in range(3)) for _ in range(400)]
    rows = [(i, " ".join(rnd.choice(vocabulary) for _ in range(80)), "xx", "s", 0) for i in range(60)]
    rows += [(i, "".join(rnd.choice("#%&XQZ|! ") for _ in range(400)), "xx", "s", 0) for i in range(60, 70)]
    labels = [(i, 1, 0) for i in range(8)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = {r.doc_id: r for r in kn.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == 70
    fold = {r.doc_id: r.f for r in docs.select("doc_id", kn._fold().alias("f")).collect()}
    held = []
    for i in range(8):
        p, t = brute_model([rows[j][1] for j in range(8) if fold[j] != fold[i]]), kn.prepared(rows[i][1])
        logs = [math.log(p(t[j - kn.ORDER + 1:j + 1])) for j in range(kn.ORDER - 1, len(t))]
        held.append(math.exp(-sum(logs) / len(logs)))
    assert math.isclose(got[0].threshold, max(held), rel_tol=1e-3)
    assert sum(got[i].kept for i in range(8, 60)) > 45
    assert not any(got[i].kept for i in range(60, 70))


def test_languages_without_a_model_are_not_judged(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = {r.doc_id: r for r in kn.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    for i in (202, 203):
        assert got[i].kept and got[i].perplexity is None and got[i].threshold is None
    assert [got[202].lang, got[203].lang] == [None, "de"]


def test_executors_may_change_between_the_passes(spark, monkeypatch, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(rows * 3, DOC_SCHEMA).repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = sorted(map(tuple, kn.judge(docs, lab).collect()), key=str)
    plain, cores = kn.materialize, "spark.sql.leafNodeDefaultParallelism"
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set(cores, "2")
    splits = []

    def changing(df, tag):
        out = plain(df, tag)
        if tag == "asked":
            spark.conf.set(cores, "16")
            splits.append(docs.select("text").rdd.getNumPartitions())
        return out

    monkeypatch.setattr(kn, "materialize", changing)
    try:
        before = docs.select("text").rdd.getNumPartitions()
        got = sorted(map(tuple, kn.judge(docs, lab).collect()), key=str)
        assert docs.select("text").rdd.getNumPartitions() != before == splits[0]
    finally:
        spark.conf.unset(cores)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want


def test_answers_of_a_shard_come_once_however_many_chunks_ask():
    points = np.array([[97, 98, 99, 100], [97, 98, 99, 101]], np.uint32)
    keys = kn._keys_of(points)
    order = np.argsort(keys)
    told = (keys[order].tobytes(), np.array([-1.0, -2.0], np.float32)[order].tobytes())
    rows = [(":en", 3, None, None, *told)]
    rows += [(":en", 3, i, kn._packed(points[i % 2:]), None, None) for i in range(50)]
    rows += [(":en", 4, None, None, keys[:1].tobytes(), np.array([-3.0], np.float32).tobytes()),
             (":en", 4, 7, kn._packed(points[:1]), None, None),
             (":xx", 4, 8, kn._packed(points[:1]), None, None)]  # a language without a model
    names = ["lang", "shard", "chunk", "grams", "keys", "logps"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i:i + 20]), kinds)], names=names)
               for i in range(0, len(rows), 20)]
    assert sum(r[4] is not None for r in rows) == 2
    got = [r for b in kn._answer(iter(batches)) for r in b.to_pylist()]
    assert [(r["a_chunk"], r["a_lang"]) for r in got] == [(i, ":en") for i in [*range(50), 7]]
    for r in got[:50]:
        assert np.frombuffer(r["logps"], np.float32).tolist() == [-1.0, -2.0][r["a_chunk"] % 2:]
    assert np.frombuffer(got[50]["logps"], np.float32).tolist() == [-3.0]


def test_no_join_copies_the_answers_to_every_chunk(spark, monkeypatch):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    seen, plain = [], kn.perplexities

    def planned(texts, tables):
        seen.append(plain(texts, tables))
        return seen[-1]

    monkeypatch.setattr(kn, "perplexities", planned)
    kn.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "_answer" in plan and "Join" not in plan[plan.index("_answer"):]


def test_a_chunk_holds_no_texts_together_and_scores_the_same(monkeypatch):
    monkeypatch.setattr(kn, "TaskContext", type("T", (), {"get": lambda: type("C", (), {"partitionId": lambda _: 0})()}))
    texts = ["abcab", "", "the of tion", "a", "été"]
    folds = [None, "1", "1", None, "0"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4, 5], "lang": ["en"] * 5, "fold": folds, "text": texts})
    got, asked = [], []
    for chars in (4, 1000):
        most = []
        monkeypatch.setattr(kn, "SCORE_CHARS", chars)
        monkeypatch.setattr(kn, "SLICE_CHARS", chars)
        list(kn._chunks(iter([batch]), chars, lambda parts, texts, folds: most.append((len(texts), len(folds)))))
        asked.append({r["lang"]: b"".join(kn._unpacked(x["grams"]).tobytes() for x in rows if x["lang"] == r["lang"])
                      for rows in [[x for b in kn._ask(iter([batch])) for x in b.to_pylist()]] for r in rows})
        sent = next(kn._send(iter([batch]))).to_pandas()
        answer = pd.DataFrame([{"a_lang": k, "grams": kn._packed(np.frombuffer(v, np.uint32).reshape(-1, kn.ORDER)),
                                "logps": np.linspace(-3, -1, len(v) // 16).astype(np.float32).tobytes()}
                               for k, v in asked[0].items()])
        got.append((len(sent["packed"][0]), kn._score(sent, answer)))
        assert most == ([(1, 1), (2, 2), (1, 1), (1, 1)] if chars == 4 else [(5, 5)])
    assert set(asked[0]) == {":en", "0:en", "1:en"} and asked[0] == asked[1]
    assert got[0][0] > got[1][0] == 1
    pd.testing.assert_frame_equal(got[0][1], got[1][1])
    assert got[0][1]["perplexity"].notna().tolist() == [bool(t) for t in texts]
    assert got[0][1]["held_out"].notna().tolist() == [bool(t) and f is not None for t, f in zip(texts, folds)]


def test_slices():
    assert list(kn.slices([3, 0, 2], 3)) == [(0, 1), (1, 3)]
    assert list(kn.slices([])) == []
