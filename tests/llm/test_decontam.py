import random

import pytest

from llm_docs import docs
from needbridge.llm import decontam


def brute(texts, items, containment=0.8):
    out = set()
    for d, text in enumerate(texts):
        w = decontam.words(text)
        for i, item in items:
            v = decontam.words(item)
            k = min(5, len(v))
            if not k:
                continue
            a = {tuple(v[j:j + k]) for j in range(len(v) - k + 1)}
            b = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
            if len(a & b) >= containment * len(a) - 1e-9:
                out.add((d, i, len(a), len(a & b)))
    return out


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, prose(rnd.choice([6, 9, 20, 45, 80]))) for i in range(40)]
    items += [(90, None), (91, ""), (92, "Short one."), (93, items[0][1]), (94, "solo")]
    texts = [None, "", "...", "it says: short ONE!", "a solo b"]
    for i in range(120):
        words = items[i % 40][1].split()
        for _ in range(i % 5):  # edits make near and far passages
            words[rnd.randrange(len(words))] = "edit"
        texts.append(f"{prose(rnd.choice([0, 10, 900]))}\n{', '.join(words).upper()}. {prose(30)}")
    texts += [prose(200) for _ in range(30)] + [texts[5], texts[5]]
    return texts, items


@pytest.mark.parametrize("block", [7, 5_000])
def test_equals_brute_force(spark, corpus, block):
    texts, items = corpus
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontam.find_items(docs(spark, texts), bench, items_per_block=block).collect()
    want = brute(texts, items)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(n > shared for _, _, n, shared in want)


def test_decontaminate_keeps_clean_rows_and_columns(spark, corpus):
    texts, items = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = docs(spark, texts)
    out = decontam.decontaminate(d, bench)
    bad = {x[0] for x in brute(texts, items)}
    assert out.columns == d.columns
    assert sorted(r.doc_id for r in out.collect()) == [i for i in range(len(texts)) if i not in bad]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_items(docs(spark, ["a b"]), none).count() == 0
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontam.find_items(docs(spark, []), one).count() == 0
    assert decontam.decontaminate(docs(spark, ["x"]), none).count() == 1
