import random

from llm_docs import docs
from pyspark.sql import functions as F

from needbridge.llm import line_dedup as ld


def sets(texts):
    out = []
    for d, t in enumerate(texts):
        for i, line in enumerate(t.split("\n") if t is not None else []):
            w = line.lower().split()
            k = min(5, len(w))
            out.append((d, i, {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if k else set()))
    return out


def brute(texts):
    s, gone = sets(texts), set()
    for x, (d, i, a) in enumerate(s):
        if a and any(b and 100 * len(a & b) >= 80 * len(a | b) for _, _, b in s[:x]):
            gone.add((d, i))
    return gone


def corpus():
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(120)]
    pool = [[rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 4, 5, 6, 9, 30, 60, 200]))] for _ in range(25)]
    texts = [None, "", "\n\n", " \t ", "Same Line\nsame  line\n\nother"]
    for _ in range(50):
        lines = []
        for _ in range(rnd.randrange(1, 6)):
            line = list(rnd.choice(pool))
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                line[rnd.randrange(len(line))] = rnd.choice(vocab)
            lines.append(rnd.choice([" ", "  "]).join(line))
        texts.append("\n".join(lines))
    return texts + [texts[10], texts[10]]


def test_equals_brute_force(spark):
    texts = corpus()
    got = [tuple(r) for r in ld.removed_lines(docs(spark, texts)).collect()]
    assert set(got) == brute(texts) and len(got) == len(set(got))


def test_drop_lines(spark):
    texts = corpus()
    gone = brute(texts)
    want = {}
    for d, t in enumerate(texts):
        lines = t.split("\n") if t is not None else []
        left = [x for i, x in enumerate(lines) if (d, i) not in gone]
        if len(left) == len(lines):
            want[d] = t
        elif any(x.strip() for x in left):
            want[d] = "\n".join(left)
    d = docs(spark, texts)
    out = ld.drop_lines(d)
    assert out.columns == d.columns
    rows = out.collect()
    assert {r.doc_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text or "") for r in rows)


def test_counted_shingles_are_those_of_the_keys(spark):
    lines = ld.lines_of(docs(spark, corpus()))
    arrays = ld.with_hashes(lines).select(F.explode(ld.shingles()).alias("s"))
    rows = ld.exploded_shingles(lines)
    assert sorted(r.s for r in rows.collect()) == sorted(r.s for r in arrays.collect())
    # no lambda is called for each word
    assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_empty_table(spark):
    assert ld.removed_lines(docs(spark, [])).collect() == []
    assert ld.drop_lines(docs(spark, [])).collect() == []
