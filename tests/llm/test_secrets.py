import random

from llm_docs import docs
from needbridge.llm import secrets


def corpus():
    rnd = random.Random(6)
    hexa = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    word = lambda: "".join(rnd.choice(["the", "tion", "ing", "and", "er"]) for _ in range(rnd.randrange(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts, truth = [None, "", "short 123"], {}
    for i in range(240):
        kind = i % 6
        secret = [f'token = "{hexa(40)}"', f"password={hexa(18)}", "AKIA" + hexa(16).upper(), "".join(rnd.choice("0123456789") for _ in range(16)),
                  prose(8).upper().replace(" ", ""), f"http://host/{word()}{rnd.randrange(10**6)}{word()}page"][kind]
        texts.append(f"{prose(12)}\n{secret} {prose(9)}")
        truth[len(texts) - 1] = kind < 3
    return texts, truth


def test_forest_tells_secrets_from_false_positives(spark):
    texts, truth = corpus()
    rows = secrets.find_secrets(docs(spark, texts)).collect()
    hit = {}
    for r in rows:
        assert len(texts[r.doc_id][r.start:r.start + r.length]) == r.length
        hit[r.doc_id] = hit.get(r.doc_id, False) or r.is_secret
    judged = [d for d in truth if d in hit]
    assert all(d in hit for d, is_secret in truth.items() if is_secret)
    assert sum(hit[d] == truth[d] for d in judged) / len(judged) > 0.95
    for r in rows:
        text = texts[r.doc_id]
        assert r.start == 0 or not (text[r.start - 1].isalnum() or text[r.start - 1] in "+/_-")


def test_held_out_findings(spark):
    texts, truth = corpus()
    found = secrets.with_features(secrets.scan(docs(spark, texts)), ["the", "and", "ion", "tio", "ing"]).cache()
    forest = secrets.train(secrets.rule_labels(found.where("doc_id div 6 % 2 = 0")))
    from pyspark.ml.feature import VectorAssembler
    held = VectorAssembler(inputCols=list(secrets.FEATURES), outputCol="features").transform(found.where("doc_id div 6 % 2 = 1"))
    rows = forest.transform(held).select("doc_id", "prediction").collect()
    assert sum((r.prediction == 1) == truth[r.doc_id] for r in rows) / len(rows) > 0.9


def test_no_python_in_the_plan_and_empty_table(spark):
    d = docs(spark, corpus()[0])
    plan = secrets.find_secrets(d)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert secrets.find_secrets(docs(spark, [])).collect() == []
    assert secrets.find_secrets(docs(spark, ["x " + "A1" * 10])).count() == 1


def test_every_place_and_short_secrets_after_a_cue(spark):
    key = "a1B2c3D4e5F6g7H8i9"
    texts = [f'{{"x":"{key}zz","y":"{key}","z":"{key}"}}', 'é pwd="hunter22";', "my password: hunter22 ok", "pass hunter2 end",
             'db password = "s3cret77" x', '{"user":"bob12345","password":"hunter22"}', "room abc12345 here"]
    got = {}
    for r in secrets.scan(docs(spark, texts)).collect():
        assert texts[r.doc_id][r.start:r.start + len(r.candidate)] == r.candidate
        got.setdefault(r.doc_id, []).append((r.start, r.candidate))
    at = [texts[0].index(key), texts[0].index(key, 12), texts[0].rindex(key)]
    assert sorted(got[0]) == [(at[0], key + "zz"), (at[1], key), (at[2], key)]
    assert [[c for _, c in got.get(i, [])] for i in range(1, 7)] == [["hunter22"], ["hunter22"], ["hunter2"], ["s3cret77"], ["hunter22"], []]
