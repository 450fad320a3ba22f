import hashlib
import random
import re

import numpy as np

from llm_docs import docs
from needbridge.llm import pii
from needbridge.llm.boosting import BoostedTrees, calibrated_threshold


def brute(text):
    text = text or ""
    out = {k: [] for k in pii.KINDS}
    out["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
                 if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        s = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and s % 10 == 0:
            out["card"].append(m.span())
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                    if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def texts():
    rnd = random.Random(8)
    out = [None, "", "é@ü.de a@b.c@d.e.f x@@y.z @q.r a.b@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.003.255 1.2.3", "+1 (2) 3-4.5 6 78",
           "4111 1111 1111 1111 and 4111-1111-1111-1112", "+" * 5 + "12345678901234567890", "4" * 500]
    for _ in range(400):
        out.append("".join(rnd.choice("ab1234 .@+-()é9\n") for _ in range(rnd.randrange(5, 90))))
    for i in range(200):
        out.append(f"please call {rnd.choice(['tel', 'phone'])} +4{i % 10} {rnd.randrange(10**8, 10**9)} or mail joe{i}@ex{i}.org, "
                   f"order {rnd.randrange(10**6, 10**9)} of 12/12/2012; server 10.0.{i}.{i % 255}")
        out.append(f"contact ann{i} at site{i} dot com or call 0049 {rnd.randrange(10**7, 10**8)}")
    return out


def test_base_spans_equal_the_patterns_and_stay(spark):
    t = texts()
    model = pii.train(docs(spark, t))
    got = {r.doc_id: r for r in pii.find(docs(spark, t), model).collect()}
    assert len(got) == len(t)
    for i, text in enumerate(t):
        base = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k])
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS], text
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text
        spans = [s for s in got[i].spans.split(",") if s]
        assert set(filter(None, joined.split(","))) <= set(spans)
        assert len(spans) == sum(len(v) for v in base.values()) + got[i].n_added
        key = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert key == sorted(key)


def test_long_runs_take_linear_time():
    pii.base_spans("a" * 200_000 + " " + "1" * 200_000 + "@ " + "9." * 3)


def test_trees_and_threshold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    p = BoostedTrees().fit(x[:2000], y[:2000]).predict(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.95
    t = calibrated_threshold(p, y[2000:], 0.9)
    assert y[2000:][p >= t].mean() >= 0.9
    assert calibrated_threshold(np.ones(4), np.zeros(4), 0.9) == float("inf")


def test_redact_and_empty_table(spark):
    t = ["mail a@b.cd now 1.2.3.4", None, "clean"]
    d = docs(spark, t)
    out = pii.redact(d, pii.find(d, pii.Model([])))
    assert {r.doc_id: r.text for r in out.collect()} == {0: "mail [email] now [ip]", 1: None, 2: "clean"}
    assert out.columns == d.columns
    assert pii.find(docs(spark, []), pii.train(docs(spark, []))).collect() == []


def test_spelled_out_forms_are_added(spark):
    t = texts()
    got = {r.doc_id: r for r in pii.find(docs(spark, t), pii.train(docs(spark, t))).collect()}
    spelled = [i for i, text in enumerate(t) if text and text.startswith("contact ann")]
    address = phone = 0
    for i in spelled:
        at, end, call = t[i].index("ann"), t[i].index(" or call"), t[i].index("0049")
        spans = got[i].spans.split(",")
        address += f"email:{at}:{end}" in spans
        phone += f"phone:{call}:{len(t[i])}" in spans
    assert len(spelled) == 200 and address > 180 and phone > 180, (address, phone)
    plain = [i for i, text in enumerate(t) if text and text.startswith("please call")]
    dates = [s for i in plain for s in got[i].spans.split(",") if s and "/" in t[i][int(s.split(":")[1]):int(s.split(":")[2])]]
    assert len(dates) < 10


def test_no_added_span_meets_a_base_span(spark):
    t = texts() + [f"host ip 43.21.{i}.162 tel +1 (443) 555-{5000 + i} phone" for i in range(150)]
    added = 0
    for r in pii.find(docs(spark, t), pii.train(docs(spark, t))).collect():
        base = {f"{k}:{a}:{b}" for k, spans in brute(t[r.doc_id]).items() for a, b in spans}
        spans = [s for s in r.spans.split(",") if s]
        where = sorted((int(s.split(":")[1]), int(s.split(":")[2]), s in base) for s in spans)
        added += r.n_added
        assert r.n_added == len(set(spans) - base)
        for i, (a, b, known) in enumerate(where):
            assert known or not any(x < b and a < y for j, (x, y, _) in enumerate(where) if j != i), t[r.doc_id]
    assert added > 300


def test_redact_overlapping_spans(spark):
    d = docs(spark, ["1.2.3.4 4111111111111111 x", "abc"])
    spans = spark.createDataFrame([(0, "ip:0:7,card:4:24,phone:8:12"), (1, "")], "doc_id long, spans string")
    assert [r.text for r in pii.redact(d, spans).orderBy("doc_id").collect()] == ["[ip+card+phone] x", "abc"]


def test_many_spans_in_one_text_take_linear_time():
    import time
    text = " ".join(f"a{i}@b{i}.org 10.0.{i % 256}.1 +4912345{i:05d} tel 0049 1234{i:05d}" for i in range(20_000))
    model = pii.Model(texts()[-400:])
    start = time.monotonic()
    added = model.added(text, pii.base_spans(text))
    assert time.monotonic() - start < 60 and len(added) > 1000
