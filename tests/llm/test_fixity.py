from needbridge.llm import fixity

SCHEMA = "page_id long, url string, html string, length int"


def pages(spark, n=400):
    rows = [(i * 7, f"http://a/{i}", f"<p>{'x' * (i % 9)} é {i}", 1) for i in range(n)]
    return spark.createDataFrame(rows + [(None, None, None, 1), (5, None, "", 1), (5, None, "", 1)], SCHEMA)


def test_audit_finds_exactly_the_damage(spark, monkeypatch):
    monkeypatch.setattr(fixity, "FANOUT", 3)
    records = fixity.records_of(pages(spark)).cache()
    whole = records.collect()
    by = {}
    for r in sorted(whole, key=lambda r: (r.archive, r.seq)):
        assert r.offset == by.get(r.archive, 0) and r.length == len(r.record)
        by[r.archive] = r.offset + r.length
    replica = fixity.damaged_copy(records).cache()
    assert fixity.audit(fixity.leaves(records), fixity.leaves(records)).collect() == []
    have = {(r.archive, r.offset): bytes(r.record) for r in replica.collect()}
    want = {(r.archive, r.offset): "damaged" if (r.archive, r.offset) in have else "missing"
            for r in whole if have.get((r.archive, r.offset)) != bytes(r.record)}
    got = fixity.audit(fixity.leaves(records), fixity.leaves(replica)).collect()
    assert {(r.archive, r.offset): r.status for r in got} == want and len(got) == len(want) > 0
    back = fixity.audit(fixity.leaves(replica), fixity.leaves(records)).collect()
    assert {(r.archive, r.offset) for r in back if r.status == "extra"} == {k for k, v in want.items() if v == "missing"}
    assert fixity.corpus_root(fixity.leaves(records)) != fixity.corpus_root(fixity.leaves(replica))
    assert fixity.corpus_root(fixity.leaves(records)) == fixity.corpus_root(fixity.leaves(records.repartition(5)))


def test_empty_tables(spark):
    none = fixity.leaves(fixity.records_of(spark.createDataFrame([], SCHEMA)))
    some = fixity.leaves(fixity.records_of(pages(spark, 3)))
    assert fixity.audit(none, none).collect() == []
    assert {r.status for r in fixity.audit(some, none).collect()} == {"missing"}
    assert fixity.corpus_root(none) is None
