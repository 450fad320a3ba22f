import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_docs import docs
from needbridge.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
_TOK = Tokenizer.from_file(PATH)
TEXTS = ["", None, "Hello, world.", "don't stop", "ÉCOLE Straße İstanbul ΣΑΣ", "a\tb c  d\r\ne",
         "x...y,, z.", "<|endoftext|> and <|ENDOFTEXT|>", "é café.", "12.5 3,4 99%", "日本語 text",
         "cİ, İ. x", "<|endoftext|> b文İ.", "word " * 9000, "same text", "same text", "!!! ---", "naïve, été."]


def test_encoder_equals_the_tokenizer():
    tok, enc = Tokenizer.from_file(PATH), packing.ChunkEncoder(PATH)
    for text in TEXTS:
        want = tok.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text or ""), np.uint32).tolist() == want, text


def test_words_with_marks_are_encoded_by_their_parts():
    tok, enc = Tokenizer.from_file(PATH), packing.ChunkEncoder(PATH)
    chunks = ["straße&&&", "été.###", "words!?", "a|b_", "über[x]", "naïve", "ÿ;", "x...", "ab=c", "l'été", "on's.", "o<|", "$$$"]
    whole = []
    enc.tok = type("Spy", (), {"model": tok.model, "pre_tokenizer": tok.pre_tokenizer, "encode": lambda _, c, **k: (
        whole.append(c), tok.encode(c, **k))[1]})()
    for text in ["Straße&&& Été.### words!? naïve ÿ; x...", *chunks]:
        want = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), np.uint32).tolist() == want, text
    # letters, and marks without letters once, never a word with its marks
    assert not {"straße&&&", "été.###", "words!?"} & set(whole)


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aBcé İΣσßﬁ.,;'-\u0301\u0307文日1 \n<|endoftext>"), st.characters(
    codec="utf-8")), max_size=24))
def test_encoder_equals_the_tokenizer_on_random_text(text):
    tok, enc = _TOK, packing.encoder(PATH)
    want = tok.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(enc.encode(text), np.uint32).tolist() == want


@pytest.mark.parametrize("counts, capacity", [
    ({10: 3, 7: 5, 3: 9, 1: 4}, 10), ({6: 4, 5: 4, 4: 4, 3: 4}, 10), ({4096: 2, 5: 1}, 4096), ({}, 8), ({1: 1}, 8)])
def test_plan_packs_every_length_once(counts, capacity):
    bins = packing.plan_bins(counts, capacity)
    total = Counter()
    for n, items in bins:
        assert n > 0 and sum(a * b for a, b in items) <= capacity
        for length, copies in items:
            total[length] += n * copies
    assert total == Counter(counts)


def test_plan_replaces_the_shortest_by_two():
    # greedy makes 6+3 of 10; best-two-fit swaps the 3 for 2+2
    assert packing.plan_bins({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [(6, 1), (2, 2)])


def test_pack_is_gapless_and_exact(spark):
    out = packing.pack(docs(spark, TEXTS), PATH, capacity=64).collect()
    tok = Tokenizer.from_file(PATH)
    want = {}
    for i, text in enumerate(TEXTS):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at:at + 64]
            want[i, k] = (at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out} == want
    assert len(out) == len(want)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= 1 + sum(r.length for r in out) * 1.05 / 64


def test_pack_of_an_empty_table(spark):
    assert packing.pack(docs(spark, []), PATH).collect() == []
