"""Packing: exact token ids, and a valid and tight packing."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from govlens.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    tok = Tokenizer.from_file(PATH)
    return lambda t: tok.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ab'sté.,É%0 \n\t\x1c\x85 ́ßΣ!"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=3))
def test_word_tokenizer_is_the_tokenizer(texts):
    tok = Tokenizer.from_file(PATH)
    got = packing.WordTokenizer(PATH).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_names_and_long_words(whole):
    texts = ["a<|endoftext|>b <|startoftext|>", "x" * 5000 + " y", "Don't I'LL we've", ""]
    tok = packing.WordTokenizer(PATH)
    for _ in range(2):
        assert [np.frombuffer(g, "<u4").tolist() for g in tok.encode(texts)] == [whole(t) for t in texts]


@pytest.mark.parametrize("capacity,n,seed", [(8, 50, 1), (16, 400, 2), (64, 3000, 3), (4096, 5000, 4)])
def test_plan(capacity, n, seed):
    rng = random.Random(seed)
    counts = Counter(max(1, min(capacity, int(rng.lognormvariate(np.log(capacity / 8), 1)))) for _ in range(n))
    plan = packing.plan(dict(counts), capacity)
    used = Counter()
    for m, lengths in plan:
        assert m > 0 and sum(lengths) <= capacity
        for x in lengths:
            used[x] += m
    assert used == counts
    least = -(-sum(k * v for k, v in counts.items()) // capacity)
    assert sum(m for m, _ in plan) <= max(least + 2, 1.02 * least)


def test_plan_uses_exact_combinations_and_is_quick_at_any_count():
    assert packing.plan({10: 3}, 10) == [(3, (10,))]
    assert packing.plan({7: 2, 3: 2}, 10) == [(2, (7, 3))]
    assert packing.plan({6: 5, 3: 5, 1: 5}, 10) == [(5, (6, 3, 1))]
    assert packing.plan({5: 1, 3: 1, 1: 2}, 10) == [(1, (5, 3, 1, 1))]
    assert packing.plan({}, 10) == []
    many = {k: 10**9 + k for k in range(1, 4097, 7)}
    plan = packing.plan(many, 4096)
    assert len(plan) < 20_000 and sum(m * sum(x) for m, x in plan) == sum(k * v for k, v in many.items())
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


def test_pack_documents(spark, make, whole):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(60)] + [(60, None), (61, ""), (62, "word " * 700), (3, "again"), (3, "again"), (None, "no id")]
    out = packing.pack(make(rows), capacity=64, keep_ids=True).collect()
    seen = Counter()
    for r in out:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.length == len(r.ids) and r.start == 64 * r.piece
    docs = {}
    for r in sorted(out, key=lambda r: r.piece):
        docs.setdefault((r.doc_id, r.sequence_id, r.offset) if r.doc_id in (3, None) else r.doc_id, []).extend(r.ids)
    want = Counter((i, tuple(whole(t or "") + [1])) for i, t in rows)
    for k, ids in docs.items():
        seen[k[0] if isinstance(k, tuple) else k, tuple(ids)] += 1
    assert seen == want
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(make([])).count() == 0
