"""SentencePiece encoding: the library's ids, offsets and decoding, for any text."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from govlens.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TOOL = pieces.PieceEncoder(PATH)
TEXTS = st.text(st.one_of(st.sampled_from("ab e.'\n\t\r ▁<s>é日　 ́😀0"), st.characters(exclude_categories=["Cs"])), max_size=60)


def one(text):
    normal, align = TOOL.normalize(text)
    ids = np.frombuffer(TOOL.ids([normal])[0], dtype="<u4")
    return ids, *TOOL.spans(ids, align)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_spans_and_text_are_the_librarys(text):
    ids, begins, ends = one(text)
    assert ids.tolist() == LIBRARY.encode(text)
    # a character of several byte tokens is whole in the last of them there, and in parts here
    theirs = LIBRARY.encode(text, return_type="proto").pieces
    for p, b, e in zip(theirs, begins, ends, strict=True):
        if not LIBRARY.is_byte(p.id):
            assert (p.begin, p.end) == (b, e)
    data = text.encode()
    assert b"".join(data[b:e] for b, e in zip(begins, ends)) == data
    assert TOOL.decode([ids.tobytes()]) == [LIBRARY.decode(ids.tolist())]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix,squeeze", [(True, True), (False, True), (True, False)])
def test_compiled_maps(rule, prefix, squeeze):
    """Longest-prefix normalisation and its alignment against the library's own, for compiled maps."""
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=squeeze,
                                                   escape_whitespaces=True)
    spec = next(v for k, v in pieces.wire_fields(theirs.serialized_model_proto()) if k == 3)
    ours = pieces.Normalizer(spec)
    chars = "aAé ①Ａｶﾞｶ　 ́e\n\t가ﬁİΣ㌔😀﻿​"

    @settings(max_examples=150, deadline=None)
    @given(st.text(st.one_of(st.sampled_from(chars), st.characters(exclude_categories=["Cs"], exclude_characters="\0")), max_size=30))
    def same(text):
        normal, align = ours(text)
        want, offsets = theirs.normalize(text, with_offsets=True)
        assert normal == want
        starts = np.cumsum([0] + [len(c.encode()) for c in normal])
        at = {b: i for i, b in enumerate(np.cumsum([0] + [len(c.encode()) for c in text]).tolist())}
        if normal:
            assert [at[b] for b in align[starts].tolist()] == list(offsets)

    same()


ROWS = [(1, "Hello  world.\nNext line\t1,000 <s>"), (1, "Hello  world.\nNext line\t1,000 <s>"), (2, None), (3, ""), (4, " "), (None, "▁x ▁"),
        (5, "日本語 and more 😀"), (6, "x" * 30_000 + " " + "ab\n" * 30_000), (7, "\0a\0")]


def expected(i, text):
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    sha = lambda b: hashlib.sha256(b).hexdigest()       # noqa: E731
    return i, len(ids), sha(np.asarray(ids, dtype="<u4").tobytes()), sha(LIBRARY.decode(ids).encode())


def test_query(spark, make, clash, tmp_path):
    clash(make(ROWS)).withColumn("n_tokens", F.lit("x")).withColumn("ids", F.lit(0)).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.REGISTRY["op12_sentencepiece"][0](spark, str(tmp_path))
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string", "spans_crc32": "bigint"}
    got = sorted((tuple(r)[:4] for r in out.collect()), key=repr)
    assert got == sorted((expected(i, t) for i, t in ROWS), key=repr)


def test_spans_cover_texts(spark, make):
    for r in pieces.encode(make(ROWS[:6])).collect():
        text = {i: t for i, t in ROWS}[r.doc_id] or ""
        data = text.encode()
        assert b"".join(data[b:e] for b, e in zip(r.begins, r.ends)) == data
        assert r.ids[0] == 1 and r.ids[-1] == 2 and r.n_tokens == len(r.ids) == len(r.begins)
        assert r.decoded == LIBRARY.decode(LIBRARY.encode(text))


def test_empty(spark, make):
    assert pieces.encode(make([]).limit(0)).count() == 0


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_ENTRIES", 5)
    texts = ["a b c d", "e f g h i j", "a b c", "k " * 50 + "x" * 100]
    for t in texts * 2:
        assert one(t)[0].tolist() == LIBRARY.encode(t)
