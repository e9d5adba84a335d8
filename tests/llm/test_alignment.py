"""Cross-tokenizer alignment: groups, links and counts against a plain version; the monoid's laws; ranges of long texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from govlens.llm import alignment, queries

A_PATH, B_PATH = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
TOOL = alignment.Aligner(A_PATH, B_PATH)
OWN = alignment.byte_table()
TEXTS = st.text(st.one_of(st.sampled_from("abe .'\n\t\r<|é日　  ᠎\x1c\x85 ́😀0"), st.characters(exclude_categories=["Cs"])), max_size=60)


def plain_groups(text):
    """Groups by both tokenizers over the whole text; none where bytes differ."""
    if not text:
        return []
    data = (" " + text).encode()
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    x = [bytes(OWN[c] for c in A.id_to_token(i)) for i in a]
    y = [bytes([int(B.id_to_piece(i)[3:-1], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(x) != data or b"".join(y) != data:
        return []
    ends_a, ends_b = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
    out, low = [], 0
    for e in sorted(set(ends_a) & set(ends_b)):
        out.append(([i for i, k in zip(a, ends_a) if low < k <= e], [i for i, k in zip(b, ends_b) if low < k <= e]))
        low = e
    return out


def written_out(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def plain(rows):
    found = [(i, plain_groups(t)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in found]
    count = Counter(p for c in links for p in c)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    return [(i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
             sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
             hashlib.sha256(written_out(g).encode()).hexdigest() if g else "") for (i, g), c in zip(found, links)], count


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words_give_the_groups_of_the_whole_text(text):
    words = TOOL.split(" " + text)
    assert "".join(words) == " " + text
    TOOL.learn(words)
    got = TOOL.closed([words])[0]
    assert ("" if got is None else got.text.decode()) == (written_out(plain_groups(text)) if text else got.text.decode())


@settings(max_examples=200, deadline=None)
@given(TEXTS.filter(lambda t: t and "▁" not in t), st.integers(1, 40), st.randoms())
def test_ranges_compose_in_any_order(text, size, rng):
    parts = alignment.ranges(" " + text, size, TOOL.cutter)
    assert parts[0][0] == 0 and parts[-1][1] == len((" " + text).encode())
    fragments = [TOOL.between(TOOL.split(c), base, low, high) for low, high, base, c in parts]
    if None in fragments:
        assert not plain_groups(text)
        return
    fragments.insert(rng.randrange(len(fragments) + 1), alignment.Fragment())            # the neutral one
    while len(fragments) > 1:
        k = rng.randrange(len(fragments) - 1)
        fragments[k:k + 2] = [fragments[k] + fragments[k + 1]]
    got, want = fragments[0].whole(), alignment.groups(plain_groups(text))
    assert got[:5] == want[:5] and got.keys.tolist() == want.keys.tolist() and got.times.tolist() == want.times.tolist()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10 ** 9), st.integers(1, 25))
def test_any_cut_of_tokens_composes(seed, size):
    """Ranges may end within tokens and groups."""
    rng = random.Random(seed)
    total = 60
    ends = [sorted(rng.sample(range(1, total), rng.randrange(1, 30))) + [total] for _ in range(2)]
    tokens = (list(range(len(ends[0]))), ends[0], list(range(len(ends[1]))), ends[1])
    out = alignment.Fragment()
    for low in range(0, total, size):
        out += alignment.fragment(tokens, low, min(low + size, total))
    want = alignment.fragment(tokens, 0, total).whole()
    assert out.whole()[:5] == want[:5] and out.whole().keys.tolist() == want.keys.tolist()


def test_texts_are_cut():
    """Nearly every word is a stretch of its own."""
    words = TOOL.split(" Some words here,\nand there\tit's  fine\r\nso.")
    assert words == [" Some", " words", " here", ",", "\nand", " there", "\tit", "'s", "  fine\r\nso", "."]


def test_a_long_run_is_in_one_range():
    text = " a b" + "x" * 500 + " c d" * 20
    parts = alignment.ranges(text, 16, TOOL.cutter)
    assert all(len(c) < 600 for *_, c in parts) and sum(len(c) for *_, c in parts) < 4 * len(text)
    assert [p[1] for p in parts[:-1]] == [p[0] for p in parts[1:]]
    assert len(alignment.ranges("x" * 100_000, 64, TOOL.cutter)) == 1


ROWS = [(1, "Hello world, it's a test.\nNext line"), (1, "Hello world, it's a test.\nNext line"), (2, None), (3, ""), (4, " "), (5, "a▁b"),
        (None, "The <|endoftext|> and <s> stay text"), (6, "日本語 and 😀 more  spaces\t\t\n\nend "), (7, "the the the The"),
        (8, "word. " * 400 + "x" * 700 + " tail" * 300), (9, "x" * 2000), (10, "un▁ " * 500), (11, "\0"), (12, "é" * 900 + "\n" + "Ünï " * 300)]


@pytest.mark.parametrize("size", [1 << 16, 300, 64])
def test_documents_and_links(spark, make, clash, size):
    docs = clash(make(ROWS)).withColumn("n_a", F.lit("x")).withColumn("row", F.lit(0))
    got, links = alignment.align(docs, range_bytes=size, keep_groups=True)
    want, count = plain(ROWS)
    rows = got.collect()
    assert sorted((tuple(r)[:8] for r in rows), key=repr) == sorted(want, key=repr)
    assert sorted(r.groups for r in rows) == sorted(written_out(plain_groups(t)) for _, t in ROWS)
    assert {(r.a_id, r.b_id): r.documents for r in links.collect()} == dict(count)


def test_query(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(alignment, "_BLOCK_DOCS", 3)
    make(ROWS).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.REGISTRY["op13_tokenizer_alignment"][0](spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint")] + [(c, "bigint") for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] \
        + [("groups_sha256", "string")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(plain(ROWS)[0], key=repr)


def test_empty(spark, make):
    got, links = alignment.align(make([]).limit(0))
    assert got.count() == 0 and links.count() == 0


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(alignment, "_CACHE_WORDS", 3)
    for text in ["a b c d e f", "a b", "g h i j"] * 2:
        words = TOOL.split(" " + text)
        TOOL.learn(words)
        assert TOOL.closed([words])[0].text.decode() == written_out(plain_groups(text))
