"""The registered queries on small tables: their columns and types, and what the contracts say of single rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from govlens.llm import packing, quality, queries, vectors, warc
from tests.llm.test_near_dups import plain_fingerprint

ITEM = "the quick brown fox jumps over the lazy dog and then it sleeps for a very long time"
ROWS = [(1, "Some words. And a few more words of text.\nSecond line"), (2, "Some words. And a few more words of text.\nSecond line"),
        (3, None), (4, ""), (5, f"before {ITEM} after"), (None, "no id at all here"), (6, "word " * 5000), (6, "word " * 5000), (7, "§ 12 \t|")]


@pytest.fixture(scope="module")
def tables(spark, make, clash, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = clash(make(ROWS)).withColumn("piece", F.lit("x")).withColumn("fingerprint", F.lit(1)).withColumn("_hits", F.lit(2)) \
        .withColumn("quality", F.lit("x")).withColumn("length", F.lit(0))
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(10, ITEM), (11, None), (12, "?!")], "item_id long, text string").withColumn("_block", F.lit("x")) \
        .write.parquet(f"{d}/benchmark.parquet")
    return d


def test_op2(spark, tables):
    out = queries.REGISTRY["op2_best_fit_packing"][0](spark, tables)
    assert out.dtypes == [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"),
                          ("sequence_id", "bigint"), ("offset", "bigint")]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in ROWS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for p, s in enumerate(range(0, len(ids), 4096)):
            part = ids[s:s + 4096]
            want.append((i, p, s, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    rows = out.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


@pytest.mark.parametrize("rows", [1, 3, 1_000])
def test_a_common_length_is_ranked_in_parts(spark, monkeypatch, rows):
    """Places don't collide, however many parts a length has."""
    monkeypatch.setattr(packing, "RANK_ROWS", rows)
    pieces = spark.createDataFrame([(i, i * 7, 0, 3 if i < 40 else 5) for i in range(55)], "_k1 long, _k2 long, piece int, length long").cache()
    out = packing.place(pieces, 16).collect()
    taken = sorted((r.sequence_id, r.offset + k) for r in out for k in range(r.length))
    assert len(out) == 55 and len(set(taken)) == len(taken) == 40 * 3 + 15 * 5
    assert max(r.offset + r.length for r in out) <= 16 and len({r.sequence_id for r in out}) <= -(-len(taken) // 16) + 1


def test_op4(spark, tables):
    out = queries.REGISTRY["op4_simhash_near_dedup"][0](spark, tables)
    assert out.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    rows = out.collect()
    by = {i: plain_fingerprint(t) for i, t in ROWS}
    assert sorted((r.doc_id, r.fingerprint) for r in rows if r.doc_id is not None) == sorted(
        (i, f"{by[i]:016x}") for i, _ in ROWS if i is not None)
    for r in rows:
        near = [i for i, f in by.items() if i is not None and (f ^ by[r.doc_id]).bit_count() <= 3]
        assert r.component_id == (min(near) if near else None)
    assert {r.doc_id: r.fingerprint for r in rows}[4] == "0" * 16


def test_op9(spark, tables):
    out = queries.REGISTRY["op9_benchmark_decontamination"][0](spark, tables)
    assert out.dtypes == [("doc_id", "bigint"), ("item_id", "bigint"), ("distance", "int"), ("start", "int"), ("end", "int")]
    (r,) = out.collect()
    assert (r.doc_id, r.item_id, r.distance) == (5, 10, 0)


def test_op10(spark, tables):
    out = queries.REGISTRY["op10_quality_classifier"][0](spark, tables)
    assert out.dtypes == [("doc_id", "bigint"), ("quality", "double"), ("posterior", "double"), ("keep", "boolean")]
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.quality <= 1 and r.keep == (r.quality >= 0.5) for r in rows)
    assert len({(r.quality, r.posterior) for r in rows if r.doc_id in (1, 2)}) == 1


def plain_em(patterns, counts, rounds):
    """The estimates, one number at a time."""
    k, m = len(patterns), len(patterns[0])
    by = []
    for p in patterns:
        w = [(1.0 if 0 not in p else 0.0) + 0.01] + [(1.0 if v == 0 else 0.0) + 0.01 for v in p]
        by.append([x / sum(w) for x in w])
    for _ in range(rounds):
        against = [[(sum(by[i][c] * counts[i] for i in range(k) if patterns[i][j] == 0) + 0.1)
                    / (sum(by[i][c] * counts[i] for i in range(k) if patterns[i][j] != 2) + 0.2) for j in range(m)] for c in range(m + 1)]
        for j in range(m):
            against[0][j] = min(against[0][j], quality.MOST_FALSE)
            against[j + 1][j] = max(against[j + 1][j], quality.LEAST_FOUND)
        shares = [(sum(by[i][c] * counts[i] for i in range(k)) + 0.1) / (sum(counts) + 0.1 * (m + 1)) for c in range(m + 1)]
        by = []
        for p in patterns:
            w = list(shares)
            for c in range(m + 1):
                for j, v in enumerate(p):
                    w[c] *= 1 if v == 2 else against[c][j] if v == 0 else 1 - against[c][j]
            by.append([x / sum(w) for x in w])
    return against, shares, [x[0] for x in by]


def test_estimates_against_a_plain_version():
    rng = np.random.default_rng(2)
    kind = rng.choice(4, 3000, p=[0.8, 0.1, 0.06, 0.04])
    against = rng.random((3000, 3)) < np.where(kind[:, None] == [1, 2, 3], [0.9, 0.8, 0.7], 0.02)
    votes = np.where(rng.random((3000, 3)) < 0.15, 2, np.where(against, 0, 1))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    m = quality.VoteModel.fit(list("abc"), patterns, counts, rounds=7)
    a, s, good = plain_em(patterns.tolist(), counts.tolist(), 7)
    assert np.allclose(m.against, a) and np.allclose(m.shares, s) and np.allclose(m.posterior(patterns), good, atol=1e-6)


def test_bounds_are_not_told_as_estimates():
    votes = np.array([[1, 1], [0, 1], [0, 2]])                   # the second heuristic never finds its fault
    m = quality.VoteModel.fit(["a", "b"], votes, np.array([1000, 80, 20]))
    assert m.accuracy()["a"] > 0.7 and m.accuracy()["b"] is None


def test_the_scorer_sees_words_and_tabs(spark, make):
    """Documents of ordinary shapes whose words go with a fault are told by their words."""
    figures, found = quality.Reader(hashes=True).read(["one two two", "a\tb\tc\td e"])
    assert len(found[0][2]) == 2 and sorted(found[0][3].tolist()) == [1, 2]
    assert figures[1][3] == 3 / 5 and quality.votes_of(figures)[1][quality.LABELLERS.index("bars")] == quality.BAD
    long = "aA" * 40
    shapes = quality.Reader()
    shapes.read([long, long + "1"])
    assert len(shapes.shapes()) == 2                              # no shape is cut
    rng = np.random.default_rng(3)
    clean, junk = [f"clean{i}" for i in range(40)], [f"junk{i}" for i in range(40)]
    text = lambda words, mark: " ".join(w + mark for w in rng.choice(words, 40)) + "."
    train = [(i, text(clean, "")) for i in range(150)] + [(200 + i, text(junk, "%%%")) for i in range(50)] \
        + [(300 + i, text(junk, "%%% ") + text(junk, "")) for i in range(50)]
    fitted = quality.train(make(train))
    out = {r.doc_id: r._quality for r in quality.classify(make([(1, text(clean, "")), (2, text(junk, ""))]), fitted).collect()}
    assert out[1] > 0.5 and out[2] < out[1]


def test_clashing_names_elsewhere(spark, make, clash):
    docs = clash(make(ROWS))
    assert packing.pack(docs).count() == packing.pack(make(ROWS)).count()
    v = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [1.0, 0.01]), (3, "b", [1.0, 0.0]), (4, "a", None)], "vec_id long, label string, embedding array<double>")
    more = v.select("*", *[F.lit("x").alias(c) for c in ("id", "grp", "vec", "_k1", "n", "component", "block", "part", "key")])
    want = sorted(map(tuple, vectors.near_vectors(v).collect()))
    assert sorted(map(tuple, vectors.near_vectors(more).collect())) == want == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4)]


def test_archive_with_clashing_names(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "same"), (2, "v", "same"), (3, None, None)], "page_id long, url string, html string") \
        .select("*", *[F.lit("x").alias(c) for c in ("payload", "sha256", "d", "owner", "packed", "header", "record", "p")])
    warc.write_archive(pages, str(tmp_path / "a"))
    got = sorted((r.page_id, r.type, r.refers_to, r.n_bytes) for r in warc.resolve(spark, str(tmp_path / "a")).collect())
    assert got == [(1, "revisit", 2, 4), (2, "response", None, 4), (3, "response", None, 0)]
