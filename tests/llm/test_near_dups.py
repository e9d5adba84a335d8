"""SimHash, components and embeddings against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from govlens.llm import simhash, vectors
from govlens.llm.components import connected_components


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    star = [(0, i) for i in range(1, 300)]
    pairs = chain + star + [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)] + [(5, 5), (7000, 7000)]
    nodes = {n for p in pairs for n in p}
    df = spark.createDataFrame(pairs + [(None, 4), (3, None)] + pairs[:20], "a long, b long").repartition(5)
    assert {r.node: r.component for r in connected_components(df).collect()} == roots(pairs, nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    s = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \t", "One", "one two", "A b c d", "é É x y z", "a b c a b c a b c", "w " * 70000, "x" * 100000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_connect_exactly(spark, bits):
    rng = random.Random(bits)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for center in list(prints)[:12]:                        # chains and dense balls, also across the halves
        x = center
        for _ in range(12):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
            prints.add(x)
        prints |= {center ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(10)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    near = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) % (1 << 64)).bit_count() <= bits]
    df = spark.createDataFrame([(p,) for p in signed], "f long")
    got = {r.f: r.component for r in simhash.fingerprint_components(df, bits).collect()}
    want = roots(near, signed)
    linked = {n for p in near for n in p}
    assert got == {n: want[n] for n in linked}


def test_groups_and_keep(spark, make, clash):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base), (3, base), (3, base), (9, base.upper()), (1, "other words here now"), (2, None), (7, ""), (8, " \n"), (None, base), (None, "alone is null"), (None, "alone is null")]
    for docs in (make(rows), clash(make(rows))):
        g = simhash.simhash_groups(docs)
        got = sorted(((str(r.id), r.component) for r in g.collect()), key=str)
        assert got == sorted([("5", 3), ("3", 3), ("3", 3), ("9", 3), ("1", 1), ("2", 2), ("7", 2), ("8", 2), ("None", 3), ("None", None), ("None", None)], key=str)
        kept = simhash.keep_one(docs, g)
        assert kept.columns == docs.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "None"]
    assert simhash.simhash_groups(make([])).count() == 0


def brute(rows, threshold=0.98):
    def fit(v, label):
        return label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ids = [r[0] for r in rows]
    links = []
    for i, (_, v, la) in enumerate(rows):
        for j, (_, w, lb) in enumerate(rows[:i]):
            if fit(v, la) and fit(w, lb) and la == lb and len(v) == len(w):
                a, b = np.array(v, dtype=float), np.array(w, dtype=float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    links.append((ids[i], ids[j]))
    n = {x: sum(x in p for p in links) for x in ids}
    r = roots(links, ids)
    return sorted((x, n[x], r[x]) for x in ids)


def vec_rows(seed, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (1, 2):
        centers = rng.standard_normal((30, dim))
        for c in centers:
            for _ in range(rng.integers(1, 5)):
                rows.append((c + 0.03 * rng.standard_normal(dim)).astype(np.float32).tolist() + [label])
        dense = rng.standard_normal(dim)                   # many more than a window holds
        rows += [(dense + 0.01 * rng.standard_normal(dim)).astype(np.float32).tolist() + [label] for _ in range(60)]
        rows += [rows[0][:-1] + [label]] * 5               # equal vectors
    return [(i, r[:-1], r[-1]) for i, r in enumerate(rows)]


def test_vectors_against_brute_force(spark):
    nan, inf = float("nan"), float("inf")
    rows = vec_rows(4)
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 16, 1), (n + 3, [nan] + [1.0] * 15, 1), (n + 4, [inf] * 16, 1),
             (n + 5, [None] + [1.0] * 15, 1), (n + 6, rows[0][1], None), (n + 7, [1.0, 2.0], 1), (n + 8, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumnRenamed("x", "x").repartition(4)
    out = vectors.near_vectors(df, window=8)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows)


def test_vectors_recall_and_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(empty, passes=1).count() == 0
    out = vectors.near_vectors(spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (2, [1.0, 0.001], 1)],
                                                     "vec_id long, embedding array<float>, label int"), passes=1)
    assert sorted(((str(r.id), r.n_links, r.component) for r in out.collect()), key=str) == [("2", 2, 2), ("4", 2, 2), ("4", 2, 2), ("None", 0, None)]


def test_links_of_a_group_larger_than_partitions(spark):
    """A group of near copies that spans many range partitions, some of them smaller than the window."""
    rng = np.random.default_rng(11)
    dense = rng.standard_normal(16)
    rows = [(i, (dense + 0.05 * rng.standard_normal(16)).astype(np.float32).tolist(), 1) for i in range(600)]
    rows += [(600 + i, rng.standard_normal(16).astype(np.float32).tolist(), 1) for i in range(300)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(3)]
    want = brute(rows)
    assert max(n for _, n, _ in want) > 500
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("3", "24"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert sorted(tuple(r) for r in vectors.near_vectors(df, passes=4).collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_links_of_blocks_and_shared_ids(spark, monkeypatch):
    """Components cut into many blocks; ids with several vectors are one node."""
    monkeypatch.setattr(vectors, "BLOCK_ROWS", (8, 16))
    rng = np.random.default_rng(12)
    dense = rng.standard_normal(16)
    rows = [(i, (dense + 0.05 * rng.standard_normal(16)).astype(np.float32).tolist(), 1) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(tuple(r) for r in vectors.near_vectors(df, passes=2).collect()) == brute(rows)
    shared = [(i % 90, v, la) for i, v, la in rows]
    x = np.array([v for _, v, _ in rows], dtype=float)
    hit = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T >= 0.98
    near = {i: {int(b) % 90 for a in (i, i + 90) if a < 100 for b in np.flatnonzero(hit[a])} - {i} for i in range(90)}
    want = sorted((i % 90, sum(1 + (k < 10) for k in near[i % 90])) for i, _, _ in rows)
    out = vectors.near_vectors(spark.createDataFrame(shared, df.schema), passes=2).collect()
    assert sorted((r.id, r.n_links) for r in out) == want


def test_blocks_far_apart_or_close_are_not_multiplied(spark, monkeypatch):
    """A chain of tight clusters: most block pairs are settled by their centres, and the counts stay exact."""
    monkeypatch.setattr(vectors, "BLOCK_ROWS", (8, 8))
    rng = np.random.default_rng(14)
    rows, i = [], 0
    for step in range(14):                                       # neighbours in the chain link, others don't
        a = step * 0.16
        for _ in range(16):
            v = np.array([np.cos(a), np.sin(a), 0, 0]) + 0.0005 * rng.standard_normal(4)
            rows.append((i, v.tolist(), 1))
            i += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    made = []
    real = vectors.written
    monkeypatch.setattr(vectors, "written", lambda df, name: (made.append((name, out := real(df, name))), out)[1])
    got = sorted(tuple(r) for r in vectors.near_vectors(df).collect())
    assert got == brute(rows)
    pairs = next(d for n, d in made if n == "block-pairs")
    how = {r.how: r.n for r in pairs.groupBy("how").agg(F.sum(F.col("rows_i") * F.col("rows_j")).alias("n")).collect()}
    assert how["none"] > how.get("multiply", 0) and how["all"] > 0


def test_passes_grow_with_the_label():
    assert vectors.passes_for(0) == vectors.passes_for(64) == 8
    few, some, many = (vectors.passes_for(n) for n in (5_000, 1_000_000, 100_000_000))
    assert 8 <= few < some < many < 60
