"""Edit matching against plain dynamic programming; the vote model on votes with known accuracies."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from govlens.llm import decontam, quality


def plain_distance(p, t):
    """The least edit distance of p to a part of t."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, x in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("ab c", min_size=1, max_size=90), st.text("ab c", max_size=60))
def test_myers(p, t):
    d, end = decontam.myers(decontam.bits_of(p), len(p), t)
    assert d == plain_distance(p, t)
    assert plain_distance(p, t[:end]) == d


def edited(rng, text, n, letters):
    q = list(text)
    for _ in range(n):
        i, o = rng.randrange(len(q)), rng.random()
        if o < 0.4:
            q[i] = rng.choice(letters)
        elif o < 0.7 and len(q) > 1:
            del q[i]
        else:
            q.insert(i, rng.choice(letters))
    return "".join(q)


@pytest.mark.parametrize("letters", ["abc ", "abcdefghijkl  "])
def test_no_passage_within_the_budget_is_missed(letters):
    rng = random.Random(len(letters))
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    found = 0
    for _ in range(300):
        item = decontam.normalize(some(rng.randint(3, 60)))
        if not item.strip():
            continue
        text = some(30) + " " + edited(rng, item, rng.randint(0, 9), letters) + " " + some(30)
        got = decontam.Matcher([(1, item)], 0.2).find(text)
        t = decontam.normalize(text)
        want, budget = plain_distance(item, t), decontam.Item(1, item, 0.2).budget
        assert bool(got) == (want <= budget)
        if got:
            found += 1
            (_, d, start, end), = got
            assert want <= d <= budget and plain_distance(item, t[start:end]) <= d
    assert found > 50


def test_pieces_are_one_more_than_the_budget():
    for n in (10, 57, 233, 400):
        item = decontam.Item(0, " " + "x" * n + " ", 0.1)
        pieces = item.root.pieces()
        assert len(pieces) == item.budget + 1 == n // 10 + 1
        assert pieces[0].start == 0 and pieces[-1].end == n + 2
        assert all(a.end == b.start and a.end > a.start for a, b in zip(pieces, pieces[1:]))


ITEM = "The quick brown fox jumps over the lazy dog, and then it sleeps for a very long time in the sun."


def test_contamination(spark, make, clash):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, " -- "), (4, "yes"), (5, ITEM), (None, "some other passage of words")], "item_id long, text string") \
        .withColumnRenamed("x", "x")
    near = ITEM.replace("brown", "brwon").replace("\n", " ").upper()
    rows = [(1, f"before. {ITEM} after"), (2, "x " * 30000 + near + " y" * 30000), (3, None), (4, ""), (5, "clean words only"), (6, "yesterday"), (7, "Oh, yes!"),
            (8, ITEM[:50]), (1, f"before. {ITEM} after"), (None, "some other, passage of WORDS")]
    want = sorted([("1", [1, 5]), ("1", [1, 5]), ("2", [1, 5]), ("3", []), ("4", []), ("5", []), ("6", []), ("7", [4]), ("8", []), ("None", [None])], key=str)
    for docs in (make(rows), clash(make(rows))):
        for block in (4_000_000, 60):                       # one block of items, or one for each
            out = decontam.contamination(docs, items, block_chars=block)
            assert out.columns == [*docs.columns, "_hits"]
            assert sorted(((str(r.doc_id), sorted((h["item"] for h in r._hits), key=str)) for r in out.collect()), key=str) == want
    assert decontam.contamination(make([]), items).count() == 0
    assert all(r._hits == [] for r in decontam.contamination(make(rows), items.limit(0)).collect())


def test_vote_model_finds_accuracies():
    rng = np.random.default_rng(1)
    n, found, false = 40_000, np.array([0.9, 0.8, 0.7]), np.array([0.01, 0.002, 0.02])
    kind = rng.choice(4, n, p=[0.85, 0.05, 0.05, 0.05])
    against = rng.random((n, 3)) < np.where(kind[:, None] == np.arange(1, 4), found, false)
    votes = np.where(rng.random((n, 3)) < 0.2, quality.ABSTAIN, np.where(against, quality.BAD, quality.GOOD))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    m = quality.VoteModel.fit(list("abc"), patterns, counts)
    assert abs(m.shares[0] - 0.85) < 0.08 and (np.abs(m.against[0] - false) < 0.02).all()
    assert all(x is not None and x > 0.7 for x in m.accuracy().values())
    good = m.posterior(patterns)
    for p, g in zip(patterns, good, strict=True):
        assert (g < 0.5) == (quality.BAD in p) or quality.GOOD not in p or (p == quality.BAD).sum() == 1
    assert quality.VoteModel.fit(["a"], np.array([[2]]), np.array([5])).posterior(np.array([[2]]))[0] > 0.5


def quality_docs(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 9)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(6, 120))]
        words[0] = words[0].capitalize()
        text, bad = ". ".join(" ".join(words[j:j + 9]) for j in range(0, len(words), 9)) + ".", rng.random() < 0.25
        if bad:
            text = rng.choice([lambda: " ".join(w + rng.choice(["%%%", "###", "$$$"]) for w in words), lambda: "!! ".join(words).upper() + "!!",
                               lambda: " | ".join(words), lambda: " ".join(words[:4] * 30)])()
        rows.append((i, text, bad))
    return rows


def test_held_out_quality(spark, make, clash):
    train, test = quality_docs(600, 1), quality_docs(400, 2)
    fitted = quality.train(make([r[:2] for r in train]))
    docs = clash(make([r[:2] for r in test] + [(9001, None), (9002, ""), (9003, "w " * 60000), (0, test[0][1])]))
    got = quality.classify(docs, fitted)
    assert got.columns == [*docs.columns, "_quality", "_posterior", "_keep"]
    out = {r.doc_id: r for r in got.collect()}
    good = [i for i, _, bad in test if not bad]
    bad = [i for i, _, bad in test if bad]
    assert np.mean([out[i]._keep for i in good]) >= 0.98 and np.mean([not out[i]._keep for i in bad]) >= 0.9
    assert all(0 <= r._quality <= 1 and 0 <= r._posterior <= 1 for r in out.values()) and not out[9003]._keep
    assert quality.train(make([])) is None and quality.classify(make([]), None).count() == 0
    assert quality.classify(make([]), fitted).count() == 0
