"""Language ID: the model's probabilities, its table against models in memory, texts of any length, calibration, the query."""

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from govlens.llm import langid, queries
from govlens.llm.common import row_key

SCHEMA = "doc_id long, text string, lang string"
LANGS = {"aa": "the of and to in is that it was for on are with as his they be at one have this from".split(),
         "bb": "der die und den das von ist des sich mit dem dass er es ein ich auf so eine auch als an nach".split(),
         "cc": "les des est que une dans qui pour pas sur avec plus par ce il sont au ne se nous mais leur été".split()}


def language_docs(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(LANGS[k]) for _ in range(rng.randint(8, 40))).capitalize() + ".", k)
            for i, k in enumerate(rng.choice(list(LANGS)) for _ in range(n))]


def in_memory(grams, counts, order):
    """A language's model from n-grams with raw counts (full order, or at a word's begin) or continuation counts (others)."""
    size = np.array([len(g) for g in grams])
    counts = np.asarray(counts, dtype=np.float64)
    discount = np.zeros(order + 1)
    for k in range(1, order + 1):
        n1, n2 = ((counts[size == k] == c).sum() for c in (1, 2))
        discount[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    context, of = np.unique(langid.gram_hashes([g[:-1] for g in grams]), return_inverse=True)
    total, kinds = np.bincount(of, counts), np.bincount(of)
    depth = np.zeros(len(context), dtype=np.int64)
    depth[of] = size
    alpha = np.maximum(counts - discount[size], 0) / total[of]
    h = langid.gram_hashes(grams)
    by = np.argsort(h)
    return langid.LanguageModel(order, h[by], alpha[by].astype(np.float32), context,
                                (discount[depth] * kinds / total).astype(np.float32), 1 / (1 + int((size == 1).sum())))


def models_of(spark, rows, order=4):
    words = langid.word_counts(spark.createDataFrame(rows, SCHEMA), "lang", "text")
    grams = langid.gram_counts(words, order).toPandas()
    return {x: in_memory(g["gram"].to_list(), g["n"].to_numpy(), order) for x, g in grams.groupby("lang")}


def test_model_is_a_distribution():
    words = Counter(w for _, t, k in language_docs(60, 1) if k == "aa" for w in langid.words_of(t))
    raw, order = Counter(), 3
    for w, n in words.items():
        s = langid.BEGIN + w + langid.END
        for i in range(1, len(s)):
            for k in range(1, min(order, i + 1) + 1):
                raw[s[i + 1 - k:i + 1]] += n
    left = Counter(g[1:] for g in raw if len(g) > 1)
    grams = {g: n if len(g) == order or g[0] == langid.BEGIN else left[g] for g, n in raw.items()}
    m = in_memory(list(grams), np.array(list(grams.values())), order)
    letters = sorted({g for g in grams if len(g) == 1})

    def step(context, c):                                   # the interpolation, written out
        p = m.floor
        for k in range(1, order + 1):
            h = context[-(k - 1):] if k > 1 else ""
            if len(h) < k - 1:
                break
            total = sum(n for g, n in grams.items() if g[:-1] == h and len(g) == k)
            if total:
                sizes = [n for g, n in grams.items() if len(g) == k]
                n1, n2 = sizes.count(1), sizes.count(2)
                d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
                kinds = sum(1 for g in grams if g[:-1] == h and len(g) == k)
                p = max(grams.get(h + c, 0) - d, 0) / total + d * kinds / total * p
        return p
    # one share of the floor is for a character that was never seen
    assert sum(step(langid.BEGIN + "t", c) for c in letters) == pytest.approx(1, abs=0.06)
    for w in ("the", "that", "zzz"):
        want = sum(np.log2(step((langid.BEGIN + w)[:i + 1], c)) for i, c in enumerate(w + langid.END))
        assert m.log2([w])[0] == pytest.approx(want, rel=1e-4)


@pytest.mark.parametrize("piece", [4, 7, 100])
def test_words_of_any_length(spark, monkeypatch, piece):
    """Pieces carry the characters before them, so nothing depends on where a long word is parted."""
    rng = random.Random(4)
    long = "".join(rng.choice("abcdé") for _ in range(900))
    words = ["the", long, "a", long[:piece], long[:piece - 1], "x"]
    models = models_of(spark, [(1, "the of " + long, "aa"), (2, long[200:700], "aa")])
    counts = langid.gram_counts(langid.word_counts(spark.createDataFrame([(1, " ".join(words), "aa")], SCHEMA), "lang", "text"), 4)
    whole, n_whole = models["aa"].log2(words), {r.gram: r.n for r in counts.collect()}
    monkeypatch.setattr(langid, "_PIECE_CHARS", piece)
    monkeypatch.setattr(langid, "_SLICE_CHARS", 50)
    assert np.allclose(models["aa"].log2(words), whole)
    again = langid.gram_counts(langid.word_counts(spark.createDataFrame([(1, " ".join(words), "aa")], SCHEMA), "lang", "text"), 4)
    assert {r.gram: r.n for r in again.collect()} == n_whole


def test_hashes_asked_for_are_those_looked_up(monkeypatch):
    monkeypatch.setattr(langid, "_PIECE_CHARS", 9)
    monkeypatch.setattr(langid, "_SLICE_CHARS", 30)
    words = ["the", "ab", "x" * 40, "été", "abcdefgh", "abcdefghi"]
    wanted = {int(h) for w in langid.slices(words, 4) for d in w.distinct for h in d}
    assert langid.distinct_hashes(words, 4).tolist() == sorted(wanted)
    assert langid.unpacked(langid.packed(np.array([0, 5, 70_000, 2 ** 32 - 1]))).tolist() == [0, 5, 70_000, 2 ** 32 - 1]
    assert langid.unpacked(langid.packed(np.array([], dtype=int))).tolist() == []


def test_the_table_scores_as_whole_models_do(spark, monkeypatch):
    """More n-grams than any block has; blocks of three documents get what they ask for."""
    rng = np.random.default_rng(8)
    letters = rng.integers(0x4E00, 0x4E00 + 900, (16, 300, 6))
    rows = [(i, " ".join("".join(map(chr, w)) for w in doc), "zz") for i, doc in enumerate(letters.tolist())]
    rows += [(100 + i, t, k) for i, t, k in language_docs(60, 9)]
    want = models_of(spark, rows)
    monkeypatch.setattr(langid, "_BLOCK_DOCS", 3)
    model = langid.fitted(langid.gram_counts(langid.word_counts(spark.createDataFrame(rows, SCHEMA), "lang", "text"), 4), 4)
    assert model.langs == sorted(want) and model.floors == [want[x].floor for x in model.langs]
    stored = sum(r.n for r in model.table.select(F.size("codes").alias("n")).collect())
    assert stored == sum(len(m.grams) + len(m.contexts) for m in want.values())
    texts = [rows[3][1], rows[-1][1], rows[-1][1], None, "", "12 %", "ыфв unknown", "the the of", "²"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    keyed = docs.select(*row_key("doc_id"), "doc_id", F.col("text").alias("_text")).cache()
    got = {r.doc_id: r for r in langid.scored(keyed.drop("doc_id"), model).join(keyed.drop("_text"), ["_k1", "_k2"]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = langid.words_of(t)
        some = any(map(str.isalpha, words))
        assert got[i].chars == (sum(len(w) + 1 for w in words) if some else 0)
        assert np.allclose(got[i].bits, [-want[x].log2(words).sum() if some else 0.0 for x in model.langs], rtol=1e-6)


def test_held_out_accuracy_and_rejection(spark):
    train = spark.createDataFrame(language_docs(300, 2) + [(900, None, "aa"), (901, "the of", None), (902, "", "bb"), (903, "12 %", "cc")], SCHEMA).repartition(3)
    model = langid.train(train)
    assert model.langs == ["aa", "bb", "cc"]
    rows = [(i + 1000, t, k) for i, t, k in language_docs(200, 3)]
    odd = [(1, None, "x"), (2, "", "x"), (3, "12 + 3 = 15 %%", "x"), (4, "ыфв жйцъ щшгн эюя " * 20, "x"), (5, "the " * 30000, "aa"), (6, "²½", "x"),
           (7, "xq zvk jjq wxz qqk " * 20, "x")]
    out = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows + odd, SCHEMA), model).collect()}
    right = [out[i]._lang_pred == k for i, _, k in rows]
    assert np.mean(right) >= 0.99
    assert np.mean([out[i]._rejected for i, _, _ in rows]) <= 0.01        # clean documents stay
    assert all(0 <= r._score <= 1 for r in out.values())
    for i in (1, 2, 3, 6):
        assert (out[i]._lang_pred, out[i]._score, out[i]._rejected) == ("und", 0.0, True)
    for i in (4, 7):                                                      # junk that a model must choose a language for
        assert out[i]._rejected and out[i]._lang_pred in model.langs
        assert out[i]._cross_entropy > 1.5 * np.median([out[j]._cross_entropy for j, _, _ in rows])
    assert out[5]._lang_pred == "aa"
    assert langid.identify(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_every_language_has_its_own_limit(spark):
    """Calibration takes about as many rows of each language, so a rare one is calibrated too."""
    common = [r for r in language_docs(900, 10) if r[2] != "aa"]
    rare = [r for r in language_docs(30, 11) if r[2] == "aa"][:6]
    model = langid.train(spark.createDataFrame(common + rare, SCHEMA), calibration_rows=20)
    assert np.isfinite(model.limits).all() and (model.usual > 0).all()
    docs = spark.createDataFrame(common + rare + rare, SCHEMA)
    n = Counter(r.lang for r in langid.hashed_rows(docs, "lang", ["lang", "text"], 20).collect())
    assert 5 <= n["bb"] <= 45 and 5 <= n["cc"] <= 45 and n["aa"] == len({t for _, t, _ in rare})
    junk = spark.createDataFrame([(1, "xq zvk jjq " * 30, "x")], SCHEMA)
    assert langid.identify(junk, model).first()._rejected


def test_calibration_reads_all_rows(spark):
    """One odd row of 3,000 raises its language's limit, wherever its hash falls; a bound of rows is what a caller asks for."""
    docs = [(i, f"{t} {i}", "aa" if k == "aa" else "bb") for i, t, k in language_docs(3000, 12)]
    frame = spark.createDataFrame(docs, SCHEMA)
    model = langid.learn(frame)
    rows = frame.select("lang", F.col("text").alias("_text"), *row_key("lang", "text"))
    seen = langid.scored(rows.drop("lang"), model).join(rows.drop("_text"), ["_k1", "_k2"])
    want = seen.toPandas()
    langid.calibrate(model, seen)
    bits, chars, truth = np.stack(want["bits"]), want["chars"].to_numpy(), want["lang"].map(model.langs.index).to_numpy()
    every = np.arange(len(want))
    usual = np.array([np.median((bits[every, truth] / chars)[truth == k]) for k in range(2)])
    steady = (bits + 50 * usual) / (chars[:, None] + 50)
    assert np.allclose(model.usual, usual)
    assert np.allclose(model.limits, [1.5 * np.quantile(steady[truth == k, k], 0.999) for k in range(2)])

    def loss(t):
        z = -t * (bits - bits.min(axis=1, keepdims=True))
        return -(z[every, truth] - np.log2(np.exp2(z).sum(axis=1))).mean()
    assert loss(model.temperature) <= min(map(loss, langid.TEMPERATURES)) + 1e-12
    whole = langid.train(frame)
    assert np.allclose(whole.limits, model.limits) and whole.temperature == model.temperature
    again = langid.learn(frame)
    langid.identify(frame, again, taught=F.lit(True)).count()
    assert np.allclose(again.limits, model.limits) and again.temperature == model.temperature


def test_nothing_to_learn_from(spark):
    model = langid.train(spark.createDataFrame([], SCHEMA))
    out = langid.identify(spark.createDataFrame([(1, "words")], "doc_id long, text string"), model).first()
    assert (out._lang_pred, out._score, out._rejected) == ("und", 0.0, True)


def test_clashing_columns_repeats_and_ties(spark, clash):
    train = spark.createDataFrame([(i, t, k) for i, t, k in language_docs(90, 5)], SCHEMA)
    twins = train.union(train.where("lang = 'aa'").withColumn("lang", F.lit("ab")))      # two languages of one text
    model = langid.train(clash(twins))
    docs = clash(spark.createDataFrame([(1, "the of and", "q"), (1, "the of and", "q"), (None, "der die", "q"), (3, None, "q")], SCHEMA))
    out = langid.identify(docs, model)
    rows = sorted(out.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert out.columns == docs.columns + ["_lang_pred", "_score", "_cross_entropy", "_rejected"]
    assert [(r.doc_id, r._lang_pred) for r in rows] == [(1, "aa"), (1, "aa"), (3, "und"), (None, "bb")]
    assert all(r._k1 == r.word == "x" for r in rows) and rows[0]._score == pytest.approx(0.5, abs=0.05)


def test_query(spark, tmp_path):
    rows = [(i, t, k) for i, t, k in language_docs(160, 7)] + [(500, None, "aa"), (501, "12", "bb"), (502, "", None), (None, "the of and", "aa")]
    # what a held-out document says of its language must not count
    rows = [(i, t, "zz" if i is not None and zlib.crc32(str(i).encode()) % 3 == 1 else k) for i, t, k in rows]
    truth = {i: k for i, _, k in language_docs(160, 7)}
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.REGISTRY["op7_language_id"][0](spark, str(tmp_path))
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double",
                                "cross_entropy": "double", "rejected": "boolean"}
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.doc_id in (500, 501, 502):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out and r.doc_id < 500]) > 0.98


def test_bits_of_texts_are_summed_so_many_at_a_time(monkeypatch):
    """A block's words by language are far more than its texts: they are not all held at once, and sums stay the same."""
    rng = np.random.default_rng(3)
    words = ["x" * (1 + i % 9) if i % 5 else "\u0345" for i in range(1000)]           # a mark alone is no letter
    lengths = np.array([0, 1, 900, 0, 3, 700, 1, 0])
    codes = [np.sort(rng.choice(1000, n, replace=False)) for n in lengths]
    codes[1], codes[6] = np.array([5]), np.array([7])
    times = rng.integers(1, 9, lengths.sum())
    steps = np.concatenate([np.diff(c, prepend=0) for c in codes])
    bits = -rng.random((4, 1000)) * 30
    want_bits, want_chars, at = np.zeros((8, 4)), np.zeros(8), 0
    for i, c in enumerate(codes):
        n = times[at:at + len(c)]
        at += len(c)
        if any(words[x].isalpha() for x in c):
            want_bits[i], want_chars[i] = (-bits[:, c] * n).sum(axis=1), sum((len(words[x]) + 1) * k for x, k in zip(c, n))
    for most in (1, 2, 800, 1 << 16):
        monkeypatch.setattr(langid, "_SUM_CODES", most)
        own, chars = langid.text_sums(words, bits, steps, times, lengths)
        assert np.allclose(own, want_bits, rtol=1e-12) and (chars == want_chars).all()
    assert [len(x) for x in langid.text_sums([], np.zeros((4, 0)), steps[:0], times[:0], lengths[:0])] == [0, 0]

    monkeypatch.setattr(langid, "_SUM_CODES", 1 << 16)
    steps, times = np.tile(np.diff(np.arange(500), prepend=0), 4000), np.ones(2_000_000, dtype=np.int64)
    tracemalloc.start()
    langid.text_sums(words, bits, steps, times, np.full(4000, 500))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6                                          # 128 MB for all words at once
