"""Language identification with interpolated Kneser-Ney character models.

One model per language, over the letters of words: the counts of all words of
the training documents are gathered by Spark, n-grams of the distinct words
are counted with them, and lower orders use continuation counts.  Discounted
probabilities and back-off weights are a table in the order of a 64-bit hash of
their n-gram.  To score documents, blocks of them ask that table for the
n-grams that their words have, by a join, and get back sorted arrays of just
those; so no process holds a model whole, however much it has learned.  A
document gets the language with the lowest cross-entropy per character.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlens.functions.rank_index import RankIndex
from govlens.llm.common import bounded_batches, released, row_key, table, written

BEGIN, END = "\x02", "\x03"
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
#: Words whose counts a worker keeps.
CACHE_WORDS = 400_000
#: The most documents and distinct words of a block.
_BLOCK_DOCS, _BLOCK_WORDS = 8192, 250_000
#: Characters that are prepared at a time, and those of a word that lie in one piece of it.
_SLICE_CHARS, _PIECE_CHARS = 1 << 18, 1 << 14
#: Words of texts whose bits are summed at a time.
_SUM_CODES = 1 << 16
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _codes(strings: list[str]) -> np.ndarray:
    """The code points of all strings, one after another, each spread over 64 bits."""
    c = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return _mix((c + np.uint64(1)) * _MULTIPLIER)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _extend(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The hash of an n-gram from that of its first characters and its last character."""
    return _mix(h * _MULTIPLIER + code)


def gram_hashes(grams: list[str]) -> np.ndarray:
    size = np.fromiter(map(len, grams), dtype=np.int64, count=len(grams))
    codes, start = _codes(grams), np.concatenate([[0], np.cumsum(size)[:-1]]) if len(grams) else np.empty(0, np.int64)
    h = np.zeros(len(grams), dtype=np.uint64)
    for k in range(int(size.max(initial=0))):
        at = size > k
        h[at] = _extend(h[at], codes[start[at] + k])
    return h


@dataclass(frozen=True)
class LanguageModel:
    """Sorted hashes with the discounted probability of each n-gram, and with the back-off weight of each context."""

    order: int
    grams: np.ndarray
    alpha: np.ndarray
    contexts: np.ndarray
    back: np.ndarray
    floor: float          # the probability of a character that training never saw

    @staticmethod
    def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], np.float32(default))

    def log2(self, words: list[str]) -> np.ndarray:
        """The log probability of each word, its end included."""
        out = np.zeros(len(words))
        for prepared in slices(words, self.order):
            self.add_log2(out, prepared)
        return out

    def add_log2(self, out: np.ndarray, w: Prepared) -> None:
        p = np.full(len(w.place), self.floor, dtype=np.float64)
        for k in range(1, self.order + 1):
            alpha = self._find(self.grams, self.alpha, w.distinct[k], 0)[w.which[k]]
            back = self._find(self.contexts, self.back, w.distinct[k - 1], 1)[w.which[k - 1]]
            p[1:] = np.where(w.place[1:] >= max(1, k - 1), alpha[1:] + back[:-1] * p[1:], p[1:])
        p[~w.counted] = 1                                  # a word's begin isn't predicted, nor what a piece before it had
        np.add.at(out, w.owner, np.add.reduceat(np.log2(p), w.starts))


@dataclass(frozen=True)
class Prepared:
    """The n-grams that end at each character of padded words: by length, the distinct hashes and which of them it is.

    There are far fewer distinct n-grams than characters, so every model looks
    up each of them once.  A long word is in several pieces, each with the last
    characters of the one before it, so its n-grams are those of the whole.
    """

    text: str
    place: np.ndarray        # in its piece
    counted: np.ndarray      # whether a character is the piece's own, and no begin
    starts: np.ndarray
    owner: np.ndarray        # the word of each piece
    distinct: list[np.ndarray]
    which: list[np.ndarray]
    first: list[np.ndarray]  # a place in the text where each distinct n-gram ends

    @classmethod
    def of(cls, pieces: list[tuple[str, int, int]], order: int) -> Prepared:
        """From (padded text, characters that are not its own, word)."""
        padded = [p for p, _, _ in pieces]
        size = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded))
        codes, starts = _codes(padded), np.concatenate([[0], np.cumsum(size)[:-1]])
        place = np.arange(len(codes)) - np.repeat(starts, size)
        h = np.zeros(len(codes), dtype=np.uint64)
        distinct, which, first = [h[:1]], [np.zeros(len(codes), dtype=np.int64)], [np.zeros(1, dtype=np.int64)]
        for k in range(1, order + 1):
            before = np.concatenate([h[:1], h[:-1]]) if k > 1 else h
            h = _extend(before, codes)
            h[place < k - 1] = 0                           # it would reach into another piece
            u, at, of = np.unique(h, return_index=True, return_inverse=True)
            distinct.append(u)
            which.append(of)
            first.append(at)
        skip, owner = (np.fromiter((p[i] for p in pieces), dtype=np.int64, count=len(pieces)) for i in (1, 2))
        return cls("".join(padded), place, place >= np.repeat(skip, size), starts, owner, distinct, which, first)


def pieces_of(words: list[str], order: int) -> Iterator[list[tuple[str, int, int]]]:
    """``words`` padded, long ones in pieces, so many characters at a time: (text, characters not its own, word)."""
    held, chars = [], 0
    for i, word in enumerate(words):
        padded = BEGIN + word + END
        if len(padded) <= _PIECE_CHARS:
            held.append((padded, 1, i))
            chars += len(padded)
        else:
            for s in range(0, len(padded), _PIECE_CHARS):
                carry = min(s, order - 1)
                held.append((padded[s - carry:s + _PIECE_CHARS], carry or 1, i))
                chars += len(held[-1][0])
                if chars >= _SLICE_CHARS:
                    yield held
                    held, chars = [], 0
        if chars >= _SLICE_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def slices(words: list[str], order: int) -> Iterator[Prepared]:
    """``words``, so many characters at a time."""
    for pieces in pieces_of(words, order):
        yield Prepared.of(pieces, order)


def distinct_hashes(words: list[str], order: int) -> np.ndarray:
    """The hashes of all n-grams that ``Prepared`` looks up for ``words``, in order; that of the empty one is among them."""
    found = [np.zeros(1, dtype=np.uint64)]
    for pieces in pieces_of(words, order):
        size = np.fromiter((len(p) for p, _, _ in pieces), dtype=np.int64, count=len(pieces))
        codes = _codes([p for p, _, _ in pieces])
        place = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
        h = np.zeros(len(codes), dtype=np.uint64)
        for k in range(1, order + 1):
            h = _extend(np.concatenate([h[:1], h[:-1]]) if k > 1 else h, codes)
            found.append(np.unique(h[place >= k - 1]))
        found = [np.unique(np.concatenate(found))]
    return found[0]


def word_counts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """``lang, word, n`` over whole texts; counts are summed in the worker first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}

        def flush():
            for lang, c in held.items():
                yield pd.DataFrame({"lang": lang, "word": list(c), "n": list(c.values())})
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                held.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, held.values())) > CACHE_WORDS:
                    yield from flush()
        yield from flush()

    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    return src.mapInPandas(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, order: int) -> DataFrame:
    """``lang, gram, n``: raw counts of n-grams of full order or at a word's begin, continuation counts of the others."""
    def grams(words: list[str], counts: list[int]) -> pd.DataFrame:
        out = []
        for w in slices(words, order):
            n = np.repeat(np.array(counts, dtype=np.float64)[w.owner], np.diff(np.append(w.starts, len(w.place))))
            for k in range(1, order + 1):
                valid = w.counted & (w.place >= max(1, k - 1))
                sums = np.bincount(w.which[k], n * valid, len(w.distinct[k]))
                at = np.flatnonzero((sums > 0) & (w.distinct[k] != 0))
                ends = w.first[k][at] + 1
                out.append(pd.DataFrame({"gram": [w.text[e - k:e] for e in ends.tolist()], "n": sums[at].astype(np.int64)}))
        return pd.concat(out).groupby("gram", as_index=False, sort=False)["n"].sum()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[list, list]] = {}
        for batch in batches:
            for lang, g in batch.groupby("lang"):
                words, counts = held.setdefault(lang, ([], []))
                words += g["word"].to_list()
                counts += g["n"].to_list()
                if len(words) >= 50_000:
                    yield grams(words, counts).assign(lang=lang)[["lang", "gram", "n"]]
                    del held[lang]
        for lang, (words, counts) in held.items():
            yield grams(words, counts).assign(lang=lang)[["lang", "gram", "n"]]

    raw = written(words.mapInPandas(run, "lang string, gram string, n long")
                  .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    first = F.substring("gram", 1, 1) == BEGIN
    # a shorter n-gram counts once for each character seen before it
    return raw.where((F.length("gram") == order) | first).unionByName(
        raw.where(F.length("gram") > 1).groupBy("lang", F.expr("substring(gram, 2)").alias("gram"))
        .agg(F.count(F.lit(1)).alias("n")))


@dataclass
class Identifier:
    """The learned languages: the table of their n-grams, and the calibration of scores and of rejection.

    table: hash, codes, values - for each n-gram, per language k that has it as
    an n-gram (code 2k) or as a context (2k + 1), its probability or back-off weight.
    """

    langs: list[str]
    order: int = 4
    table: DataFrame | None = None
    floors: list[float] = field(default_factory=list)
    temperature: float = 1.0
    limits: np.ndarray | None = None
    usual: np.ndarray | None = None

    def calibration(self) -> Calibration:
        """The numbers that a prediction needs; they travel with the job."""
        n = len(self.langs)
        return Calibration(self.langs, self.temperature, np.full(n, np.inf) if self.limits is None else self.limits,
                           np.zeros(n) if self.usual is None else self.usual)


@dataclass
class Calibration:
    langs: list[str]
    temperature: float
    limits: np.ndarray
    usual: np.ndarray

    def _steady(self, bits: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Cross-entropies with 50 usual characters added, so that a few odd letters don't decide."""
        return (bits + 50 * self.usual) / (chars[:, None] + 50)

    def predict(self, bits: np.ndarray, chars: np.ndarray) -> pd.DataFrame:
        """From each text's bits by language, and the characters they are for (0: no letter)."""
        if not self.langs:
            return pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "cross_entropy": np.nan, "rejected": True}, index=range(len(chars)))
        some, row, best = chars > 0, np.arange(len(chars)), bits.argmin(axis=1)
        z = np.exp2(-self.temperature * (bits - bits.min(axis=1, keepdims=True)))
        return pd.DataFrame({
            "lang_pred": np.where(some, np.array(self.langs, dtype=object)[best], UNKNOWN),
            "score": np.where(some, 1 / z.sum(axis=1), 0.0),
            "cross_entropy": np.where(some, bits[row, best] / np.maximum(chars, 1), np.nan),
            "rejected": ~some | (self._steady(bits, chars)[row, best] > self.limits[best])}, index=range(len(chars)))


PREDICTION = T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType()) \
    .add("cross_entropy", T.DoubleType()).add("rejected", T.BooleanType())


def fitted(grams: DataFrame, order: int) -> Identifier:
    """The models of ``grams`` (lang, gram, n; see ``gram_counts``).

    Discounts, context totals and back-off weights are aggregates of all
    counts; what reaches the driver is a row per language and order.
    """
    size = F.length("gram")
    rows = grams.groupBy("lang", size.alias("size")).agg(
        F.count(F.lit(1)).alias("kinds"), *[F.count(F.when(F.col("n") == c, 1)).alias(f"n{c}") for c in (1, 2)]).collect()
    if not rows:
        return Identifier([])
    langs = sorted({r.lang for r in rows})
    discounts = [(r.lang, r.size, langs.index(r.lang), r.n1 / (r.n1 + 2 * r.n2) if r.n1 and r.n2 else 0.5) for r in rows]
    of = grams.sparkSession.createDataFrame(discounts, "lang string, size int, k int, d double")
    n = F.col("n")
    counts = grams.withColumn("size", size).join(of, ["lang", "size"]).select(
        "k", "gram", F.expr("substring(gram, 1, length(gram) - 1)").alias("context"), "n", "d")
    contexts = counts.groupBy("k", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.first("d").alias("d"))

    @F.pandas_udf("long")
    def hashed(grams: pd.Series) -> pd.Series:
        return pd.Series(gram_hashes(grams.to_list()).view(np.int64))

    alphas = counts.join(contexts.select("k", "context", "total"), ["k", "context"]).select(
        hashed("gram").alias("hash"), (2 * F.col("k")).alias("code"), (F.greatest(n - F.col("d"), F.lit(0.0)) / F.col("total")).cast("float").alias("value"))
    backs = contexts.select(hashed("context").alias("hash"), (2 * F.col("k") + 1).alias("code"),
                            (F.col("d") * F.col("kinds") / F.col("total")).cast("float").alias("value"))
    # a row per n-gram with an entry or two per language, in the order of the hashes
    by_hash = alphas.unionByName(backs).groupBy("hash").agg(F.collect_list(F.struct("code", "value")).alias("e")) \
        .select("hash", F.col("e.code").alias("codes"), F.col("e.value").alias("values"))
    parts = int(grams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table_ = written(by_hash.repartitionByRange(parts, "hash").sortWithinPartitions("hash"), "kn-model")
    kinds = {r.lang: r.kinds for r in rows if r.size == 1}
    return Identifier(langs, order, table_, [1 / (1 + kinds.get(x, 0)) for x in langs])


def packed(numbers: np.ndarray) -> bytes:
    """Small whole numbers, compressed byte by byte of their four."""
    return zstandard.compress(np.asarray(numbers).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def word_blocks(texts: DataFrame, order: int) -> DataFrame:
    """Blocks of documents (_k1, _k2, _text): each document's words as codes into the block's own, and the hashes of its n-grams."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        at, made = TaskContext.get().partitionId(), 0
        index: dict[str, int] = {}
        keys, found = [], []

        def flush() -> pd.DataFrame:
            words = list(index)
            # a document's codes ascend: their differences are small, and take a fifth of the room
            row = [f"{at}-{made}", [k for k, _ in keys], [k for _, k in keys], zstandard.compress("\n".join(words).encode("utf-8", "surrogatepass"), 1),
                   [len(c) for c, _ in found], packed(np.concatenate([np.diff(c, prepend=0) for c, _ in found])),
                   packed(np.concatenate([n for _, n in found])), distinct_hashes(words, order).view(np.int64)]
            return pd.DataFrame([row], columns=["_block", "k1", "k2", "words", "lengths", "codes", "times", "hashes"])

        for batch in batches:
            for k1, k2, text in zip(batch["_k1"].tolist(), batch["_k2"].tolist(), batch["_text"], strict=True):
                words = words_of(text)
                for w in words:
                    if w not in index:
                        index[w] = len(index)
                keys.append((k1, k2))
                codes, n = np.unique(np.fromiter(map(index.__getitem__, words), dtype=np.int32, count=len(words)), return_counts=True)
                found.append((codes, n.astype(np.uint32)))
                if len(keys) >= _BLOCK_DOCS or len(index) >= _BLOCK_WORDS:
                    yield flush()
                    index, keys, found, made = {}, [], [], made + 1
        if keys:
            yield flush()

    bounded_batches(texts.sparkSession)
    return texts.mapInPandas(run, "_block string, k1 array<long>, k2 array<long>, words binary, lengths array<int>, "
                                  "codes binary, times binary, hashes array<long>")


def text_sums(words: list[str], bits: np.ndarray, steps: np.ndarray, times: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bits by language and the characters of each text, zeros if it has no letter.

    ``steps`` are the differences of each text's ascending codes into
    ``words``, of which it has ``lengths``.  So many codes are summed at a time:
    a block has millions of them, with numbers for every language.
    """
    letters = np.fromiter((x.isalpha() for x in words), dtype=bool, count=len(words))
    size = np.fromiter((len(x) + 1 for x in words), dtype=np.int64, count=len(words))
    bits, ends = np.ascontiguousarray(bits.T), np.cumsum(lengths)
    own, chars = np.zeros((len(lengths), bits.shape[1])), np.zeros(len(lengths))
    first = 0
    while first < len(lengths):
        begin = ends[first] - lengths[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + _SUM_CODES, side="right")))      # one text at least
        cut = np.append(begin, ends[first:last]) - begin
        sums = np.cumsum(steps[begin:ends[last - 1]])                # each document begins anew
        codes = sums - np.repeat(np.append(0, sums)[cut[:-1]], np.diff(cut))
        n = times[begin:ends[last - 1]]

        def per_text(x):
            return np.diff(np.append(0, np.cumsum(x))[cut])
        some = per_text(letters[codes].astype(np.int64)) > 0
        held = np.flatnonzero(np.diff(cut))
        if len(held):                                # sums of each text alone: no other text's bits round them
            own[first + held] = np.add.reduceat(-bits[codes] * n[:, None], cut[held], axis=0)
        own[first:last][~some] = 0.0
        chars[first:last] = np.where(some, per_text(size[codes] * n), 0)
        first = last
    return own, chars


def scored(texts: DataFrame, model: Identifier) -> DataFrame:
    """``_k1, _k2, bits, chars`` for documents (_k1, _k2, _text): the bits that each language's model needs, and for how many characters."""
    blocks = written(word_blocks(texts, model.order), "langid-blocks")
    asked = blocks.select("_block", F.explode("hashes").alias("hash"))
    answers = asked.join(model.table, "hash").groupBy("_block").agg(F.collect_list(F.struct("hash", "codes", "values")).alias("a")) \
        .select("_block", F.col("a.hash").alias("of"), F.transform("a.codes", lambda c: F.size(c)).alias("sizes"),
                F.flatten("a.codes").alias("entry"), F.flatten("a.values").alias("value"))
    langs, order, floors = len(model.langs), model.order, model.floors

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                models = []
                if r["of"] is None:                          # none of the block's n-grams is known
                    r["of"], r["sizes"], r["entry"], r["value"] = [], [], [], []
                h = np.repeat(np.asarray(r["of"], dtype=np.int64).view(np.uint64), np.asarray(r["sizes"], dtype=np.int64))
                code, value = np.asarray(r["entry"], dtype=np.int64), np.asarray(r["value"], dtype=np.float32)
                by = np.argsort(h, kind="stable")
                h, code, value = h[by], code[by], value[by]
                for k in range(langs):
                    g, c = code == 2 * k, code == 2 * k + 1
                    models.append(LanguageModel(order, h[g], value[g], h[c], value[c], floors[k]))
                words = [w for w in zstandard.decompress(r["words"]).decode("utf-8", "surrogatepass").split("\n") if w]
                bits = np.zeros((langs, len(words)))
                for w in slices(words, order):
                    for m, row in zip(models, bits):
                        m.add_log2(row, w)
                own, chars = text_sums(words, bits, unpacked(r["codes"]), unpacked(r["times"]), np.asarray(r["lengths"], dtype=np.int64))
                yield pd.DataFrame({"_k1": np.asarray(r["k1"], dtype=np.int64), "_k2": np.asarray(r["k2"], dtype=np.int64),
                                    "bits": list(own), "chars": chars})

    return blocks.drop("hashes").join(answers, "_block", "left").mapInPandas(run, "_k1 long, _k2 long, bits array<double>, chars double")


def hashed_rows(docs: DataFrame, lang: str, columns: list[str], rows: int) -> DataFrame:
    """Of each language about ``rows`` rows, or all if it has no more: those whose hash of ``columns`` is low enough.

    Hashes are spread evenly, so a language's count gives the share to take,
    and nothing is ranked.  Rows of equal content count once.
    """
    keyed = docs.withColumn("_hash", F.xxhash64(*columns))
    share = F.least(F.lit(rows) / F.count(F.lit(1)), F.lit(1.0))
    cuts = keyed.groupBy(F.col(lang).alias("_of")).agg((share * 2.0 ** 64 - 2.0 ** 63).alias("_cut"))
    # a row per language, of which the driver has a list as well
    return keyed.join(F.broadcast(cuts), F.col(lang) == F.col("_of")).where(F.col("_hash").cast("double") <= F.col("_cut")) \
        .dropDuplicates([lang, "_hash"]).drop("_hash", "_of", "_cut")


#: Temperatures that are tried.
TEMPERATURES = np.geomspace(1e-3, 1, 31)


def calibrate(model: Identifier, seen: DataFrame, quantile: float = 0.999, slack: float = 1.5) -> None:
    """Fit the temperature of the posterior and each language's limit of cross-entropy to all rows of ``seen`` (lang, bits, chars).

    Losses are sums over rows, medians and quantiles come from rank indexes:
    the driver gets a number for each temperature and two for each language.
    """
    langs = model.langs

    def losses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(len(TEMPERATURES)), 0
        for batch in batches:
            if not len(batch):
                continue
            bits, own = np.stack(batch["bits"].to_list()), np.arange(len(batch))
            bits = bits - bits.min(axis=1, keepdims=True)
            for i, t in enumerate(TEMPERATURES):
                total[i] += (t * bits[own, batch["k"]] + np.log2(np.exp2(-t * bits).sum(axis=1))).sum()
            n += len(batch)
        yield pd.DataFrame({"i": np.arange(len(total)), "loss": total, "n": n})

    k = (F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1).cast("int")
    rows = written(seen.where("chars > 0").select(k.alias("k"), "bits", "chars"), "langid-calibration")
    found = rows.select("k", "bits").mapInPandas(losses, "i int, loss double, n long").groupBy("i").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n")).collect()
    if not found or not found[0].n:
        return
    model.temperature = min((r.loss, float(TEMPERATURES[r.i])) for r in found)[1]
    own, every = F.get("bits", F.col("k")), list(range(len(langs)))
    c = model.calibration()
    usual = RankIndex.of_groups(rows.select("k", (own / F.col("chars")).alias("v")), "k", "v").quantiles(every, [0.5])
    c.usual = np.array([c.usual[i] if usual[i][0] is None else usual[i][0] for i in every])
    some = F.get(F.array(*[F.lit(float(x)) for x in c.usual]), F.col("k"))
    limits = RankIndex.of_groups(rows.select("k", ((own + 50 * some) / (F.col("chars") + 50)).alias("v")), "k", "v").quantiles(every, [quantile])
    model.usual, model.limits = c.usual, np.array([c.limits[i] if limits[i][0] is None else slack * limits[i][0] for i in every])


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", order: int = 4) -> Identifier:
    """The models of all words of every row of ``docs`` with a language and a letter, not calibrated yet."""
    words = written(word_counts(docs, lang_col, text_col), "words")
    return fitted(written(gram_counts(words, order), "kn-counts"), order)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", order: int = 4,
          calibration_rows: int | None = None, quantile: float = 0.999, slack: float = 1.5) -> Identifier:
    """Learn from every row of ``docs`` with a language and a letter.

    All words of all rows are counted, and the models are a written table with
    all of their n-grams.  Scores and rejection are calibrated on all those
    rows, equal ones once (a caller who bounds ``calibration_rows`` gets about
    so many of each language, taken by a hash of their text), so a rare
    language has a limit of its own.  Rows without a language or without text
    teach nothing; without any teaching row the result knows no language and
    answers "und".
    """
    model = learn(docs, lang_col, text_col, order)
    if not model.langs:
        return model
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_text")).where("lang is not null and _text is not null")
    if calibration_rows is not None:
        rows = hashed_rows(rows, "lang", ["lang", "_text"], calibration_rows)
    rows = written(rows.select("lang", "_text", *row_key("lang", "_text")).dropDuplicates(["_k1", "_k2"]), "langid-rows")
    calibrate(model, scored(rows.drop("lang"), model).join(rows.drop("_text"), ["_k1", "_k2"]), quantile, slack)
    return model


def identify(docs: DataFrame, model: Identifier, text_col: str = "text", columns: list[str] | None = None,
             taught: Column | None = None, lang_col: str = "lang") -> DataFrame:
    """``columns`` of ``docs`` (all) plus _lang_pred, _score (0 to 1), _cross_entropy (bits a character) and _rejected.

    A text that is null or has no letter is "und" with score 0, and rejected;
    one that its best model finds odder than nearly all that it learned from
    keeps its prediction and is rejected too.  Of languages that tie, the
    first by name is taken.  Rows that repeat whole get one answer each; an
    empty table gives an empty table.

    ``taught`` tells the rows of ``docs`` that the model has learned from (see
    ``learn``): it is calibrated first, on all of them as ``train`` does, and
    all documents are scored once.
    """
    names = [f.name for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    key = row_key(*[f"`{x}`" for x in names])
    keyed = docs.select(*key, F.struct(*[F.col(f"`{x}`") for x in columns or docs.columns]).alias("_row"),
                        F.col(f"`{text_col}`").alias("_text"))
    if model.langs:
        bits = scored(keyed.select("_k1", "_k2", "_text"), model).dropDuplicates(["_k1", "_k2"])
        if taught is not None:
            bits = written(bits, "langid-bits")
            rows = docs.where(taught).select(*key, F.col(f"`{lang_col}`").alias("_lang"), F.col(f"`{text_col}`").alias("_text")) \
                .where("_lang is not null and _text is not null") \
                .select("_k1", "_k2", F.col("_lang").alias("lang"), *[k.alias(f"_t{i}") for i, k in enumerate(row_key("_lang", "_text"))])
            calibrate(model, rows.dropDuplicates(["_t0", "_t1"]).join(bits, ["_k1", "_k2"]))
    c = model.calibration()

    @F.pandas_udf(PREDICTION)
    def predict(bits: pd.Series, chars: pd.Series) -> pd.DataFrame:
        return c.predict(np.stack(bits.to_list()) if len(bits) else np.zeros((0, len(c.langs))), chars.to_numpy())

    if model.langs:
        out = bits.select("_k1", "_k2", predict("bits", "chars").alias("_p"))
        out = keyed.drop("_text").join(out, ["_k1", "_k2"])
    else:
        out = keyed.withColumn("_p", predict(F.array().cast("array<double>"), F.lit(0.0)))
    return out.select(*released(columns or docs.columns, **{f"_{f.name}": F.col(f"_p.{f.name}") for f in PREDICTION}))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op7(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()))
    out = identify(docs.select("doc_id", "text", "lang"), model, columns=["doc_id"], taught=~held_out())
    return out.select("doc_id", held_out().alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"),
                      F.col("_cross_entropy").alias("cross_entropy"), F.col("_rejected").alias("rejected"))
