"""Quality classifier from weak labels.

Overlapping heuristics vote on each document.  Expectation-maximisation over
the counts of vote patterns estimates how accurate each of them is and how
likely each pattern is a good document.  These posterior labels train a linear
scorer over hashed features, which then judges every document by its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlens.llm.common import bounded_batches, hashed_sample, held, released, table

BAD, GOOD, ABSTAIN = 0, 1, 2


#: The heuristics, in the order of their votes.
LABELLERS = ("symbols", "upper_case", "calls", "bars", "sentences", "variety", "word_length", "repeated_lines")

#: Kinds of characters: what a word's shape is written in, and what the heuristics count.
KINDS = "aA0xs!|.-"
_SYMBOLS, _CALLS, _BARS, _STOPS = "%$#*&@^~<>{}[]\\", "!?", "|=_", ".,;:"
#: The value of a band's feature; shares of words and shapes are square roots, and add up to more with a text's variety.
BAND = 2.0
#: Words whose figures a worker keeps.
CACHE_WORDS = 300_000


def _kind(c: str) -> int:
    for i, chars in enumerate((_SYMBOLS, _CALLS, _BARS, _STOPS), 4):
        if c in chars:
            return i
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c.isalpha() else 8


class Reader:
    """Figures of texts from figures of their words, which are worked out once and kept while there is room."""

    def __init__(self, hashes: bool = False):
        self._kinds = np.full(0x110000, 255, dtype=np.uint8)
        self._hashes = hashes                               # whether words' own hashes are wanted
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._shapes: dict[bytes, int] = {}
        self._table = np.empty((0, len(KINDS) + 2), dtype=np.int64)      # characters of each kind, hash, shape

    def shapes(self) -> list[bytes]:
        return list(self._shapes)

    def _learn(self, words: list[str]) -> None:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds = self._kinds[codes]
        if (kinds == 255).any():
            for c in np.unique(codes[kinds == 255]):
                self._kinds[c] = _kind(chr(c))
            kinds = self._kinds[codes]
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        sums = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(len(KINDS))], axis=1)
        # a shape is the word's kinds, runs written once
        run = np.concatenate([[True], kinds[1:] != kinds[:-1]])
        run[starts] = True
        raw = np.frombuffer(KINDS.encode(), dtype=np.uint8)[kinds[run]].tobytes()
        ends = np.add.reduceat(run, starts, dtype=np.int64).cumsum().tolist()
        shapes = [self._shapes.setdefault(raw[a:b], len(self._shapes)) for a, b in zip([0, *ends], ends)]
        hashes = [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 1) >> 1 for w in words] if self._hashes else [0] * len(words)
        at = len(self._known)
        self._known.update(zip(words, range(at, at + len(words))))
        if at + len(words) > len(self._table):              # grows by doubling
            more = np.empty((max(at + len(words), 2 * at) - at, len(KINDS) + 2), dtype=np.int64)
            self._table = np.concatenate([self._table[:at], more])
        self._table[at:at + len(words)] = np.column_stack([sums, hashes, shapes])

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        """Per text its figures, and the shapes and hashes of its words with their counts."""
        split = [(t or "").split() for t in texts]
        sets = [set(w) for w in split]
        new = set().union(*sets).difference(self._known)
        if len(self._known) + len(new) > CACHE_WORDS:
            self._forget()
            new = set().union(*sets)
        if new:
            self._learn(list(new))
        figures, shapes = np.zeros((len(texts), 11)), []
        for i, (text, words, distinct) in enumerate(zip(texts, split, sets, strict=True)):
            of = self._table[np.fromiter(map(self._known.__getitem__, words), dtype=np.int64, count=len(words))]
            kinds = of[:, :-2].sum(axis=0)
            kinds[6] += (text or "").count("\t")            # words are split at tabs, which part columns as bars do
            lines = (text or "").split("\n")
            n, w = max(1, len(text or "")), max(1, len(words))
            figures[i] = (kinds[4] / n, kinds[1] / n, kinds[5] / w, kinds[6] / w, kinds[7] / w, len(distinct) / w,
                          n / w, 1 - len(set(lines)) / len(lines), len(words), len(lines), 0)
            shapes.append((*np.unique(of[:, -1], return_counts=True), *(np.unique(of[:, -2], return_counts=True) if self._hashes else ())))
        return figures, shapes


def votes_of(figures: np.ndarray) -> np.ndarray:
    """A vote of each heuristic (0 bad, 1 good, 2 abstain) per text."""
    symbols, upper, calls, bars, stops, variety, length, repeats, n_words, n_lines, _ = figures.T
    some, many, runs = n_words >= 5, n_words >= 30, n_lines >= 4
    rules = (
        (some, symbols > 0.05, symbols < 0.005),
        (some, upper > 0.3, upper < 0.06),
        (some, calls > 0.5, calls < 0.1),
        (some, bars > 0.1, bars < 0.02),
        (many, (stops < 0.01) | (stops > 0.6), (stops >= 0.04) & (stops <= 0.3)),
        (many, variety < 0.45, variety > 0.6),
        (some, (length < 3) | (length > 12), (length >= 4) & (length <= 8)),
        (runs, repeats > 0.5, repeats < 0.1),
    )
    return np.stack([np.where(known & bad, BAD, np.where(known & good, GOOD, ABSTAIN)) for known, bad, good in rules], axis=1)


#: Characters of text that are read at a time.
_BATCH_CHARS = 1 << 21


def parts_of(texts: list[str | None]) -> Iterator[slice]:
    """Slices of ``texts`` of about ``_BATCH_CHARS`` characters."""
    cut = np.cumsum([len(t or "") for t in texts]) // _BATCH_CHARS
    edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(texts)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield slice(a, b)


#: A heuristic finds its own fault at least this often, and calls a good document faulty at most this often.
LEAST_FOUND, MOST_FALSE = 0.5, 0.05


@dataclass
class VoteModel:
    """The probability of a vote against a document, by class, and the shares of the classes.

    Class 0 is good documents; each further class is the kind of fault that
    one heuristic looks for.  Faults exclude each other far more than
    independent votes on one kind of bad document would, and one class for all
    of them follows whichever heuristics agree most.  A heuristic that abstains
    says nothing, for any class: a short text is not a bad one.
    """

    names: list[str]
    against: np.ndarray      # class, heuristic
    shares: np.ndarray       # class

    @classmethod
    def fit(cls, names: list[str], patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> VoteModel:
        """Expectation-maximisation over distinct patterns and their counts."""
        m, bad, said = len(names), patterns == BAD, patterns != ABSTAIN
        by = np.column_stack([~bad.any(axis=1), bad]).astype(np.float64) + 0.01
        by /= by.sum(axis=1, keepdims=True)
        model = cls(names, np.zeros((m + 1, m)), np.zeros(m + 1))
        for _ in range(rounds):
            weight = by * counts[:, None]
            model.against = (weight.T @ bad + 0.1) / (weight.T @ said + 0.2)
            model.against[0] = np.minimum(model.against[0], MOST_FALSE)
            own = np.arange(m)
            model.against[own + 1, own] = np.maximum(model.against[own + 1, own], LEAST_FOUND)
            model.shares = (weight.sum(axis=0) + 0.1) / (counts.sum() + 0.1 * (m + 1))
            last, by = by, model.responsibilities(patterns)
            if np.abs(by - last).max(initial=0) < 1e-9:
                break
        return model

    def log_votes(self) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities of a vote against and of one for, by class and heuristic."""
        p = np.clip(self.against, 1e-6, 1 - 1e-6)
        return np.log(p), np.log1p(-p)

    def responsibilities(self, patterns: np.ndarray) -> np.ndarray:
        no, yes = self.log_votes()
        z = (patterns == BAD) @ no.T + (patterns == GOOD) @ yes.T + np.log(self.shares)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """How likely each pattern is a good document."""
        return self.responsibilities(patterns)[:, 0]

    def accuracy(self) -> dict[str, float | None]:
        """How often a vote of each heuristic is right: for a good document, or against its own fault, in equal parts.

        None where the documents don't tell: the estimate is one of the bounds that were set beforehand.
        """
        own = np.arange(len(self.names))
        false, found = self.against[0], self.against[own + 1, own]
        told = (false < MOST_FALSE) & (found > LEAST_FOUND)
        return {n: float((1 - f + g) / 2) if t else None for n, f, g, t in zip(self.names, false, found, told, strict=True)}


def vote_model(docs: DataFrame, text_col: str = "text") -> VoteModel | None:
    """Fitted to all of ``docs``; the driver gets at most 3 ** 8 patterns with their counts.  None for an empty table."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, total = Reader(), Counter()
        for b in batches:
            texts = b["text"].where(b["text"].notna(), None).to_list()
            for part in parts_of(texts):
                total.update(map(bytes, votes_of(reader.read(texts[part])[0]).astype(np.uint8)))
        yield pd.DataFrame({"votes": list(total), "n": list(total.values())})

    found = docs.select(F.col(text_col).alias("text")).mapInPandas(run, "votes binary, n long") \
        .groupBy("votes").agg(F.sum("n").alias("n")).collect()
    if not found:
        return None
    patterns = np.array([list(r["votes"]) for r in found], dtype=np.int64)
    return VoteModel.fit(list(LABELLERS), patterns, np.array([r["n"] for r in found]))


class Hasher:
    """Hashed features of texts: the shares of each word and of each word shape, and bands of a few whole-text figures."""

    def __init__(self, dimensions: int):
        self.dimensions, self.reader = dimensions, Reader(hashes=True)

    def _at(self, feature: str) -> int:
        return xxhash.xxh64_intdigest(feature, 0) % self.dimensions

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Per text its votes, and its features as (index, value)."""
        figures, shapes = self.reader.read(texts)
        of = np.array([self._at(f"shape {x.decode()}") for x in self.reader.shapes()], dtype=np.int64)
        rows = []
        for (kind, n, word, times), f in zip(shapes, figures, strict=True):
            extra = []
            if f[9] >= 4:
                extra.append(f"lines {int(8 * (1 - f[7]))}")
            if f[8] >= 30:
                extra.append(f"variety {int(10 * f[5])}")
            if f[8] >= 5:
                extra += [f"{k} {min(int(50 * x), 20)}" for k, x in zip(("symbols", "upper", "bars"), (f[0], f[1], f[3]))]
                extra += [f"calls {min(int(10 * f[2]), 10)}", f"stops {min(int(20 * f[4]), 20)}", f"length {min(int(f[6]), 20)}"]
            index = np.concatenate([of[kind], word % self.dimensions, np.array([self._at(x) for x in extra], dtype=np.int64)])
            value = np.concatenate([np.sqrt(n / max(1, f[8])), np.sqrt(times / max(1, f[8])), np.full(len(extra), BAND)])
            index, where = np.unique(index, return_inverse=True)
            rows.append((index, np.bincount(where, value, len(index))))
        return votes_of(figures), rows


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, dimensions: int,
            steps: int = 200, rate: float = 2.0, decay: float = 1e-4) -> Scorer:
        """Logistic regression on soft labels, by gradient steps whose sizes adapt to each weight."""
        index = np.concatenate([r[0] for r in rows]).astype(np.int32)
        value = np.concatenate([r[1] for r in rows]).astype(np.float32)
        of = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        w, b, seen = np.zeros(dimensions), 0.0, np.full(dimensions + 1, 1e-8)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(of, value * w[index], len(rows)) + b, -30, 30)))
            error = (p - good) / len(rows)
            g = np.append(np.bincount(index, value * error[of], dimensions) + decay * w, error.sum())
            seen += g * g
            step = rate * g / np.sqrt(seen) * 0.1
            w -= step[:-1]
            b -= step[-1]
        return cls(w, float(b))

    def score(self, row: tuple[np.ndarray, np.ndarray]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[row[0]] @ row[1] + self.bias, -30, 30))))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: int = 1 << 18,
          max_rows: int = 6_000) -> tuple[VoteModel, Scorer] | None:
    """The vote model of all documents, and a scorer fitted to ``max_rows`` of them at most, taken by a hash.

    What the driver gets of a row for the fit is its hashed features and its
    votes: a few hundred numbers, whatever the text's length.  None for an
    empty table.
    """
    model = vote_model(docs, text_col)
    if model is None:
        return None
    some = hashed_sample(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"], max_rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Hasher(dimensions)
        for b in batches:
            texts = b["text"].where(b["text"].notna(), None).to_list()
            for part in parts_of(texts):
                votes, rows = features(texts[part])
                yield pd.DataFrame({"index": [r[0].astype(np.int32) for r in rows], "value": [r[1].astype(np.float32) for r in rows], "votes": list(votes)})

    got = some.select("text").mapInPandas(run, "index array<int>, value array<float>, votes array<long>").toPandas()
    good = model.posterior(np.stack(got["votes"].to_list()).astype(np.int64))
    rows = list(zip(got["index"], got["value"], strict=True))
    return model, Scorer.fit(rows, good, dimensions)


def classify(docs: DataFrame, fitted: tuple[VoteModel, Scorer] | None, text_col: str = "text",
             threshold: float = 0.5) -> DataFrame:
    """``docs`` plus _quality (0 to 1, by the scorer), _posterior (0 to 1, by the votes) and _keep.

    A null or empty text is scored like any other, by its lack of words; its
    heuristics abstain.  Repeated rows get equal scores.  An empty table gives
    an empty table.
    """
    if fitted is None:
        return docs.select("*", F.lit(0.0).alias("_quality"), F.lit(0.0).alias("_posterior"), F.lit(False).alias("_keep"))
    model, scorer = fitted

    @F.pandas_udf(T.StructType().add("quality", T.DoubleType()).add("posterior", T.DoubleType()))
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Hasher(len(scorer.weights))
        for s in batches:
            texts = s.where(s.notna(), None).to_list()
            scores, votes = [], [np.empty((0, len(LABELLERS)), dtype=np.int64)]
            for part in parts_of(texts):
                v, rows = features(texts[part])
                votes.append(v)
                scores += [scorer.score(r) for r in rows]
            yield pd.DataFrame({"quality": scores, "posterior": model.posterior(np.concatenate(votes))})

    bounded_batches(docs.sparkSession)
    out = held(docs, _text=text_col).select("_row", judge("_text").alias("_j"))
    return out.select(*released(docs.columns, _quality=F.col("_j.quality"), _posterior=F.col("_j.posterior"),
                                _keep=F.col("_j.quality") >= threshold))


def op10(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = classify(docs, train(docs))
    return out.select("doc_id", F.col("_quality").alias("quality"), F.col("_posterior").alias("posterior"), F.col("_keep").alias("keep"))
