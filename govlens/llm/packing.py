"""Best-fit packing of tokenised documents by exact-complement hashing.

The plan is made on the histogram of piece lengths, which has one entry per
length up to the capacity, whatever the corpus holds.  Lengths, pair sums and
triple sums that exactly fill a gap are looked up and consumed as often as
the available counts allow; what is left is placed best-fit.  The plan gives
places to (length, rank) ranges, and each piece finds its own by its rank
among the pieces of its length.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from govlens.llm.common import bounded_batches, per_worker, row_key, table, written

#: Entries of the token cache, and the longest piece that is kept in it.
CACHE_ENTRIES, CACHE_CHARS = 1_000_000, 64
#: Pieces of one length that are ranked together; a length that has more is split into parts.
RANK_ROWS = 1_000

_LETTERS, _MARKS = "a-zß-öø-ÿ", r"""!"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~"""


class WordTokenizer:
    """Token ids of whole texts, piece by piece, with a bounded cache.

    The vocabulary's normaliser lower-cases and its splitter drops white space
    and parts runs of letters, single digits and runs of other marks, so a
    text's ids are those of its pieces in order.  Pieces are found here in
    words of plain characters only; a word with any other character (or one
    that can begin a contraction or the name of a special token) goes to the
    tokenizer as it is.
    """

    _odd = re.compile(rf"[^{_LETTERS}A-ZÀ-ÖØ-Þ0-9{_MARKS}\x20\x09-\x0d]")
    _pieces = re.compile(rf"[{_LETTERS}]+|[0-9]|[{_MARKS}]+")
    _plain = re.compile(rf"[{_LETTERS}]+|[{_MARKS}]+")
    _words = re.compile(r"[^\x20\x09-\x0d]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        vocabulary = self._tok.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _split(self, text: str) -> list[str]:
        if not self._odd.search(text):
            return self._pieces.findall(text.lower())
        out = []
        for word in self._words.findall(text):
            if self._odd.search(word):
                out.append(word)
            else:
                out += self._pieces.findall(word.lower())
        return out

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pieces that the cache hasn't; plain ones go to the tokenizer 64 at a time."""
        out, plain = {}, []
        for p in pieces:
            if self._plain.fullmatch(p):
                plain.append(p)
            else:
                out[p] = np.asarray(self._tok.encode(p, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if plain:
            lines = [" ".join(plain[i:i + 64]) for i in range(0, len(plain), 64)]
            ids = np.concatenate([np.asarray(e.ids, dtype="<u4") for e in self._tok.encode_batch(lines, add_special_tokens=False)])
            ends = (np.flatnonzero(self._ends[ids]) + 1).tolist()       # a plain piece ends with the only end-of-word token in it
            if len(ends) != len(plain):
                raise ValueError("the vocabulary doesn't end each piece with an end-of-word token")
            raw = ids.tobytes()
            out.update((p, raw[4 * a:4 * b]) for p, a, b in zip(plain, [0, *ends], ends))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers."""
        split = [self._split(t) for t in texts]
        wanted = set().union(*split)
        missing = wanted.difference(self._known)
        if len(self._known) + len(missing) > CACHE_ENTRIES:
            self._known, missing = {}, wanted
        self._known.update(self._learn(list(missing)))
        out = [b"".join(map(self._known.__getitem__, s)) for s in split]
        for p in missing:
            if len(p) > CACHE_CHARS:
                del self._known[p]
        return out


#: Characters of text that are tokenised at a time.
_BATCH_CHARS = 1 << 21


def tokenize(docs: DataFrame, text_col: str = "text", vocabulary: str = "word_bpe_49k.json", capacity: int = 4096,
             end_id: int = 1, keep_ids: bool = False, path: str | None = None) -> DataFrame:
    """A row per piece: the columns of ``docs`` but the text, and piece, start, length, ids_crc32 (and ids).

    ``path`` names the vocabulary file on every machine; without it the
    installed public file ``vocabulary`` is taken.
    """
    bounded_batches(docs.sparkSession)
    others = [f for f in docs.schema.fields if f.name != text_col]
    names = [f.name for f in others]
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers
        file = path or public_tokenizers.path(vocabulary)
        tok = per_worker(("tokenizer", file), lambda: WordTokenizer(file))      # loading one takes time, and memory for good
        for batch in batches:
            texts = batch[text_col].fillna("")
            cut = np.cumsum(texts.str.len().to_numpy()) // _BATCH_CHARS
            for k in np.unique(cut):
                at = np.flatnonzero(cut == k)
                rows = []
                for i, ids in zip(at, tok.encode(texts.iloc[at].to_list()), strict=True):
                    ids += end
                    for p, s in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[s:s + 4 * capacity]
                        rows.append((i, p, s // 4, len(part) // 4, zlib.crc32(part))
                                    + ((np.frombuffer(part, dtype="<u4").astype(np.int64),) if keep_ids else ()))
                out = pd.DataFrame(rows, columns=["_row", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)
                own = batch[names].iloc[out.pop("_row")].reset_index(drop=True)
                yield pd.concat([own, out], axis=1)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others]
                       + ["piece int, start long, length long, ids_crc32 long"] + ["ids array<long>"] * keep_ids)
    return docs.mapInPandas(run, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """``(how many, lengths)``: sequences that hold exactly ``counts`` pieces of each length.

    Each exact combination uses up one of its lengths, and a length that
    no longer has one never gets one again, so the work depends on the
    capacity and not on the counts.
    """
    if any(not 0 < x <= capacity for x in counts):
        raise ValueError("a piece must have 1 to capacity tokens")
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[int, tuple[int, ...]]] = []

    def pair(total: int, most: int) -> tuple[int, int] | None:
        """Two available lengths with that sum, the larger one as large as can be, but ``most`` at most."""
        a = np.arange(min(most, total - 1), (total - 1) // 2, -1)
        b = total - a
        ok = (left[a] > 0) & (left[b] > 0) & ((a != b) | (left[a] > 1))
        k = int(ok.argmax()) if len(ok) else 0
        return (int(a[k]), int(b[k])) if len(ok) and ok[k] else None

    def complement(gap: int) -> tuple[int, ...] | None:
        if left[gap]:
            return (gap,)
        if found := pair(gap, gap):
            return found
        for a in np.flatnonzero(left[:gap]) [::-1]:
            if 3 * a < gap:
                break
            left[a] -= 1
            found = pair(gap - int(a), int(a))
            left[a] += 1
            if found:
                return (int(a), *found)
        return None

    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1
            rest = complement(capacity - length) if length < capacity else ()
            left[length] += 1
            if rest is None:
                break
            use = defaultdict(int)
            for x in (length, *rest):
                use[x] += 1
            n = min(int(left[x]) // k for x, k in use.items())
            for x, k in use.items():
                left[x] -= n * k
            out.append((n, (length, *rest)))
    # best fit, longest first; sequences that are alike are kept as one entry with a count
    open_: dict[int, list[list]] = defaultdict(list)
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            gap = min((g for g in open_ if g >= length), default=capacity)
            held = open_[gap][-1] if open_.get(gap) else [1 << 62, ()]
            k = min(gap // length, n)                      # sequential best fit stays with a sequence while it can
            m = min(held[0], n // k)
            held[0] -= m
            if not held[0]:
                open_[gap].pop()
            if gap in open_ and not open_[gap]:
                del open_[gap]
            open_[gap - k * length].append([m, held[1] + (length,) * k])
            n -= m * k
    return out + [(m, lengths) for gap in sorted(open_) for m, lengths in open_[gap]]


def _places(plan_: list[tuple[int, tuple[int, ...]]]) -> tuple[np.ndarray, ...]:
    """Per slot of the plan, in order of (length, first rank): that key, the first sequence, the offset."""
    rank: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for n, lengths in plan_:
        offset = 0
        for x in lengths:
            rows.append((x, rank[x], base, offset))
            rank[x] += n
            offset += x
        base += n
    rows.sort()
    length, first, base_, offset = (np.array(c, dtype=np.int64) for c in zip(*rows)) if rows else [np.empty(0, np.int64)] * 4
    return length, first, base_, offset


def place(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (with length, and _k1, _k2, piece to order them) plus sequence_id and offset.

    ``pieces`` is read three times and should be a written table.  The driver
    gets one number per length; the pieces of one length are ranked in parts of
    about ``RANK_ROWS``, so a length that a third of all pieces have is spread
    over as many tasks as it needs.
    """
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}      # capacity rows at most
    length, first, base, offset = _places(plan(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def find(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        out = np.empty((2, len(lengths)), dtype=np.int64)
        of, rank = lengths.to_numpy(), ranks.to_numpy()
        for x in np.unique(of):
            low, high = np.searchsorted(length, [x, x + 1])
            at = of == x
            k = low + np.searchsorted(first[low:high], rank[at], side="right") - 1
            out[:, at] = base[k] + rank[at] - first[k], offset[k]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    parts = F.lit([max(1, -(-counts.get(x, 0) // RANK_ROWS)) for x in range(1, capacity + 1)])
    part = F.pmod(F.xxhash64("_k1", "_k2", "piece"), F.element_at(parts, F.col("length").cast("int")))
    src = pieces.withColumn("_part", part)
    before = src.groupBy("length", "_part").count().select(
        "length", "_part", (F.sum("count").over(Window.partitionBy("length").orderBy("_part")) - F.col("count")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("length", "_part").orderBy("_k1", "_k2", "piece")) - 1
    ranked = src.withColumn("_own", own).join(before, ["length", "_part"])
    return ranked.withColumn("_at", find("length", F.col("_own") + F.col("_before"))) \
        .select(*pieces.columns, "_at.sequence_id", "_at.offset")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1,
         vocabulary: str = "word_bpe_49k.json", keep_ids: bool = False, path: str | None = None) -> DataFrame:
    """One row per piece of every document: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its ids and ``end_id``; a null or empty text is ``end_id``
    alone.  Only documents of more than ``capacity`` ids are cut.  Sequences
    hold ``capacity`` ids at most and have no gap.  A repeated row is packed
    each time; a null id is kept; an empty table gives an empty table.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *row_key(id_col, text_col))
    pieces = written(tokenize(src, "_text", vocabulary, capacity, end_id, keep_ids, path), "pieces")
    return place(pieces, capacity).drop("_k1", "_k2").withColumnRenamed("_id", id_col)


def op2(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
