"""Alignment of two tokenizers over the same bytes, by an associative fragment monoid.

Places where tokens of both sides end cut a document into groups.  A range of
its bytes knows its groups but for its edges: a *fragment* is an open head (the
tokens up to the first shared end, whose group may have begun before), closed
groups, and an open tail.  Fragments compose: the left one's tail and the right
one's head make a group, or stay open as long as no shared end has been seen.
Composition is associative, so a very long document is cut into byte ranges
that separate tasks align, and a tree of Spark rounds puts it together again.

To tokenise a range alone, its task gets the text between the nearest places
outside that both sides cut: before a space, tab or line break that follows
something else, where a byte-level splitter begins a new word and no piece of
the other vocabulary goes on.  The same places part a text into words that
repeat, so each word is tokenised and aligned once per worker.

Counts of linked id pairs are taken block by block of documents, summed over
all, and sent back to the blocks that hold the pair: what is shuffled is a row
per block and distinct pair, not one per document and link.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlens.llm.common import bounded_batches, per_worker, table, written
from govlens.llm.pieces import LETTERS, SPACE, PieceEncoder

#: Bytes of a range; documents of more are cut into ranges.
RANGE_BYTES = 1 << 16
#: Fragments that one task composes in a round of the tree.
_FAN_IN = 8
#: Words and bytes of aligned words that a worker keeps, and the most documents and pairs of a block.
_CACHE_WORDS, _CACHE_BYTES, _BLOCK_DOCS, _BLOCK_PAIRS = 100_000, 24 << 20, 1024, 1 << 18
#: Lines of words that are tokenised at a time: the tokenizer returns its tokens' strings and places with them.
_LINES = 200
#: Characters of a word that is aligned together with others.
_WORD_CHARS = 512

Tokens = tuple[list[int], list[int], list[int], list[int]]      # ids and ends of one side, ids and ends of the other


class Cutter:
    """Where both sides cut a text.

    That is before one of ``spaces`` (white space to any splitter) that
    follows something else - whatever may count as white space somewhere must
    not stand before it - and before one of ``marks`` that follows a letter.
    """

    def __init__(self, spaces: str, marks: str):
        w, p, l = re.escape(spaces), re.escape(marks), re.escape("".join(sorted(LETTERS)))  # noqa: E741
        self.place = re.compile(rf"(?<=[^\s\u180e])(?=[{w}])" + (rf"|(?<=[{l}])(?=[{p}])" if marks else ""))
        self._word = re.compile(rf"[{w}]*[^{w}{l}]*[{l}]*(?:[^{w}{l}{p}][^{w}{l}]*[{l}]*)*")
        self._other = re.compile(rf"[^\S{w}]|\u180e")

    def words(self, text: str) -> list[str]:
        """The stretches between the places."""
        return self.place.split(text) if self._other.search(text) else self._word.findall(text)[:-1]     # the last match is empty

    def before(self, text: str) -> list[int]:
        """How many bytes come before each place."""
        out, at, size = [], 0, 0
        for m in self.place.finditer(text):
            size += len(text[at:m.start()].encode())
            at = m.start()
            out.append(size)
        return out


class Groups(NamedTuple):
    """What is kept of closed groups: their text, sizes, and how often each id pair is linked (keys ascend)."""
    text: bytes = b""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    keys: np.ndarray = np.empty(0, dtype=np.int64)
    times: np.ndarray = np.empty(0, dtype=np.int64)

    def __add__(self, other: Groups) -> Groups:
        if not self.n_groups or not other.n_groups:
            return other if other.n_groups else self
        return Groups(self.text + b";" + other.text, *(x + y for x, y in zip(self[1:5], other[1:5])),
                      *summed(np.concatenate([self.keys, other.keys]), np.concatenate([self.times, other.times])))


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(found), dtype=np.int64)
    np.add.at(out, at, times)
    return found, out


def groups(parts: Iterable[tuple[list[int], list[int]]]) -> Groups:
    """Groups from the ids of both sides in each."""
    parts = list(parts)
    pairs = Counter()
    for a, b in parts:
        if len(a) == len(b) == 1:
            pairs[a[0] << 32 | b[0]] += 1
        else:
            many = Counter(b).items()
            for x, n in Counter(a).items():
                for y, m in many:
                    pairs[x << 32 | y] += n * m
    keys = sorted(pairs)
    return Groups(";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in parts).encode(),
                  sum(len(a) for a, _ in parts), sum(len(b) for _, b in parts), len(parts), sum(len(a) * len(b) for a, b in parts),
                  np.array(keys, dtype=np.int64), np.array([pairs[k] for k in keys], dtype=np.int64))


class Fragment(NamedTuple):
    """The tokens that end in a range of bytes.  Without a shared end (``shared``), all of them are in the head."""
    shared: bool = False
    head: tuple[list[int], list[int]] = ([], [])
    closed: Groups = Groups()
    tail: tuple[list[int], list[int]] = ([], [])

    def __add__(self, other: Fragment) -> Fragment:
        if not other.shared:
            if not self.shared:
                return Fragment(False, _both(self.head, other.head))
            return self._replace(tail=_both(self.tail, other.head))
        if not self.shared:
            return other._replace(head=_both(self.head, other.head))
        middle = _both(self.tail, other.head)                    # empty if one ends where the other begins
        between = groups([middle]) if middle[0] else Groups()
        return Fragment(True, self.head, self.closed + between + other.closed, other.tail)

    def whole(self) -> Groups:
        """The groups of a document; its start and its end are shared by all tokens."""
        if self.tail[0] or self.tail[1] or bool(self.head[0]) != bool(self.head[1]):
            raise ValueError("not a whole document")
        return (groups([self.head]) if self.head[0] else Groups()) + self.closed


def _both(x, y):
    return list(x[0]) + list(y[0]), list(x[1]) + list(y[1])


def fragment(tokens: Tokens, low: int, high: int, begins_shared: bool = False) -> Fragment:
    """Of ``tokens`` those that end in (low, high]; ``begins_shared`` if both sides have an end at ``low``."""
    a, a_ends, b, b_ends = tokens
    shared = sorted(e for e in set(a_ends).intersection(b_ends) if low < e <= high)
    parts, i, j = [], 0, 0
    while i < len(a) and a_ends[i] <= low:
        i += 1
    while j < len(b) and b_ends[j] <= low:
        j += 1
    for end in [*shared, high]:
        p, q = i, j
        while i < len(a) and a_ends[i] <= end:
            i += 1
        while j < len(b) and b_ends[j] <= end:
            j += 1
        parts.append((a[p:i], b[q:j]))
    tail = parts.pop()
    if begins_shared:
        return Fragment(True, ([], []), groups(parts), tail)
    return Fragment(True, parts[0], groups(parts[1:]), tail) if shared else Fragment(False, tail)


def byte_table() -> dict[str, int]:
    """The characters of a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Both tokenizers, and the aligned words that a worker has met."""

    def __init__(self, a_path: str, b_path: str):
        from tokenizers import Tokenizer
        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True                     # their names are plain text
        own = byte_table()
        vocabulary = {i: bytes(own[c] for c in t) if all(c in own for c in t) else b"" for t, i in self._a.get_vocab().items()}
        self._a_bytes = [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]
        self._b = PieceEncoder(b_path)
        how = self._b.normalize
        if how.map or how.squeeze or not (how.prefix and how.escape):
            raise ValueError("the second tokenizer must keep its texts as they are")
        self._b_bytes = self._b.token_bytes()
        self._a_size, self._b_size = (np.array(list(map(len, t)), dtype=np.int64) for t in (self._a_bytes, self._b_bytes))
        numbers = range(max(len(self._a_bytes), len(self._b_bytes)))
        self._written = [[f"{i}{end}" for i in numbers] for end in (",", "|", ";", "")]
        allowed = "".join(c for c in " \n\t\r" if self._b.cuts_before(c))
        #: Where texts may be cut; None if nowhere.
        self.cutter = Cutter(allowed, self._b.cuts_after_letters()) if allowed else None
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[bytes | None] = []                      # None: not the bytes of its tokens
        self.sizes = np.empty((0, 4), dtype=np.int64)
        self.first, self.keys, self.times = np.zeros(1, dtype=np.int64), Groups().keys, Groups().times
        self._held = 0

    def tokens(self, words: list[str]) -> list[Tokens | None]:
        """Ids and ends of both sides for each; None where either side's bytes aren't the word's."""
        out = []
        b_ids = self._b.plain_ids([w.replace(" ", SPACE) for w in words])
        for w, a, b in zip(words, self._a.encode_batch(words, add_special_tokens=False), b_ids, strict=True):
            a, data = a.ids, w.encode()
            x, y = [self._a_bytes[i] for i in a], [self._b_bytes[i] for i in b]
            out.append((a, _ends(x), b, _ends(y)) if SPACE not in w and b"".join(x) == data == b"".join(y) else None)
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Have the groups of all ``words``; earlier ones go when there are too many."""
        words = set(words)
        missing = [w for w in words if w not in self.index]
        if len(self.texts) + len(missing) > _CACHE_WORDS or self._held > _CACHE_BYTES:
            self._forget()
            missing = list(words)
        for w in missing:
            if len(w) > _WORD_CHARS:
                found = self.tokens([w])[0]
                self._add([w], [None if found is None else fragment(found, 0, len(w.encode()), True).closed])
        # words of a space and letters are tokenised many at a time: each ends where the next one begins
        plain = [w for w in missing if w[0] == " " and len(w) <= _WORD_CHARS and LETTERS.issuperset(w[1:]) and len(w) > 1]
        chosen = set(plain)
        lines = [plain[i:i + 64] for i in range(0, len(plain), 64)] + [[w] for w in missing if w not in chosen and len(w) <= _WORD_CHARS]
        for i in range(0, len(lines), _LINES):
            self._align(lines[i:i + _LINES])

    def _add(self, words: list[str], found: list[Groups | None]) -> None:
        for w, g in zip(words, found):
            self.index[w] = len(self.texts)
            self.texts.append(None if g is None else g.text)
        some = [g or Groups() for g in found]
        self._extend(np.array([g[1:5] for g in some], dtype=np.int64), [len(g.keys) for g in some],
                     np.concatenate([g.keys for g in some]), np.concatenate([g.times for g in some]))

    def _extend(self, sizes, lengths, keys, times) -> None:
        self.sizes = np.concatenate([self.sizes, sizes])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(lengths)])
        self.keys, self.times = np.concatenate([self.keys, keys]), np.concatenate([self.times, times])
        self._held += 24 * len(keys) + 200 * len(sizes)

    def _align(self, lines: list[list[str]]) -> None:
        """Groups of the words of all lines at once."""
        words = [w for line in lines for w in line]
        joined = ["".join(line) for line in lines]
        a = np.concatenate([np.asarray(e.ids, dtype=np.int64) for e in self._a.encode_batch(joined, add_special_tokens=False)])
        b = np.concatenate([np.asarray(x, dtype=np.int64) for x in self._b.plain_ids([x.replace(" ", SPACE) for x in joined])])
        data = "".join(joined).encode()
        if SPACE in "".join(joined) or not (b"".join([self._a_bytes[i] for i in a.tolist()]) == data == b"".join([self._b_bytes[i] for i in b.tolist()])):
            found = self.tokens(words)                           # word by word, to find those that differ
            self._add(words, [None if t is None else fragment(t, 0, len(w.encode()), True).closed for w, t in zip(words, found)])
            return
        a_end, b_end = np.cumsum(self._a_size[a]), np.cumsum(self._b_size[b])
        word_end = np.cumsum([len(w.encode()) for w in words])
        shared = np.intersect1d(a_end, b_end, assume_unique=True)
        if not np.isin(word_end, shared).all():
            raise ValueError("a token goes on from one word to the next")
        a_group, b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        n_a, n_b = np.bincount(a_group, minlength=len(shared)), np.bincount(b_group, minlength=len(shared))
        word = np.searchsorted(word_end, shared)                 # of each group

        def by_word(x):
            return np.bincount(word, x, len(words)).astype(np.int64)
        # every pair of a group: each token of one side with all of the other
        times = n_b[a_group]
        b_first = np.cumsum(n_b) - n_b
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(b_first[a_group], times)
        keys, owner = np.repeat(a, times) << 32 | b[at], np.repeat(word[a_group], times)
        # the text: a group's tokens of one side, then those of the other
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        ids = np.concatenate([a, b])[order]
        mark = np.zeros(len(ids), dtype=np.int64)
        ends = np.cumsum(n_a + n_b)
        mark[ends - n_b - 1], mark[ends - 1] = 1, 2
        last = ends[np.searchsorted(shared, word_end)]
        mark[last - 1] = 3
        parts = [self._written[m][i] for m, i in zip(mark.tolist(), ids.tolist())]
        low = 0
        for w, high in zip(words, last.tolist()):
            self.index[w] = len(self.texts)
            self.texts.append("".join(parts[low:high]).encode())
            low = high
        self._extend(np.stack([by_word(n_a), by_word(n_b), by_word(np.ones(len(shared))), by_word(n_a * n_b)], axis=1),
                     np.bincount(owner, minlength=len(words)), keys, np.ones(len(keys), dtype=np.int64))

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cutter.words(text) if self.cutter else [text]

    def closed(self, texts: list[list[str]]) -> list[Groups | None]:
        """The groups of each list of consecutive learned words; None if one of them isn't its tokens' bytes."""
        codes = [np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words)) for words in texts]
        out: list[Groups | None] = []
        for i in range(0, len(texts), 64):
            out += self._closed(codes[i:i + 64])
        return out

    def _closed(self, codes: list[np.ndarray]) -> list[Groups | None]:
        text = np.repeat(np.arange(len(codes)), list(map(len, codes)))
        known = len(self.texts)
        found, n = np.unique(text * known + np.concatenate(codes), return_counts=True) if len(text) else (Groups().keys, Groups().keys)
        text, word = np.divmod(found, max(known, 1))
        sizes = np.zeros((len(codes), 4), dtype=np.int64)
        np.add.at(sizes, text, self.sizes[word] * n[:, None])
        length = self.first[word + 1] - self.first[word]
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(self.first[word], length)
        owner, keys, times = np.repeat(text, length), self.keys[at], self.times[at] * np.repeat(n, length)
        by = np.lexsort((keys, owner))
        owner, keys, times = owner[by], keys[by], times[by]
        new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1]))) if len(keys) else Groups().keys
        owner, keys, times = owner[new], keys[new], np.add.reduceat(times, new) if len(new) else times
        cut = np.searchsorted(owner, np.arange(len(codes) + 1))
        out = []
        for k, own in enumerate(codes):
            parts = [self.texts[c] for c in own.tolist()]
            out.append(None if None in parts else Groups(b";".join(parts), *sizes[k].tolist(), keys[cut[k]:cut[k + 1]], times[cut[k]:cut[k + 1]]))
        return out

    def between(self, words: list[str], base: int, low: int, high: int) -> Fragment | None:
        """The fragment of (low, high], from words that begin at byte ``base`` at or before it and end at or after it."""
        ends = base + np.cumsum([len(w.encode()) for w in words])
        starts = np.append(base, ends[:-1])
        inner = (starts >= low) & (ends <= high)
        self.learn(w for w, i in zip(words, inner) if i)
        out = Fragment()
        run: list[str] = []
        for w, i, s, e in [*zip(words, inner, starts.tolist(), ends.tolist()), ("", False, high, high)]:
            if i:
                run.append(w)
                continue
            if run:
                closed = self.closed([run])[0]
                if closed is None:
                    return None
                out, run = out + Fragment(True, closed=closed), []
            if s < high and e > low:
                found = self.tokens([w])[0]
                if found is None:
                    return None
                out += fragment(found, max(low - s, 0), min(high, e) - s, s >= low)
        return out


def _ends(tokens: list[bytes]) -> list[int]:
    return np.cumsum([len(t) for t in tokens]).tolist()


def ranges(text: str, size: int, cutter: Cutter | None) -> list[tuple[int, int, int, str]]:
    """``(low, high, base, context)``: ranges of about ``size`` bytes, and the text from the place before to the place after.

    A stretch of more than ``size`` bytes without a place to cut has no range
    end in it: it would be tokenised once for every range that it touches.
    """
    data = text.encode()
    total = len(data)
    edges, left, right = [(0, 0, 0)], 0, 0                       # edge, place at or before it, place at or after it
    for edge in range(size, total, size) if cutter else ():
        if edge > right:
            left, right = _around(data, edge, right, cutter)
        if right - left <= size:
            edges.append((edge, left, right))
    edges.append((total, total, total))
    return [(low, high, base, data[base:end].decode()) for (low, base, _), (high, _, end) in zip(edges, edges[1:])]


def _around(data: bytes, edge: int, known: int, cutter: Cutter) -> tuple[int, int]:
    """The last place at or before ``edge`` (``known`` is one) and the first at or after it; a text's ends are places."""
    left, reach = known, 256
    while True:
        begin, end = max(known, edge - reach), min(len(data), edge + reach)
        while begin > 0 and data[begin] & 0xC0 == 0x80:
            begin -= 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        places = [begin + n for n in cutter.before(data[begin:end].decode())]
        before = [p for p in places if p <= edge]
        after = [p for p in places if p >= edge]
        if (before or begin <= known) and (after or end == len(data)):
            return before[-1] if before else left, after[0] if after else len(data)
        reach *= 2


_ROW = "n_a long, n_b long, n_groups long, n_links long"
_FRAGMENT = f"row long, part long, parts long, id {{kind}}, sound boolean, shared boolean, head_a array<int>, head_b array<int>, " \
    f"tail_a array<int>, tail_b array<int>, text binary, {_ROW}, keys array<long>, times array<long>"


def _as_row(f: Fragment | None) -> tuple:
    sound, f = f is not None, f or Fragment()
    return sound, f.shared, *f.head, *f.tail, *f.closed


def _from_row(r) -> Fragment | None:
    ids = [[int(x) for x in c] for c in (r.head_a, r.head_b, r.tail_a, r.tail_b)]
    return Fragment(bool(r.shared), (ids[0], ids[1]), Groups(bytes(r.text), int(r.n_a), int(r.n_b), int(r.n_groups), int(r.n_links),
                    np.asarray(r.keys, dtype=np.int64), np.asarray(r.times, dtype=np.int64)), (ids[2], ids[3])) if r.sound else None


class _Blocks:
    """Documents gathered into rows of a block each: columns of documents, and their pairs as codes into the block's own list."""

    def __init__(self, name: str, keep: bool):
        self.name, self.keep, self.made = name, keep, 0
        self._clear()

    def _clear(self):
        self.ids, self.found, self.pairs = [], [], 0

    def add(self, doc_id, g: Groups | None) -> pd.DataFrame | None:
        g = g or Groups()
        digest = hashlib.sha256(g.text).hexdigest() if g.n_groups else ""
        self.ids.append(doc_id)
        self.found.append((*g[1:5], digest, g.text.decode() if self.keep else "", g.keys, g.times))
        self.pairs += len(g.keys)
        return self.flush() if len(self.ids) >= _BLOCK_DOCS or self.pairs >= _BLOCK_PAIRS else None

    @staticmethod
    def _times(times: np.ndarray) -> bytes:
        """Four bytes a number, or eight if one of them needs it; there are as many as codes."""
        return times.astype("<u4" if times.max(initial=0) < 1 << 32 else "<u8").tobytes()

    def flush(self) -> pd.DataFrame | None:
        if not self.ids:
            return None
        *sizes, digests, texts, keys, times = map(list, zip(*self.found))
        pairs, codes = np.unique(np.concatenate(keys), return_inverse=True)
        row = [f"{self.name}-{self.made}", self.ids, *sizes, digests, texts, [len(k) for k in keys],
               codes.astype("<u4").tobytes(), self._times(np.concatenate(times)), pairs,
               np.bincount(codes, minlength=len(pairs))]         # a document has each of its pairs once
        self.made += 1
        self._clear()
        return pd.DataFrame([row], columns=["_block", "ids", "n_a", "n_b", "n_groups", "n_links", "digests", "texts", "lengths",
                                            "codes", "times", "pairs", "held"])


def _block_schema(kind: str) -> str:
    return f"_block string, ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, " \
        "digests array<string>, texts array<string>, lengths array<int>, codes binary, times binary, pairs array<long>, held array<long>"


def _missing(v) -> bool:
    return v is None or v is pd.NA or v != v


def _batched(batch: pd.DataFrame) -> Iterator[tuple]:
    ids = batch["_id"].astype(object)
    return zip(ids.where(ids.notna(), None), batch["_text"])


def _fragments(long: DataFrame, tool, kind: str, size: int) -> DataFrame:
    """One fragment per document of ``long`` (row, _id, _text), composed round by round."""
    spark = long.sparkSession

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = tool().cutter
        for batch in batches:
            for row, (doc_id, text) in zip(batch["row"], _batched(batch)):
                # a text with the sign for a space doesn't equal its pieces' bytes: nothing to cut
                parts = ranges(" " + text, size, cutter) if SPACE not in text else [(0, 0, 0, SPACE)]
                yield pd.DataFrame([(row, k, len(parts), doc_id, *p) for k, p in enumerate(parts)],
                                   columns=["row", "part", "parts", "id", "low", "high", "base", "context"])

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = tool()
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                found = own.between(own.split(r.context), r.base, r.low, r.high) if SPACE not in r.context else None
                rows.append((r.row, r.part, r.parts, None if _missing(r.id) else r.id, *_as_row(found)))
            yield pd.DataFrame(rows, columns=names)

    def compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, held = None, None                                    # one fragment at a time: rows come in order
        for batch in batches:
            done = []
            for r in batch.itertuples(index=False):
                to = (r.row, r.part // _FAN_IN, -(-r.parts // _FAN_IN), None if _missing(r.id) else r.id)
                if of and of[:2] == to[:2]:
                    right = _from_row(r)
                    held = None if held is None or right is None else held + right
                    continue
                if of:
                    done.append((*of, *_as_row(held)))
                of, held = to, _from_row(r)
            yield pd.DataFrame(done, columns=names)
        if of:
            yield pd.DataFrame([(*of, *_as_row(held))], columns=names)

    schema = _FRAGMENT.format(kind=kind)
    names = [c.split(" ")[0] for c in schema.split(", ")]
    cuts = long.mapInPandas(cut, f"row long, part long, parts long, id {kind}, low long, high long, base long, context string")
    state = written(cuts.repartition("row", "part").mapInPandas(align, schema), "alignment-ranges")
    most = state.agg(F.max("parts")).first()[0] or 1
    while most > 1:
        near = state.repartition("row", F.floor(F.col("part") / _FAN_IN)).sortWithinPartitions("row", "part")
        state = written(near.mapInPandas(compose, schema), "alignment-round")
        most = -(-most // _FAN_IN)
    return state


def _blocks(docs: DataFrame, tool, kind: str, size: int, keep: bool) -> DataFrame:
    """All documents (_id, _text) in written blocks."""
    schema = _block_schema(kind)

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        own = tool()
        made = _Blocks(f"short-{TaskContext.get().partitionId()}", keep)
        for batch in batches:
            split = [(i, own.split(" " + t) if t and SPACE not in t else []) for i, t in _batched(batch)]
            own.learn(w for _, words in split for w in words)
            for (doc_id, _), found in zip(split, own.closed([words for _, words in split])):
                if (full := made.add(doc_id, found)) is not None:
                    yield full
        if (full := made.flush()) is not None:
            yield full

    def long(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        made = _Blocks(f"long-{TaskContext.get().partitionId()}", keep)
        for batch in batches:
            for r in batch.itertuples(index=False):
                found = _from_row(r)
                if (full := made.add(None if _missing(r.id) else r.id, None if found is None else found.whole())) is not None:
                    yield full
        if (full := made.flush()) is not None:
            yield full

    is_long = F.octet_length("_text") >= size                    # with the space before it, more than one range
    few = docs.where(F.coalesce(~is_long, F.lit(True))).mapInPandas(short, schema)
    many = _fragments(docs.where(is_long).select(F.monotonically_increasing_id().alias("row"), "_id", "_text"), tool, kind, size)
    return written(few.unionByName(many.mapInPandas(long, schema)), "alignment-blocks")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model",
          a_path: str | None = None, b_path: str | None = None, range_bytes: int = RANGE_BYTES, keep_groups: bool = False,
          ) -> tuple[DataFrame, DataFrame]:
    """``(documents, links)`` of a byte-level tokenizer ``a`` over a space and the text, and a piece model ``b`` over the text.

    documents: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    (and ``groups``: the ids of both sides, ``a1,a2|b1;a3|b2,b3``).  links: a_id,
    b_id, documents (that hold the pair linked), best (no pair of a_id is in
    more).  Every token of a group is linked with every token of its other side.

    Null and empty texts, and texts that either side's tokens don't spell byte
    for byte, have no tokens: zeros and empty strings, and they count for no
    pair.  Repeated rows count each; ids may be null or repeat.  An empty table
    gives empty ones.  Other columns of ``docs`` aren't looked at.

    Documents of more than ``range_bytes`` are cut into ranges that separate
    tasks align.  A task holds one block of documents, or one fragment.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    src = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()

    def tool() -> Aligner:
        import public_tokenizers
        files = a_path or public_tokenizers.path(a), b_path or public_tokenizers.path(b)
        return per_worker(("aligner", *files), lambda: Aligner(*files))

    blocks = _blocks(src, tool, kind, range_bytes, keep_groups)
    held = blocks.select("_block", F.posexplode(F.arrays_zip("pairs", "held"))) \
        .select("_block", F.col("pos").alias("_code"), F.col("col.pairs").alias("_pair"), F.col("col.held").alias("_held"))
    counts = written(held.groupBy("_pair").agg(F.sum("_held").alias("documents"))
                     .withColumn("a_id", F.shiftright("_pair", 32)), "alignment-counts")
    highest = counts.groupBy("a_id").agg(F.max("documents").alias("_highest"))      # a row per id of the vocabulary at most
    links = counts.join(highest, "a_id").select("_pair", "a_id", F.col("_pair").bitwiseAND(0xFFFFFFFF).alias("b_id"), "documents",
                                                (F.col("documents") == F.col("_highest")).alias("best"))
    # back to the blocks: a pair that all documents hold has a row per block
    back = held.join(links, "_pair").groupBy("_block").agg(F.collect_list(F.struct("_code", "documents", "best")).alias("_back")) \
        .select("_block", F.col("_back._code").alias("_code"), F.col("_back.documents").alias("_count"), F.col("_back.best").alias("_best"))
    joined = blocks.drop("pairs", "held").join(back, "_block", "left")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                lengths = np.asarray(r["lengths"], dtype=np.int64)
                codes = np.frombuffer(r["codes"], dtype="<u4")
                times = np.frombuffer(r["times"], dtype="<u4" if len(r["times"]) == 4 * len(codes) else "<u8").astype(np.int64)
                at = np.asarray(r["_code"] if r["_code"] is not None else [], dtype=np.int64)
                score = np.zeros((2, len(at)), dtype=np.int64)
                if len(at):
                    score[0, at], score[1, at] = np.asarray(r["_best"]).astype(np.int64), r["_count"]
                sums = [np.append(0, np.cumsum(times * s[codes])) for s in score]
                ends = np.cumsum(lengths)
                best, count = (s[ends] - s[ends - lengths] for s in sums)
                out = pd.DataFrame({"_id": pd.Series(list(r["ids"]), dtype=object), **{c: r[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
                                    "n_best": best, "count_sum": count, "groups_sha256": r["digests"], "groups": r["texts"]})
                yield out if keep_groups else out.drop(columns="groups")

    schema = f"_id {kind}, {_ROW}, n_best long, count_sum long, groups_sha256 string" + ", groups string" * keep_groups
    return joined.mapInPandas(answer, schema).withColumnRenamed("_id", id_col), links.drop("_pair")


def op13(spark, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))[0]
