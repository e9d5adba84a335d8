"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the model's compiled character map: at each place the
longest prefix that the map knows is replaced, and every byte of the result
remembers the byte of the original that it comes from.  Pieces are found in the
normalised text, so a piece's bytes there, sent back through that alignment,
give its span of bytes in the original.

Merges can't cross a place that no piece of the vocabulary spans, so a text is
encoded by its stretches between such places (words with the space before
them, runs of characters that no longer piece holds), which repeat and are
kept in a bounded cache.  The library itself encodes them, without
normalising again, and decodes whole texts.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlens.llm.common import bounded_batches, per_worker, table

SPACE = "▁"
#: Letters, to any splitter, that marks are parted from.
LETTERS = frozenset(string.ascii_letters + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])))
#: Entries of the cache of encoded stretches, and the longest one that is kept in it.
CACHE_ENTRIES, CACHE_CHARS = 1_000_000, 64
#: Characters of text that are encoded at a time; a longer text is a batch of its own.
_BATCH_CHARS = 1 << 21
#: Field numbers of the model file (protocol buffers) and kinds of pieces.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_MAP, _DUMMY_PREFIX, _REMOVE_EXTRA, _ESCAPE = 2, 3, 4, 5
_SPACE_AS_SUFFIX = 24
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffers message, in order."""
    i = 0

    def varint() -> int:
        nonlocal i
        x = shift = 0
        while True:
            byte = data[i]
            i += 1
            x |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return x

    while i < len(data):
        key = varint()
        if key & 7 == 0:
            value = varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            value = data[i:i + n]
            i += n
        yield key >> 3, value


def marks_after_no_letter(names: list[str]) -> list[str]:
    """ASCII marks that follow a letter in none of the pieces."""
    after = {y for n in names for x, y in zip(n, n[1:]) if x in LETTERS}
    return [c for c in string.punctuation if c not in after]


class CharacterMap:
    """A compiled map: a double array over the UTF-8 bytes of the prefixes, and the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        n = int.from_bytes(blob[:4], "little")
        self._units = np.frombuffer(blob, dtype="<u4", count=n // 4, offset=4).tolist()
        self._texts = blob[4 + n:]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest known prefix of ``data[at:]`` and that prefix's length."""
        units, found, length = self._units, None, 0
        node = self._jump(units[0])
        for k in range(at, len(data)):
            node ^= data[k]
            unit = units[node]
            if unit & 0x800000FF != data[k]:          # the label of another byte, or of a value
                break
            node ^= self._jump(unit)
            if unit >> 8 & 1:                         # a prefix ends here: the value is the node itself
                found, length = units[node] & 0x7FFFFFFF, k + 1 - at
        return None if found is None else (self._texts[found:self._texts.index(0, found)], length)

    @staticmethod
    def _jump(unit: int) -> int:
        return unit >> 10 << (8 if unit & 512 else 0)


class Normalizer:
    """Normalised text and its alignment, from the bytes of a model's normaliser settings."""

    def __init__(self, settings: bytes):
        got = dict(wire_fields(settings))
        self.map = CharacterMap(got[_MAP]) if got.get(_MAP) else None
        self.prefix, self.squeeze, self.escape = (bool(got.get(k, 1)) for k in (_DUMMY_PREFIX, _REMOVE_EXTRA, _ESCAPE))

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, an offset into the bytes of ``text``."""
        data = text.encode()
        space = SPACE.encode() if self.escape else b" "
        if self.map is None and not self.squeeze:
            source = np.frombuffer(data, dtype=np.uint8)
            align = np.repeat(np.arange(len(data)), np.where(source == 32, len(space), 1))
            out, end = data.replace(b" ", space), len(data)
            lead = 0
        else:
            parts, starts, lead, end = self._parts(data)
            widths = [len(p) + (len(space) - 1) * p.count(b" ") for p in parts]
            align = np.repeat(np.asarray(starts, dtype=np.int64), widths)
            out = b"".join(parts).replace(b" ", space)
        if self.prefix and (out if self.squeeze else data):
            out, align = space + out, np.concatenate([np.full(len(space), lead), align])
        return out.decode(), np.append(align, end)

    def _parts(self, data: bytes) -> tuple[list[bytes], list[int], int, int]:
        """Replaced prefixes and where each began, where the leading spaces end, and the end; extra spaces are gone."""
        parts, starts, at, lead, spaced = [], [], 0, 0, self.squeeze
        while at < len(data):
            hit = self.map.longest(data, at) if self.map else None
            if hit is None:                           # a character as it is
                n = 1
                while at + n < len(data) and data[at + n] & 0xC0 == 0x80:
                    n += 1
                hit = data[at:at + n], n
            part = hit[0].lstrip(b" ") if spaced else hit[0]
            if part:
                parts.append(part)
                starts.append(at)
                spaced = self.squeeze and part.endswith(b" ")
            if self.squeeze and at == lead and hit[0] == b" ":
                lead += hit[1]
            at += hit[1]
        end = len(data)
        while self.squeeze and parts and parts[-1].endswith(b" "):
            kept = parts[-1].rstrip(b" ")
            end = starts[-1]
            if kept:
                parts[-1] = kept
                break
            parts.pop()
            starts.pop()
        return parts, starts, lead, end


class PieceEncoder:
    """Ids, spans and decoded texts by a model with byte pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        with open(path, "rb") as f:
            proto = f.read()
        self._library = SentencePieceProcessor(model_proto=proto)
        fields = list(wire_fields(proto))
        for k, v in fields:
            if k == _TRAINER and dict(wire_fields(v)).get(_SPACE_AS_SUFFIX):
                raise ValueError("models with spaces as suffixes aren't supported")
        self.normalize = Normalizer(b"".join(v for k, v in fields if k == _NORMALIZER))
        # later settings win: the same model, but for texts that are normalised already
        off = bytes([_MAP << 3 | 2, 0, _DUMMY_PREFIX << 3, 0, _REMOVE_EXTRA << 3, 0, _ESCAPE << 3, 0])
        self._bare = SentencePieceProcessor(model_proto=proto + bytes([_NORMALIZER << 3 | 2, len(off)]) + off)
        kinds = [dict(wire_fields(v)).get(3, _NORMAL) for k, v in fields if k == _PIECE]
        names = [self._library.id_to_piece(i) for i in range(len(kinds))]
        if _BYTE not in kinds:
            raise ValueError("without byte pieces, the length of an unknown token isn't known")
        #: Normalised bytes that each token covers.
        self.lengths = np.array([{_NORMAL: len(n.encode()), _BYTE: 1}.get(k, 0) for n, k in zip(names, kinds)], dtype=np.int64)
        self.begin, self.end = self._library.bos_id(), self._library.eos_id()
        self._cut = self._cutter([n for n, k in zip(names, kinds) if k == _NORMAL], set(kinds))
        self._known: dict[str, bytes] = {}
        self._names, self._kinds = names, kinds

    def token_bytes(self) -> list[bytes]:
        """The bytes that each token stands for in a text that the model leaves as it is; none for marks."""
        return [{_NORMAL: n.replace(SPACE, " ").encode(), _BYTE: bytes([int(n[3:-1], 16)]) if k == _BYTE else b""}.get(k, b"")
                for n, k in zip(self._names, self._kinds)]

    def cuts_before(self, chars: str) -> bool:
        """Whether no piece goes on with one of ``chars`` after any other character, so that a text may be cut there."""
        inner = set("".join(n.lstrip(SPACE) for n, k in zip(self._names, self._kinds) if k == _NORMAL and len(n) > 1))
        return self._cut is not None and not inner.intersection(chars.replace(" ", SPACE))

    def cuts_after_letters(self) -> str:
        """The marks that no piece has after a letter of ``LETTERS``, so that a text may be cut between the two."""
        return "".join(marks_after_no_letter([n for n, k in zip(self._names, self._kinds) if k == _NORMAL])) if self._cut else ""

    def plain_ids(self, normals: list[str]) -> list[list[int]]:
        """The library's ids of normalised texts."""
        return self._bare.encode(normals, num_threads=1)

    @staticmethod
    def _cutter(names: list[str], kinds: set[int]):
        """A pattern of stretches whose borders no piece spans; None if only whole texts are safe.

        A stretch ends before a space that follows anything else, around
        characters that no longer piece holds, and between a letter and a mark
        that no piece has after one.
        """
        if kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or any(SPACE in n.lstrip(SPACE) for n in names):
            return None
        inner = set("".join(n for n in names if len(n) > 1)) - {SPACE}
        alone = f"[^{SPACE}{re.escape(''.join(sorted(inner)))}]+"
        marks = inner.intersection(marks_after_no_letter(names))
        letters = inner.intersection(LETTERS)
        others = inner - letters - marks
        both, mark_free, letter = (f"[{re.escape(''.join(sorted(x)))}]" if x else "(?!)" for x in (others | marks, others, letters))
        return re.compile(f"{alone}|{SPACE}*{both}*{letter}*(?:{mark_free}{both}*{letter}*)*")

    def _split(self, normal: str) -> list[str]:
        if not self._cut:
            return [normal] if normal else []
        return [s for s in self._cut.findall(normal) if s]

    def ids(self, normals: list[str]) -> list[bytes]:
        """Per normalised text its ids as little-endian unsigned 32-bit numbers."""
        split = [self._split(t) for t in normals]
        wanted = set().union(*split)
        missing = wanted.difference(self._known)
        if len(self._known) + len(missing) > CACHE_ENTRIES:
            self._known, missing = {}, wanted
        new = list(missing)
        self._known.update((s, np.asarray(x, dtype="<u4").tobytes()) for s, x in zip(new, self._bare.encode(new, num_threads=1)))
        out = [b"".join(map(self._known.__getitem__, s)) for s in split]
        for s in new:
            if len(s) > CACHE_CHARS:
                del self._known[s]
        return out

    def spans(self, ids: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end byte, in the original text, of each token."""
        ends = np.cumsum(self.lengths[ids])
        if (ends[-1] if len(ends) else 0) != len(align) - 1:
            raise ValueError("the tokens don't cover the normalised text")
        return align[ends - self.lengths[ids]], align[ends]

    def decode(self, ids: list[bytes]) -> list[str]:
        return self._library.decode([np.frombuffer(x, dtype="<u4").tolist() for x in ids], num_threads=1) if ids else []


#: What ``encode`` can return for a text: type, and how it is made of (ids, begins, ends, decoded).
OUTPUTS = {
    "n_tokens": ("long", lambda ids, b, e, t: len(ids)),
    "ids": ("array<int>", lambda ids, b, e, t: ids.astype(np.int32)),
    "begins": ("array<long>", lambda ids, b, e, t: b),
    "ends": ("array<long>", lambda ids, b, e, t: e),
    "decoded": ("string", lambda ids, b, e, t: t),
    "ids_sha256": ("string", lambda ids, b, e, t: hashlib.sha256(ids.tobytes()).hexdigest()),
    "decoded_sha256": ("string", lambda ids, b, e, t: hashlib.sha256(t.encode()).hexdigest()),
    "spans_crc32": ("long", lambda ids, b, e, t: zlib.crc32(np.stack([b, e], axis=1).astype("<u8").tobytes())),
}


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = "piece_bpe_32k.model", begin: bool = True,
           end: bool = True, outputs: tuple[str, ...] = ("n_tokens", "ids", "begins", "ends", "decoded"), path: str | None = None) -> DataFrame:
    """A row per row of ``docs``: its id and the ``outputs`` asked for.

    ids are the library's; begins and ends are each token's span of bytes in
    the original text (begin and end marks: nothing, at its start and end; a
    replaced character belongs to the token with its last byte); decoded is
    the library's decoding of the ids.  A null text is an empty one and has only
    the marks.  Repeated rows and null ids stay as they are; an empty table
    gives an empty one.  Other columns of ``docs`` aren't looked at.  Nothing is
    shuffled; a worker holds two million characters of texts, or one longer text.

    ``path`` names the model file on every machine; without it the installed
    public file ``model`` is taken.
    """
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    makers = [OUTPUTS[c][1] for c in outputs]
    decodes = any(c.startswith("decoded") for c in outputs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers
        file = path or public_tokenizers.path(model)
        tool = per_worker(("pieces", file), lambda: PieceEncoder(file))
        head = np.asarray([tool.begin] * begin, dtype="<u4").tobytes()
        tail = np.asarray([tool.end] * end, dtype="<u4").tobytes()
        for batch in batches:
            texts = batch["_text"].fillna("")
            cut = np.cumsum(texts.str.len().to_numpy()) // _BATCH_CHARS
            for k in np.unique(cut):
                at = np.flatnonzero(cut == k)
                normal = [tool.normalize(t) for t in texts.iloc[at]]
                found = [head + x + tail for x in tool.ids([n for n, _ in normal])]
                decoded = tool.decode(found) if decodes else [""] * len(found)
                rows = []
                for raw, (_, align), text in zip(found, normal, decoded, strict=True):
                    ids = np.frombuffer(raw, dtype="<u4")
                    begins, ends = tool.spans(ids, align)
                    rows.append([f(ids, begins, ends, text) for f in makers])
                out = pd.DataFrame(rows, columns=list(outputs))
                out.insert(0, "_id", batch["_id"].iloc[at].to_numpy())
                yield out

    kind = src.schema["_id"].dataType.simpleString()
    schema = ", ".join([f"_id {kind}", *[f"{c} {OUTPUTS[c][0]}" for c in outputs]])
    return src.mapInPandas(run, schema).withColumnRenamed("_id", id_col)


def op12(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), outputs=("n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"))
