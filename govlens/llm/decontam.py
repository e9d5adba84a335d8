"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of e edits is cut into e + 1 pieces: a
passage within the budget holds one of them unchanged.  All pieces of a block
of items are searched in one pass over a text; a hit is checked against ever
larger parts of the item, each with its share of the budget, and the whole
item is verified by Myers' bit-parallel edit distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.window import Window

from govlens.llm.common import bounded_batches, released, row_key, table, written
from govlens.session import shared_path

_OTHER = re.compile(r"[\W_]+")


def normalize(text: str | None) -> str:
    """Lower-case letters and digits; everything between them is one space, and one stands at either end."""
    return f" {_OTHER.sub(' ', (text or '').lower()).strip()} "


def myers(pattern_bits: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """The least edit distance of a pattern of ``m`` characters to any part of ``text``, and where such a part ends first.

    ``pattern_bits`` has a bit for every place of a character in the pattern.
    """
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, at = mask, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = pattern_bits.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & mask, pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, at = score, j
        ph, mh = ph << 1 & mask, mh << 1 & mask
        pv, mv = mh | ~(xv | ph) & mask, ph & xv
    return best, at


def bits_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


@dataclass(slots=True)
class Part:
    """Characters start..end of an item, to be found with ``budget`` edits at most; parts of budget 0 are the pieces.

    Halves share the budget less one: more edits than its share in either half
    make more than the whole budget.
    """

    start: int
    end: int
    budget: int
    parent: Part | None = None
    sibling: Part | None = None
    bits: dict[str, int] | None = None

    def pieces(self) -> list[Part]:
        if not self.budget:
            return [self]
        left = (self.budget - 1) // 2
        right = self.budget - 1 - left
        cut = self.start + (self.end - self.start) * (left + 1) // (self.budget + 1)
        a, b = Part(self.start, cut, left, self), Part(cut, self.end, right, self)
        a.sibling, b.sibling = b, a
        return a.pieces() + b.pieces()


class Item:
    def __init__(self, ident, text: str, error_rate: float):
        self.ident, self.text = ident, text
        # the two spaces around an item aren't part of its length
        self.budget = min(int(error_rate * (len(text) - 2)), len(text) - 1)
        self.root = Part(0, len(text), self.budget)

    def _plausible(self, part: Part, budget: int, text: str, diagonal: int) -> bool:
        """Of budget + 1 pieces of ``part``, one stands within ``budget`` of its place: else it can't match."""
        n = budget + 1
        for i in range(n):
            s = part.start + (part.end - part.start) * i // n
            t = part.start + (part.end - part.start) * (i + 1) // n
            low = max(0, diagonal + s - budget)
            if text.find(self.text[s:t], low, max(low, diagonal + t + budget)) >= 0:
                return True
        return False

    def verify(self, piece: Part, text: str, diagonal: int) -> tuple[int, int, int] | None:
        """Distance, start and end of the item near a piece that was found; diagonal is where the item would begin."""
        n = len(self.text)
        if diagonal >= 0 and text.startswith(self.text, diagonal):
            return 0, diagonal, diagonal + n
        part, found = piece, None
        while part.parent is not None:
            up = part.parent
            if not self._plausible(part.sibling, up.budget, text, diagonal):
                return None
            if up.bits is None:
                up.bits = bits_of(self.text[up.start:up.end])
            low = max(0, diagonal + up.start - up.budget)
            found = myers(up.bits, up.end - up.start, text[low:max(low, diagonal + up.end + up.budget)])
            if found[0] > up.budget:
                return None
            part = up
        if found is None:                                   # no budget: the piece is the item
            return 0, diagonal, diagonal + n
        end = low + found[1]
        back = text[low:end][::-1]
        return found[0], end - myers(bits_of(self.text[::-1]), n, back)[1], end


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float):
        import ahocorasick
        self._search = ahocorasick.Automaton()
        for ident, text in items:
            item = Item(ident, text, error_rate)
            for piece in item.root.pieces():
                s = text[piece.start:piece.end]
                self._search.add_word(s, self._search.get(s, []) + [(item, piece)])
        if items:
            self._search.make_automaton()

    def find(self, text: str | None) -> list[tuple]:
        """(item, distance, start, end) per item that the text holds: the closest place, then the first."""
        t = normalize(text)
        best: dict[int, tuple] = {}
        done: dict[int, list[int]] = {}
        for end, held in self._search.iter(t):
            for item, piece in held:
                key, diagonal = id(item), end + 1 - piece.end
                known = best.get(key)
                # a place that was verified is not verified again from its other pieces
                if known and (known[1] == 0 or any(abs(diagonal - d) <= item.budget for d in done[key])):
                    continue
                got = item.verify(piece, t, diagonal)
                if got:
                    done.setdefault(key, []).append(diagonal)
                    if not known or got < known[1:]:
                        best[key] = (item.ident, *got)
        return sorted(best.values(), key=lambda x: (str(x[0]), x))


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", error_rate: float = 0.1, block_chars: int = 4_000_000) -> DataFrame:
    """``docs`` plus ``_hits``: an array of (item, distance, start, end) for the items found in a document.

    An item is found if some part of the document is within ``error_rate`` of
    the item's length in edits, both normalised (see ``normalize``; start and
    end count characters of the normalised text).  Items match whole words.
    Whole texts are searched.  A null or empty text holds nothing (an empty
    array); an item that is null or has no letter or digit is in no text; items
    that repeat an id or a text are found each for itself; an empty table of
    items leaves every array empty.

    Items are numbered into blocks of about ``block_chars`` characters in
    Spark.  Each block makes one pass over the documents, which are not moved:
    what it finds is written, and joined to the documents at the end.  The
    driver and a worker hold one block, whatever the number of items is.
    """
    kind = items.schema[item_col].dataType
    found = find_hits(docs, items, text_col, item_col, item_text_col, error_rate, block_chars)
    none = F.from_json(F.lit("[]"), hits_type(kind))
    keyed = docs.select(*_keys(docs), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    if found is None:
        return keyed.select(*released(docs.columns, _hits=none))
    all_of = found.dropDuplicates(["_k1", "_k2", "_block"]).groupBy("_k1", "_k2") \
        .agg(F.sort_array(F.flatten(F.collect_list("hits"))).alias("_found"))       # a document's own hits
    return keyed.join(all_of, ["_k1", "_k2"], "left").select(*released(docs.columns, _hits=F.coalesce("_found", none)))


def hits_type(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType().add("item", kind).add("distance", T.IntegerType())
                       .add("start", T.IntegerType()).add("end", T.IntegerType()))


def _keys(docs: DataFrame) -> list:
    """A key of a row's content; only rows that repeat whole share one."""
    return row_key(*[f"`{f.name}`" for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def item_blocks(items: DataFrame, item_col: str, item_text_col: str, block_chars: int, part_blocks: int = 64) -> DataFrame:
    """``_block, ident, text`` of all items with a letter or digit, written by block.

    Prefix sums of the items' lengths, in parts of ``part_blocks`` blocks or so
    by a hash, give the blocks: one of them holds the items that begin within
    its ``block_chars`` characters.
    """
    @F.pandas_udf(T.StringType())
    def normal(s: pd.Series) -> pd.Series:
        return pd.Series([normalize(t) for t in s.where(s.notna(), None)], index=s.index, dtype=object)

    src = items.select(F.col(item_col).alias("ident"), normal(item_text_col).alias("text")).where("trim(text) <> ''")
    src = written(src.withColumn("_at", F.monotonically_increasing_id()), "benchmark-items")
    chars = src.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-chars // (part_blocks * block_chars)))
    sizes = src.select("_at", F.length("text").alias("n"), F.pmod(F.xxhash64("_at"), F.lit(parts)).alias("_part"))
    before = F.sum("n").over(Window.partitionBy("_part").orderBy("_at")) - F.col("n")
    of = sizes.select("_at", F.concat_ws("-", "_part", F.floor(before / block_chars)).alias("_block"))
    path = shared_path(items.sparkSession, "benchmark-blocks")
    out = src.join(of, "_at").drop("_at")
    out.repartition("_block").write.partitionBy("_block").parquet(path)
    return items.sparkSession.read.schema(out.schema).parquet(path)


def find_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
              error_rate: float = 0.1, block_chars: int = 4_000_000) -> DataFrame | None:
    """``_k1, _k2, _block, hits`` for the documents that hold items of a block, written; None without items.

    One job for each block, of one and the same plan.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = item_blocks(items, item_col, item_text_col, block_chars)
    hits = hits_type(items.schema[item_col].dataType)
    src = docs.select(*_keys(docs), F.col(f"`{text_col}`").alias("_text"))
    schema = f"_k1 long, _k2 long, _block string, hits {hits.simpleString()}"
    path, first = shared_path(spark, "benchmark-hits"), True

    def finder(name: str, block: list):
        def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            matcher = Matcher(block, error_rate)
            for b in batches:
                rows = []
                for k1, k2, t in zip(b["_k1"], b["_k2"], b["_text"]):
                    if (got := matcher.find(t)):
                        rows.append((k1, k2, name, [dict(zip(("item", "distance", "start", "end"), h, strict=True)) for h in got]))
                yield pd.DataFrame(rows, columns=["_k1", "_k2", "_block", "hits"])
        return find

    for name in sorted(r[0] for r in blocks.select("_block").distinct().collect()):      # a name per block
        block = [(r[0], r[1]) for r in blocks.where(F.col("_block") == name).select("ident", "text").collect()]
        src.mapInPandas(finder(name, block), schema).write.mode("overwrite" if first else "append").parquet(path)
        first = False
    return None if first else spark.read.schema(schema).parquet(path)


def op9(spark, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.explode("_hits").alias("h")).select(
        "doc_id", F.col("h.item").alias("item_id"), F.col("h.distance").alias("distance"),
        F.col("h.start").alias("start"), F.col("h.end").alias("end"))
