"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in d bits meet in the middle: some variant of one
within half of d is also a variant of the other within the rest of d.  For an
odd radius of 3 that is one bit from one side and two from the other; as a
pair at an odd distance has one end of either parity, only fingerprints of odd
parity need to emit the wider ball.  All that meet on one variant are linked
through one member of it that lies within the narrow ball, so a bucket gives
as many links as it has members, never all their pairs, and no link is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from govlens.functions.lookup import hot_keys, spread_lookup
from govlens.llm.common import bounded_batches, held, released, row_key, table, written
from govlens.llm.components import connected_components

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Variants that one task emits, and parts of a group of linked fingerprints.
VARIANTS_A_TASK, GROUP_PARTS = 500_000, 32
#: Shingles whose bits are counted at a time.
_CHUNK = 1 << 15


def shingle_hashes(text: str | None, words: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of every word shingle, repeats included; the whole sequence if there are fewer words."""
    # in UTF-8, split() without arguments splits at the six ASCII white-space bytes only
    w = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not w:
        return np.empty(0, dtype="<u8")
    h, join = xxhash.xxh64_intdigest, b" ".join
    shingles = zip(*(w[i:] for i in range(words))) if len(w) >= words else [w]
    return np.fromiter((h(join(s), 42) for s in shingles), dtype="<u8")


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash as a signed long; zero for a text without words."""
    h = shingle_hashes(text, words)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), _CHUNK):
        part = h[i:i + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([fingerprint(t, words) for t in s], dtype="int64")
    return of(text)


def _bit(i: int) -> int:
    return -(1 << 63) if i == 63 else 1 << i


def _active(prints: DataFrame) -> DataFrame:
    """Fingerprints that may have another within 3 bits: a necessary condition, found from 20 keys each.

    Of six parts of the 64 bits, 3 differing bits leave three parts alike; a
    key is what a fingerprint has in three of them.
    """
    edges = (0, 11, 22, 33, 44, 54, 64)
    parts = [sum(_bit(i) for i in range(a, b)) for a, b in zip(edges, edges[1:])]
    masks = F.lit([x | y | z for x, y, z in itertools.combinations(parts, 3)])
    keys = F.transform(masks, lambda m, i: F.xxhash64(i, F.col("f").bitwiseAND(m)))
    tasks = max(1, -(-20 * prints.count() // VARIANTS_A_TASK))
    at = prints.repartition(tasks, "f").select("f", F.explode(keys).alias("k"))
    shared = at.groupBy("k").agg(F.min("f").alias("lo"), F.max("f").alias("hi")).where("lo <> hi").select("k")
    return at.join(shared, "k", "left_semi").select("f").distinct()


def near_links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints connected at ``max_bits`` (0 to 3) or fewer.

    ``prints`` holds distinct longs in column f.  Every link is itself a pair
    within ``max_bits``; pairs that others imply are left out.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    # a variant is known by its number, so that two numbers travel and not two fingerprints: one is random, one small
    masks = [0]
    if max_bits:
        masks += [_bit(i) for i in range(64)]
    narrow = 1 if max_bits <= 1 else 65                      # variants of the narrow ball come first
    if max_bits == 3:
        # two of three differing bits are in the same half: pairs of bits across the halves aren't needed
        masks += [_bit(i) ^ _bit(j) for h in (0, 32) for i in range(h, h + 32) for j in range(i + 1, h + 32)]
    every = F.lit(masks)
    odd = F.bit_count("f") % 2 == 1
    ball = F.transform(F.when(odd, every).otherwise(F.slice(every, 1, F.lit(narrow))), lambda m: F.col("f").bitwiseXOR(m))
    # a small table becomes hundreds of rows for each of its rows: as many tasks as those need
    rows = prints.count() * (len(masks) + narrow) // 2
    parts = max(1, -(-rows // VARIANTS_A_TASK))
    balls = prints.repartition(parts, "f").select(F.posexplode(ball).alias("v", "k"))
    met = balls.withColumn("f", F.col("k").bitwiseXOR(F.element_at(every, F.col("v") + 1)))
    # A variant has at most 2,081 fingerprints within two bits, so a window over its bucket is bounded.  Members of
    # the narrow ball differ from each other in two bits at most, so the least of them stands for all.
    hub = F.min(F.when(F.col("v") < narrow, F.col("f"))).over(Window.partitionBy("k"))
    met = met.withColumn("a", hub).where("a <> f").select("a", F.col("f").alias("b")).distinct()
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def fingerprint_components(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """``f, component`` for the fingerprints that are linked with any other."""
    found = near_links(written(_active(prints), "simhash-active"), max_bits)
    return connected_components(found).select(F.col("node").alias("f"), "component")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: its row key, id, ``fingerprint`` (long), ``group`` and ``component``.

    ``group`` names the documents that are linked through fingerprints at
    ``max_bits`` or fewer, ``component`` is the least id among them.  Null and
    empty texts, and those of white space only, have fingerprint zero and are
    linked like any other.  Repeated rows and equal texts share a fingerprint
    and so a group.  A null id is larger than any other (a group of null ids
    has a null component).  An empty table gives an empty table.
    """
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    at = written(src.select(*row_key("id", "text"), "id", fingerprints(F.col("text"), words).alias("fingerprint")), "simhash-prints")
    # copies collapse first: what is grouped and joined has a row per fingerprint
    prints = written(at.groupBy("fingerprint").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    of = fingerprint_components(prints.select(F.col("fingerprint").alias("f")), max_bits)
    linked = prints.join(of, prints["fingerprint"] == of["f"]).select("fingerprint", "least", F.col("component").alias("group")) \
        .withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.lit(GROUP_PARTS)).cast("int"))
    # a group of many different fingerprints is reduced, and told its least id, in parts
    least = linked.groupBy("group", "salt").agg(F.min("least").alias("least")).groupBy("group").agg(F.min("least").alias("component")) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(GROUP_PARTS - 1))))
    told = linked.join(least, ["group", "salt"]).select(F.col("fingerprint").alias("f"), "group", "component")
    groups = prints.join(told, prints["fingerprint"] == told["f"], "left") \
        .select("fingerprint", F.coalesce("group", "fingerprint").alias("group"), F.when(F.col("f").isNull(), F.col("least"))
                .otherwise(F.col("component")).alias("component"))
    groups = written(groups, "simhash-groups")
    return spread_lookup(at, groups, ["fingerprint"], ["group", "component"], hot_keys(prints, ["fingerprint"], "n"), ["_k1", "_k2", "id"])


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document of least id of each group (a null id only if there is no other; of repeated rows, one)."""
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "_k1", "_k2")).alias("m")) \
        .select("m._k1", "m._k2")
    out = held(docs, _id=id_col, _text=text_col).select("_row", *row_key("_id", "_text")) \
        .join(first, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
    return out.select(*released(docs.columns))


def op4(spark, sf_dir: str) -> DataFrame:
    out = simhash_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))
