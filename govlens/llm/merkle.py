"""Merkle manifest of a dataset, its proofs made by a butterfly exchange.

Every row is a leaf; the leaves of a group (a source) form a tree of a given
fanout, and the groups' roots form another one on top.  A group's leaves are cut
into aligned chunks of ``fanout ** levels``; each chunk hashes its own subtree.
Then the chunks of a group swap roots: in round r a chunk sends the digest of
its ancestor to the chunks that differ from it only in digit r of their number
(written in base ``fanout``), and all of them hash the next ancestor.  They do
so redundantly, but after the last round each holds its whole upper proof and
the root of its group, and nothing has to come down the tree again.

A group whose number of chunks is no power of the fanout is padded with chunks
without a digest, so every chunk sends to ``fanout`` others in each round and
receives from as many, whatever the shape of the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from govlens.llm.common import table, written

#: The columns of a document that its leaf covers, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of the tree inside a chunk: 3 ** 7 leaves are about half a megabyte of digests.
CHUNK_LEVELS = 7
#: Rounds of the exchange between two cuts of the lineage.
_ROUNDS_A_CUT = 4

PROOF = T.ArrayType(T.StructType().add("left", T.StringType()).add("right", T.StringType()))


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def leaf_digest(*columns: Column) -> Column:
    """H of the columns: each ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    text = [c.cast("string") for c in columns]
    return digest(F.concat(*[F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
                             for s in text]))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def _joined(a: DataFrame, b: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Null-safe equi-join on columns of the same name; the left side's stay."""
    b = b.select(*[F.col(c).alias(f"_r{c}" if c in keys else c) for c in b.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys]
    return a.join(b, on, how).drop(*[f"_r{k}" for k in keys])


def _chunks(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Written chunks of ``leaves`` (_group, _id, _leaf, _kept, _seq): their leaves in order, and all levels over them.

    Leaves are range-partitioned by their full order, which is unique, so
    neither a large group nor repeated rows end up in one task; a leaf's index
    in its group is the group's count in the partitions before plus its place
    in its own.
    """
    spark = leaves.sparkSession
    order = ["_group", "_id", "_leaf", "_seq"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written: a second evaluation could draw other range bounds
    ranged = written(leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_seq")
                     .withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted") \
        .withColumn("_part", F.shiftright("_at", 33))
    spans = ranged.groupBy("_part", "_group").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy("_group")                        # a row per partition that holds the group
    spans = spans.select("_part", "_group", "_first", F.sum("_n").over(group).alias("_size"),
                         (F.sum("_n").over(group.orderBy("_part")) - F.col("_n")).alias("_before"))
    width = fanout ** levels
    at = _joined(ranged, spans, "_part", "_group").withColumn("_index", F.col("_before") + F.col("_at") - F.col("_first"))
    rows = F.sort_array(F.collect_list(F.struct("_index", "_id", "_leaf", "_kept")))        # width rows at most
    chunks = at.groupBy("_group", F.floor(F.col("_index") / width).alias("_chunk")) \
        .agg(F.max("_size").alias("_size"), rows.alias("_rows"))
    # a group of one chunk stops at its root; otherwise every chunk has all levels, a short last one too
    depth = sum((F.col("_size") > fanout ** t).cast("int") for t in range(levels))

    def above(nodes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int")),
                           lambda i: digest(F.concat_ws("", F.slice(nodes, i * fanout + 1, F.lit(fanout)))))

    tree = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.array(F.transform("_rows", lambda r: r["_leaf"])),
                       lambda found, _: F.concat(found, F.array(above(F.element_at(found, -1)))))
    return written(chunks.withColumn("_depth", depth).withColumn("_tree", tree)
                   .withColumn("_root", F.element_at(F.element_at("_tree", F.col("_depth") + 1), 1))
                   .withColumn("_chunks", F.ceil(F.col("_size") / width)), "merkle-chunks")


def _butterfly(chunks: DataFrame, fanout: int) -> DataFrame:
    """Per chunk (_group, _chunk) the root of its group and the proof from the chunk's root up to it; written."""
    most = chunks.agg(F.max("_chunks")).first()[0] or 1
    powers = [1]
    while powers[-1] < most:
        powers.append(powers[-1] * fanout)
    least = F.array_min(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p >= F.col("_chunks")))
    real = chunks.select("_group", "_chunk", "_chunks", least.alias("_padded"), F.col("_root").alias("_digest"))
    more = F.col("_chunk") + F.col("_chunks")
    empty = real.where(more < F.col("_padded")) \
        .select("_group", F.explode(F.sequence(more, F.col("_padded") - 1, F.col("_chunks"))).alias("_chunk"),
                "_chunks", "_padded", F.lit(None).cast("string").alias("_digest"))
    state = real.unionByName(empty).withColumn("_proof", F.array().cast(PROOF)) if len(powers) > 1 else \
        real.withColumn("_proof", F.array().cast(PROOF))
    for r, step in enumerate(powers[:-1]):
        live = F.col("_padded") > step
        digit = F.floor(F.col("_chunk") / step) % fanout
        others = F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda d: F.col("_chunk") + (d - digit) * step)
        sent = state.select("_group", "_chunk", "_chunks", "_padded", "_digest", "_proof", digit.alias("_digit"),
                            F.explode(F.when(live, others).otherwise(F.array("_chunk"))).alias("_to"))
        own = F.col("_to") == F.col("_chunk")
        got = sent.groupBy("_group", F.col("_to").alias("_chunk")).agg(
            F.max("_chunks").alias("_chunks"), F.max("_padded").alias("_padded"),
            F.max(F.when(own, F.col("_digest"))).alias("_digest"), F.max(F.when(own, F.col("_proof"))).alias("_proof"),
            *[F.max(F.when(F.col("_digit") == d, F.col("_digest"))).alias(f"_d{d}") for d in range(fanout)])
        run = F.array(*[f"_d{d}" for d in range(fanout)])
        side = F.struct(F.concat_ws("", F.slice(run, 1, digit.cast("int"))).alias("left"),
                        F.concat_ws("", F.slice(run, (digit + 2).cast("int"), F.lit(fanout))).alias("right"))
        parent = F.when(F.size(F.array_compact(run)) > 0, digest(F.concat_ws("", run)))
        state = got.select("_group", "_chunk", "_chunks", "_padded", F.when(live, parent).otherwise(F.col("_digest")).alias("_digest"),
                           F.when(live, F.concat("_proof", F.array(side))).otherwise(F.col("_proof")).alias("_proof"))
        if r % _ROUNDS_A_CUT == _ROUNDS_A_CUT - 1:
            state = written(state, "merkle-round")
    return written(state.where(F.col("_chunk") < F.col("_chunks"))
                   .select("_group", "_chunk", F.col("_digest").alias("_top"), "_proof"), "merkle-tops")


def _leaves(chunks: DataFrame, tops: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A row per leaf: _group, _id, _leaf, _kept, the columns of ``tops`` but the proof, and the leaf's whole proof."""
    def within(j: Column) -> Column:
        steps = []
        for t in range(levels):
            nodes, at = F.element_at("_tree", t + 1), F.floor(j / fanout ** t).cast("int")
            first, digit = F.floor(at / fanout).cast("int") * fanout, at % fanout
            steps.append(F.struct(F.concat_ws("", F.slice(nodes, first + 1, digit)).alias("left"),
                                  F.concat_ws("", F.slice(nodes, at + 2, fanout - 1 - digit)).alias("right")))
        return F.concat(F.slice(F.array(*steps), F.lit(1), F.col("_depth")), F.col("_proof"))

    others = [c for c in tops.columns if c not in ("_group", "_chunk", "_proof")]
    each = F.transform("_rows", lambda r, j: F.struct(r["_id"].alias("_id"), r["_leaf"].alias("_leaf"), r["_kept"].alias("_kept"),
                                                      within(j).alias("_proof")))
    return _joined(chunks, tops, "_group", "_chunk") \
        .select("_group", *others, F.explode(each).alias("_of")).select("_group", *others, "_of.*")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS,
             fanout: int = 3, levels: int = CHUNK_LEVELS, **kept: Column) -> DataFrame:
    """Every row's leaf, the root of its group, the root of all, and its proof.

    Returns ``id_col``, ``group_col``, leaf, subroot, root, proof (an array of
    ``left`` and ``right``: the digests beside the node, from the leaf up) and
    a column for each expression in ``kept``.  ``fold(leaf, proof)`` gives the
    root for an untouched row and something else for any other.

    Leaves ascend by id in their group, null first; rows of equal id ascend by
    leaf, so repeated rows are leaves each and the result has no choice in it.
    Rows without a group are a group of their own, the first one.  Nulls and
    empty strings in a field differ.  A single leaf is its group's root, and a
    single group's root is the root.  An empty table gives an empty one.  Other
    columns of ``docs`` aren't looked at, whatever their names.

    Texts are read once; what moves is an id, a group, a leaf and ``kept``.
    """
    if fanout < 2 or levels < 1:
        raise ValueError("a tree needs a fanout of 2 and a level at least")
    src = docs.select(F.col(f"`{group_col}`").alias("_group"), F.col(f"`{id_col}`").alias("_id"),
                      leaf_digest(*[F.col(f"`{c}`") for c in fields]).alias("_leaf"),
                      F.struct(F.lit(0).alias("_none"), *[c.alias(k) for k, c in kept.items()]).alias("_kept"),
                      F.monotonically_increasing_id().alias("_seq"))
    chunks = _chunks(written(src, "merkle-leaves"), fanout, levels)
    tops = _butterfly(chunks, fanout)
    groups = tops.where("_chunk = 0").select(F.lit(0).alias("_group"), F.col("_group").alias("_id"), F.col("_top").alias("_leaf"),
                                             F.struct(F.lit(0).alias("_none")).alias("_kept"), F.lit(0).alias("_seq"))
    over = _chunks(groups, fanout, levels)
    upper = _leaves(over, _butterfly(over, fanout), fanout, levels) \
        .select(F.col("_id").alias("_group"), F.col("_top").alias("_all"), F.col("_proof").alias("_upper"))
    whole = _joined(tops, upper, "_group").select("_group", "_chunk", "_top", "_all", F.concat("_proof", "_upper").alias("_proof"))
    return _leaves(chunks, whole, fanout, levels).select(
        F.col("_id").alias(id_col), F.col("_group").alias(group_col), F.col("_leaf").alias("leaf"), F.col("_top").alias("subroot"),
        F.col("_all").alias("root"), F.col("_proof").alias("proof"), *[F.col("_kept")[k].alias(k) for k in kept])


def op11(spark, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, checked against rows of which about half lost their line breaks."""
    docs = table(spark, sf_dir, "documents")
    touched = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    changed = leaf_digest(*[F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS])
    found = manifest(docs, altered=F.when(touched, changed))
    folded = fold(F.coalesce("altered", "leaf"), F.col("proof"))
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        digest(F.concat_ws("", F.transform("proof", lambda s: F.concat(s["left"], s["right"])))).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_leaf(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS odd
  FROM documents
),
hashed AS (
  SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor(odd, 4294967295) % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")} END AS altered
  FROM crc
),
d AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS s
  FROM hashed
),
low AS (
  SELECT 0 AS t, s, i, leaf AS h, n FROM d
  UNION ALL
  SELECT any_value(t) + 1, s, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM low WHERE n > 1 GROUP BY s, i // 3
),
subs AS (SELECT s, h, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS t, s AS i, h, n FROM subs
  UNION ALL
  SELECT any_value(t) + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM high WHERE n > 1 GROUP BY i // 3
),
beside AS (
  SELECT d.s, d.i, low.t, low.h, low.i AS j, d.i // (3 ** low.t)::BIGINT AS own
  FROM d JOIN low ON low.s = d.s AND low.n > 1 AND low.i // 3 = d.i // (3 ** (low.t + 1))::BIGINT
  UNION ALL
  SELECT d.s, d.i, 100 + high.t, high.h, high.i, d.s // (3 ** high.t)::BIGINT
  FROM d JOIN high ON high.n > 1 AND high.i // 3 = d.s // (3 ** (high.t + 1))::BIGINT
),
steps AS (
  SELECT s, i, row_number() OVER (PARTITION BY s, i ORDER BY t) AS k,
    coalesce(string_agg(h, '' ORDER BY j) FILTER (j < own), '') AS l, coalesce(string_agg(h, '' ORDER BY j) FILTER (j > own), '') AS r
  FROM beside GROUP BY s, i, t
),
folded AS (
  SELECT 0 AS k, s, i, coalesce(altered, leaf) AS h FROM d
  UNION ALL
  SELECT f.k + 1, f.s, f.i, sha256(p.l || f.h || p.r) FROM folded f JOIN steps p ON p.s = f.s AND p.i = f.i AND p.k = f.k + 1
),
ends AS (SELECT s, i, arg_max(h, k) AS h FROM folded GROUP BY s, i),
proofs AS (SELECT s, i, string_agg(l || r, '' ORDER BY k) AS p FROM steps GROUP BY s, i)
SELECT d.doc_id, d.leaf, subs.h AS subroot, high.h AS root, sha256(coalesce(proofs.p, '')) AS proof_sha256,
  ends.h AS folded_root, ends.h = high.h AS verified
FROM d JOIN subs ON subs.s = d.s JOIN high ON high.n = 1 JOIN ends ON ends.s = d.s AND ends.i = d.i
LEFT JOIN proofs ON proofs.s = d.s AND proofs.i = d.i
"""
