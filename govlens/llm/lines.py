"""Line dedup: lines that occur in many documents are dropped from all of them.

Normalised lines are exploded as 128-bit hashes (the text itself is not
exploded), the distinct documents of each hash are counted, hashes over the
threshold give dropped positions, and each document is reassembled from the
positions that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govlens.llm.common import ASCII_SPACE, ascii_lower, held, released, row_key, table, written


def line_array(text: Column) -> Column:
    """The lines of a text, split at line feeds; null and empty give one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """What makes two lines equal: stripped of ASCII white space, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """Drop every line whose key has ``min_chars`` characters or more and is in ``min_docs`` documents or more.

    Returns all columns of ``docs`` with ``text_col`` replaced by the kept
    lines (never null), plus ``_n_lines`` and ``_n_dropped``.  One row comes
    back per input row.  A null or empty text is one empty line; lines with a
    key shorter than ``min_chars`` always stay; a line that is repeated inside
    one document counts once; rows that repeat an id count as one document; a
    null id counts as one document; an empty table gives an empty table.  A
    document that loses all its lines keeps its row with an empty text.

    Plan: the hashes of a document's distinct lines are aggregated per (line,
    document) and then per line, both with partial aggregation, so a line that
    is in every document never lands whole in a task.  The hashes to drop are
    joined back to the positions by sort-merge join (whose skewed partitions
    Spark splits), and a document's text is moved once.
    """
    src = held(docs, _id=id_col, _text=text_col).select("*", *row_key("_id", "_text"))
    keys = F.transform(line_array(F.col("_text")), line_key)
    hashes = F.transform(keys, lambda k: F.struct(
        F.xxhash64(F.lit(1), k).alias("a"), F.xxhash64(F.lit(2), k).alias("b"),
        (F.char_length(k) >= min_chars).alias("long")))
    at = src.select("_k1", "_k2", "_id", F.posexplode(hashes).alias("_pos", "_h")) \
        .where("_h.long").select("_k1", "_k2", "_id", "_pos", F.col("_h.a").alias("_a"), F.col("_h.b").alias("_b"))
    frequent = at.select("_a", "_b", "_id").distinct() \
        .groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")) \
        .where(F.col("_n") >= min_docs).select("_a", "_b")
    # written: its size is then known, and a join that shuffles has both sides to split where one line is in most documents
    frequent = written(frequent, "frequent-lines")
    drops = at.join(frequent, ["_a", "_b"]).groupBy("_k1", "_k2").agg(F.collect_set("_pos").alias("_drop"))
    out = src.join(drops, ["_k1", "_k2"], "left").withColumn("_lines", line_array(F.col("_text")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    out = out.withColumn("_kept", F.when(F.col("_drop").isNotNull(), kept))
    text = F.when(F.col("_kept").isNull(), F.coalesce("_text", F.lit(""))) \
        .otherwise(F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n"))
    return out.select(*released(
        docs.columns, **{text_col: text}, _n_lines=F.size("_lines").cast("long"),
        _n_dropped=F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0)).cast("long")))


#: The digests of the kept text, in DuckDB.
ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos, len(ls) AS n FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, any_value(n)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op1(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2("text", 256).alias("kept_sha256"))
