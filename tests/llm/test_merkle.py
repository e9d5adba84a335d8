"""Merkle manifest: every column against a plain tree, over chunks, rounds, ties and nulls."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from govlens.llm import merkle
from govlens.llm import queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def proof(tree, i, fanout):
    out = []
    for nodes in tree[:-1]:
        a = i - i % fanout
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + fanout])))
        i //= fanout
    return out


def plain(rows, fanout=3):
    """(id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(levels([leaf(r) for r in groups[s]], fanout))
    top = levels([t[-1][0] for t in trees], fanout) if trees else []
    return [(r[0], t[0][i], t[-1][0], top[-1][0], proof(t, i, fanout) + proof(top, k, fanout))
            for k, (s, t) in enumerate(zip(names, trees)) for i, r in enumerate(groups[s])]


def got(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in df.collect()), key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def corpus(sizes):
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            i += 7
            rows.append(((i * 37) % 1009, s, "en" if i % 5 else None, i, f"t\n{i}" if i % 3 else ""))
    return rows


@pytest.mark.parametrize("fanout,depth,sizes", [
    (3, 1, {"a": 1, "b": 2, "c": 3, "d": 4, "e": 9, "f": 10, "hot": 100}),
    (3, 2, {"a": 82, "é": 28, "z": 5, None: 7}),
    (2, 1, {"a": 33, "b": 1, "c": 64}),
    (5, 1, {"one": 27}),
    (3, 1, {f"s{k}": 1 for k in range(11)}),
    (3, 1, {"only": 1}),
])
def test_manifest_is_the_plain_tree(spark, fanout, depth, sizes):
    rows = corpus(sizes)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = merkle.manifest(docs, fanout=fanout, levels=depth)
    assert got(out) == sorted(plain(rows, fanout), key=repr)
    assert out.select((merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok")).distinct().collect() == [(True,)]


def test_nulls_ties_repeats_and_clashing_columns(spark, clash):
    rows = [(None, None, None, None, None), (None, "a", "", 0, ""), (1, "a", "en", 1, "x"), (1, "a", "en", 1, "x"),
            (1, "a", "de", 1, "y"), (2, "a", "en", 9, "é" * 5000), (2, "", None, None, "\n\n")] + [(5, "r", "en", 1, "same")] * 20
    docs = clash(spark.createDataFrame(rows, SCHEMA)).withColumn("_leaf", F.lit(1)).withColumn("_group", F.lit(2)).withColumn("proof", F.lit(3))
    assert got(merkle.manifest(docs, levels=1)) == sorted(plain(rows), key=repr)


def test_empty(spark):
    out = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof"] and out.count() == 0


def test_any_change_is_seen(spark):
    rows = corpus({"a": 40, "b": 3})
    docs = spark.createDataFrame(rows, SCHEMA)
    for c, v in {"doc_id": -1, "source": "q", "lang": "xx", "n_chars": -5, "text": "other"}.items():
        changed = merkle.leaf_digest(*[F.lit(v) if f == c else F.col(f) for f in merkle.FIELDS])
        out = merkle.manifest(docs, levels=1, changed=changed)
        assert out.where(merkle.fold(F.col("changed"), F.col("proof")) == F.col("root")).count() == 0


def test_query_and_sql(spark, tmp_path):
    rows = corpus({"a": 30, "b": 1, None: 4}) + [(None, "a", None, None, "x\ny"), (5000, "c", "en", 1, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    query, sql = queries.REGISTRY["op11_merkle_manifest"]
    out = query(spark, str(tmp_path))
    assert [t for _, t in out.dtypes] == ["bigint"] + ["string"] * 5 + ["boolean"]
    found = sorted(map(tuple, out.collect()), key=repr)
    want = []
    by = {}
    for r in rows:
        by[leaf(r)] = r
    for i, lf, sub, root, p in plain(rows):
        r = by[lf]
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        x = leaf(r[:4] + (r[4].replace("\n", ""),)) if even and r[4] is not None else lf
        for left, right in p:
            x = h(left, x, right)
        want.append((i, lf, sub, root, h(*[a + b for a, b in p]), x, x == root))
    assert found == sorted(want, key=repr) and {w[-1] for w in want} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(sql).fetchall(), key=repr) == found
