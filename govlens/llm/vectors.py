"""Embedding near-dedup by sorted projection passes.

Each pass draws its own random hyperplanes, orders the vectors of a label by
their concatenated sign bits, and compares each vector with its neighbours in
that order.  The verified pairs of all passes give the components; the links
are then counted exactly within each component.  Its vectors lie in blocks
with a centre and an angular radius, in the order of a projection: by the
triangle inequality two blocks are too far apart to link, or so close that all
their vectors do, or are multiplied.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlens.llm.common import bounded_batches, numbered, table, written
from govlens.llm.components import connected_components

HASH_BITS = 62
#: Rows of a block when a component's links are counted: so many parts, but within these bounds and bytes.
BLOCK_PARTS, BLOCK_ROWS, BLOCK_BYTES = 16, (256, 8192), 32 << 20
#: Rows whose windows are multiplied at a time: bounds the memory of a task.
_BLOCK = 1024


def _planes(dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, HASH_BITS))


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _joining(i: np.ndarray, j: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links i - j, a forest that joins the same rows; ``root`` holds the least row that each is joined to so far."""
    a, b = [], []
    while True:
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        new = low != high
        if not new.any():
            break
        i, j, low, high = i[new], j[new], low[new], high[new]
        by = np.lexsort((low, high))
        by = by[np.concatenate([[True], high[by][1:] != high[by][:-1]])]     # each root goes to the least one it meets
        a.append(i[by])
        b.append(j[by])
        root[high[by]] = low[by]
        while (root[root] != root).any():
            root[:] = root[root]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, int), np.empty(0, int))


def _window_pairs(ids: np.ndarray, x: np.ndarray, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs among rows in sorted order, as many as join what is linked.

    Each row is compared with the ``window`` rows after it.  Where one of
    those links, the next ``window`` rows are compared too, and so on: a dense
    group is followed to its end.  Fewer pairs than rows come out.
    """
    a, b, n = [np.empty(0, int)], [np.empty(0, int)], len(ids)
    root = np.arange(n)
    for s in range(0, n, _BLOCK):
        rows = np.arange(s, min(s + _BLOCK, n))
        first = 1
        while len(rows):
            low, high = rows[0] + first, min(rows[-1] + first + window, n)
            if low >= high:
                break
            sims = x[rows] @ x[low:high].T
            gap = np.arange(low, high)[None, :] - rows[:, None]
            i, j = np.nonzero((sims >= threshold) & (gap >= first) & (gap < first + window))
            joined = _joining(rows[i], low + j, root)
            a.append(joined[0])
            b.append(joined[1])
            rows, first = rows[np.unique(i)], first + window
    return ids[np.concatenate(a)], ids[np.concatenate(b)]


def _pass_udf(window: int, threshold: float):
    """Over a sorted partition: its pairs, the rows at both edges, which other partitions need, and how many rows it has.

    ``away`` is the number of rows between an edge row and its edge.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(a, b, **edge):
            return pd.DataFrame({"a": a, "b": b} | {k: edge.get(k) for k in ("part", "side", "away", "grp", "vec")})

        def segment(rows: pd.DataFrame, part: int, head: bool, tail: bool):
            ids, x = rows["id"].to_numpy(), _unit(rows["vec"])
            a, b = _window_pairs(ids, x, window, threshold)
            yield out(np.minimum(a, b), np.maximum(a, b))
            for side, wanted, part_of in (("tail", tail, rows.tail(window)), ("head", head, rows.head(window))):
                if wanted:
                    e = out(part_of["id"].to_numpy(), part_of["id"].to_numpy())
                    e["part"], e["side"] = part, side
                    e["away"] = np.arange(len(e))[::-1 if side == "tail" else 1]
                    e["grp"], e["vec"] = part_of["grp"].to_numpy(), part_of["vec"].to_numpy()
                    yield e

        # a group (label and dimension) is contiguous; one is held at a time
        held, part, first, n = None, 0, True, 0
        for batch in batches:
            if not len(batch):
                continue
            part, n = int(batch["part"].iloc[0]), n + len(batch)
            cut = np.flatnonzero(batch["grp"].to_numpy()[1:] != batch["grp"].to_numpy()[:-1]) + 1
            for piece in np.split(np.arange(len(batch)), cut):
                rows = batch.iloc[piece]
                if held is not None and held["grp"].iloc[-1] == rows["grp"].iloc[0]:
                    held = pd.concat([held, rows], ignore_index=True)
                else:
                    if held is not None:
                        yield from segment(held, part, first, False)
                        first = False
                    held = rows
        if held is not None:
            yield from segment(held, part, first, True)
            yield out([n], [n], part=part, side="rows")
    return run


def _reached(rows: dict[int, int], window: int) -> list[tuple[int, int, int]]:
    """``part, to, gap``: the partitions less than ``window`` rows after each one, and the rows between the two."""
    parts, out = sorted(rows), []
    for k, part in enumerate(parts):
        gap = 0
        for to in parts[k + 1:]:
            if gap >= window:
                break
            out.append((part, to, gap))
            gap += rows[to]
    return out


def _edge_udf(threshold: float):
    """Of one partition: the rows before it against its first ones, label by label."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for _, g in rows.groupby("grp"):
            before, after = g[g["side"] == "tail"], g[g["side"] == "head"]
            if len(before) and len(after):
                i, j = np.nonzero(_unit(before["vec"]) @ _unit(after["vec"]).T >= threshold)
                a.append(before["id"].to_numpy()[i])
                b.append(after["id"].to_numpy()[j])
        x, y = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (a, b))
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})
    return run


def _keys(seed: int):
    @F.pandas_udf("long")
    def of(vectors: pd.Series) -> pd.Series:
        """The concatenated sign bits, the first hash uppermost."""
        out = np.zeros(len(vectors), dtype=np.int64)
        sizes = vectors.map(len).to_numpy()
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            bits = np.stack(vectors.iloc[at].to_list()).astype(np.float64) @ _planes(int(dim), seed) > 0
            out[at] = bits @ (np.int64(1) << np.arange(HASH_BITS - 1, -1, -1, dtype=np.int64))
        return pd.Series(out)
    return of


def joining_pairs(vectors: DataFrame, threshold: float = 0.98, passes: int = 8, window: int = 64) -> DataFrame:
    """Verified pairs ``a < b`` of ``vectors`` (id long, grp string, vec array), within equal ``grp`` only.

    They join what the passes found to be linked, and needn't be all of its
    links.  A pass moves each vector once, to a range partition; in a second,
    small step the first ``window`` rows of each partition are compared with
    the ``window`` rows before it, from however many partitions these come.
    So the order decides what is compared, and the partitions can only add.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = []
    for seed in range(passes):
        ordered = vectors.withColumn("key", _keys(seed)("vec")).repartitionByRange(n, "grp", "key", "id") \
            .sortWithinPartitions("grp", "key", "id").select("id", "grp", "vec", F.spark_partition_id().alias("part"))
        one = written(ordered.mapInPandas(
            _pass_udf(window, threshold), "a long, b long, part int, side string, away int, grp string, vec array<double>"), "pass")
        rows = {r.part: r.a for r in one.where("side = 'rows'").select("part", "a").collect()}
        reached = spark.createDataFrame(_reached(rows, window), "part int, to int, gap int")
        edge = ["a", "side", "grp", "vec"]
        edges = one.where("side = 'tail'").join(reached, "part").where(F.col("away") + F.col("gap") < window).select(F.col("to"), *edge) \
            .union(one.where("side = 'head'").select("part", *edge)).withColumnRenamed("a", "id")
        found += [one.where("side is null").select("a", "b"),
                  edges.groupBy("to").applyInPandas(_edge_udf(threshold), "a long, b long")]
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out.where("a < b").distinct()


def _links_udf(threshold: float):
    """Over tasks (component, grp, i, j), each contiguous: the links of block i with block j.

    A class gets the rows of the classes that it is linked with; links with an
    id that has several classes come out as pairs of ids.
    """
    def links(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        x, n = _unit(rows["vec"]), rows["n"].to_numpy()
        ids, shared, block = rows["id"].to_numpy(), rows["shared"].to_numpy(), rows["block"].to_numpy()
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        total = np.zeros(len(rows), dtype=np.int64)
        for s in range(0, len(left), _BLOCK):
            part = left[s:s + _BLOCK]
            hit = x[part] @ x[right].T >= threshold
            hit &= ids[part][:, None] != ids[right][None, :]
            if shared.any():
                a, b = np.nonzero(hit & (shared[part][:, None] | shared[right][None, :]))
                if len(a):
                    a, b = ids[part[a]], ids[right[b]]
                    yield pd.DataFrame({"_k1": None, "_k2": None, "links": None, "a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()
                hit &= ~(shared[part][:, None] | shared[right][None, :])
            # exact: counts are whole numbers, and doubles hold those up to 2^53
            total[part] += (hit @ n[right].astype(np.float64)).astype(np.int64)
            if i != j:
                total[right] += (n[part].astype(np.float64) @ hit).astype(np.int64)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"_k1": rows["_k1"].to_numpy()[at], "_k2": rows["_k2"].to_numpy()[at], "links": total[at], "a": None, "b": None})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for batch in batches:
            if not len(batch):
                continue
            key = batch[["component", "grp", "i", "j"]]
            cut = np.flatnonzero((key.iloc[1:].to_numpy() != key.iloc[:-1].to_numpy()).any(axis=1)) + 1
            for at in np.split(np.arange(len(batch)), cut):
                piece = batch.iloc[at]
                if held and (held[-1][key.columns].iloc[-1] != piece[key.columns].iloc[0]).any():
                    yield from links(pd.concat(held, ignore_index=True))
                    held = []
                held.append(piece)
        if held:
            yield from links(pd.concat(held, ignore_index=True))
    return run


def exact_links(classes: DataFrame, components: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """All links of ``classes`` (_k1, _k2, id, n, grp, vec) within equal ``grp`` and component: ``_k1, _k2, links`` and pairs ``a, b``.

    Classes lie in blocks of bounded size in the order of a projection, and
    each task multiplies two blocks that may, but needn't, link: a component of
    any size is spread over many tasks of bounded memory, and counts come out
    instead of pairs.  A class moves once for each block that its own is
    multiplied with.  Only links with an id that has several classes are
    pairs, as two of its links may be one.
    """
    spark = classes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = ["component", "grp"]
    several = classes.groupBy("id").agg(F.count(F.lit(1)).alias("of")).where("of > 1").select("id", F.lit(True).alias("shared"))
    placed = classes.join(components, F.col("id") == F.col("node")).drop("node").join(several, "id", "left") \
        .withColumn("shared", F.coalesce("shared", F.lit(False)))
    least, most = BLOCK_ROWS
    # neighbours in a projection's order lie close together, and so in one block
    ordered = numbered(placed.withColumn("key", _keys(0)("vec")), group, ["key", "_k1", "_k2"], "placed")
    room = F.greatest(F.lit(1), F.least(F.greatest(F.col("_size") / BLOCK_PARTS, F.lit(least)), F.lit(most), F.lit(BLOCK_BYTES / 8) / F.size("vec")))
    dealt = written(ordered.withColumn("block", F.floor(F.col("_index") / F.ceil(room)).cast("int"))
                    .select("_k1", "_k2", "id", "n", "vec", "shared", *group, "block"), "dealt")
    balls = written(dealt.repartition(parts, *group, "block").sortWithinPartitions(*group, "block").mapInPandas(
        _balls_udf, "component long, grp string, block int, rows long, n long, shared boolean, centre array<double>, radius double"), "balls")
    a, b = (balls.select(*group, F.col("block").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("rows", "n", "shared", "centre", "radius")])
            for k in ("i", "j"))
    met = written(a.join(b, group).where("i <= j").withColumn("how", _meeting(threshold)(
        "centre_i", "centre_j", "radius_i", "radius_j", F.col("shared_i") | F.col("shared_j")))
        .select(*group, "i", "j", "rows_i", "rows_j", "n_i", "n_j", "how"), "block-pairs")
    tasks = met.where("how = 'multiply'")
    of = tasks.select(*group, F.col("i").alias("block"), "i", "j").unionByName(tasks.where("i < j").select(*group, F.col("j").alias("block"), "i", "j"))
    key = [*group, "i", "j"]
    found = written(dealt.join(of, [*group, "block"]).repartition(parts, *key).sortWithinPartitions(*key).mapInPandas(
        _links_udf(threshold), "_k1 long, _k2 long, links long, a long, b long"), "links")
    # all of two close blocks: each class has the rows of the other block, or of its own but for itself
    close = met.where("how = 'all'")
    whole = close.where("i < j").select(*group, F.col("i").alias("block"), F.col("n_j").alias("more"), F.lit(0).alias("own")) \
        .unionByName(close.where("i < j").select(*group, F.col("j").alias("block"), F.col("n_i").alias("more"), F.lit(0).alias("own"))) \
        .unionByName(close.where("i = j").select(*group, F.col("i").alias("block"), F.col("n_i").alias("more"), F.lit(1).alias("own"))) \
        .groupBy(*group, "block").agg(F.sum("more").alias("more"), F.max("own").alias("own"))
    counted = dealt.select("_k1", "_k2", "n", *group, "block").join(whole, [*group, "block"]) \
        .select("_k1", "_k2", (F.col("more") - F.col("own") * F.col("n")).alias("links"))
    return found.where("a is null").select("_k1", "_k2", "links").unionByName(counted).groupBy("_k1", "_k2").agg(F.sum("links").alias("links")), \
        found.where("a is not null").select("a", "b").distinct()


def _balls_udf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per block, contiguous rows: how many classes and rows it has, and the centre and angular radius of its vectors."""
    columns = ["component", "grp", "block"]

    def ball(rows: pd.DataFrame) -> pd.DataFrame:
        x = _unit(rows["vec"])
        centre = x.mean(axis=0)
        size = np.linalg.norm(centre)
        radius = float(np.arccos(np.clip(x @ (centre / size), -1, 1)).max()) if size > 1e-9 else np.pi
        return pd.DataFrame([[*rows[columns].iloc[0], len(rows), rows["n"].sum(), bool(rows["shared"].any()), centre / max(size, 1e-9), radius]],
                            columns=[*columns, "rows", "n", "shared", "centre", "radius"])

    held = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch[columns]
        cut = np.flatnonzero((key.iloc[1:].to_numpy() != key.iloc[:-1].to_numpy()).any(axis=1)) + 1
        for at in np.split(np.arange(len(batch)), cut):
            piece = batch.iloc[at]
            if held and (held[-1][columns].iloc[-1] != piece[columns].iloc[0]).any():
                yield ball(pd.concat(held, ignore_index=True))
                held = []
            held.append(piece)
    if held:
        yield ball(pd.concat(held, ignore_index=True))


#: Angles are known to a few 1e-8; what is closer to a decision than this is multiplied.
_ANGLE_ERROR = 1e-6


def _meeting(threshold: float):
    """``none``, ``all`` or ``multiply`` for two blocks: by the triangle inequality, what the angles of their vectors can be."""
    reach = float(np.arccos(threshold))

    @F.pandas_udf("string")
    def how(x: pd.Series, y: pd.Series, r: pd.Series, t: pd.Series, shared: pd.Series) -> pd.Series:
        cosine = np.array([float(np.dot(a, b)) for a, b in zip(x, y)])
        angle, both = np.arccos(np.clip(cosine, -1, 1)), r.to_numpy() + t.to_numpy()
        all_ = (angle + both < reach - _ANGLE_ERROR) & ~shared.to_numpy()
        return pd.Series(np.where(angle - both > reach + _ANGLE_ERROR, "none", np.where(all_, "all", "multiply")))
    return how


def passes_for(rows: int, threshold: float = 0.98, window: int = 64, missed: float = 0.001, least: int = 8) -> int:
    """Passes after which a pair at the threshold is missed with a probability of ``missed`` at most, in a label of so many vectors.

    A pass can't see a pair if one of the leading bits that part a label into
    windows differs between the two, which a bit does with the pair's angle over pi.
    """
    bits = max(0.0, math.log2(max(rows, 1) / window))
    seen = (1 - math.acos(threshold) / math.pi) ** bits
    return max(least, math.ceil(math.log(missed) / math.log(1 - seen))) if seen < 1 else least


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.98, passes: int | None = None, window: int = 64) -> DataFrame:
    """One row per row: ``id, n_links, component``.

    Vectors are compared only if their labels are equal and not null and their
    dimensions are the same, by cosine in double precision.  A vector that is
    null, empty, all zero, or has a null or non-finite component links with
    nothing, and so does a row with a null id.  Equal vectors of a label form a
    class that is compared once: its members are linked with each other, and
    with all members of every class that is linked to theirs.  An id that is
    used for several vectors is one node.  An empty table gives an empty table.

    Components hold what the passes join; ``n_links`` counts all links within
    them, each pair verified, whatever the partitions.

    ``passes`` and ``window`` set the recall of components: two vectors at the
    threshold differ in 6.4 % of their hash bits, so with g rows in a label a
    pass misses such a pair if one of about log2(g / window) leading bits
    differs.  Without a number of passes, the largest label gives it (see
    ``passes_for``): pairs at the threshold itself are missed once in 1,000,
    and closer ones less.  Where links go on, a partition is searched beyond
    the window too (see ``_window_pairs``).
    """
    v = F.col("_vec")
    fit = F.col("_id").isNotNull() & F.col("_label").isNotNull() & v.isNotNull() \
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    src = rows.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vec_col).alias("_vec"))
    src = src.select("_id", F.when(F.coalesce(fit, F.lit(False)), F.concat_ws(":", F.size(v), F.col("_label"))).alias("grp"), "_vec")
    keyed = src.select("_id", *[F.when(F.col("grp").isNotNull(), k).alias(n) for k, n in (
        (F.xxhash64(F.lit(1), "grp", "_vec"), "_k1"), (F.xxhash64(F.lit(2), "grp", "_vec"), "_k2"))], "grp", "_vec")
    classes = written(keyed.where("grp is not null").groupBy("_k1", "_k2").agg(
        F.min("_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("grp").alias("grp"), F.first("_vec").alias("vec")), "classes")
    if passes is None:
        largest = classes.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
        passes = passes_for(largest, threshold, window)
    pairs = written(joining_pairs(classes.select("id", "grp", "vec"), threshold, passes, window), "pairs")
    components = written(connected_components(pairs), "components")
    links, shared = exact_links(classes, components, threshold)
    sizes = classes.groupBy("id").agg(F.sum("n").alias("n"))
    both = shared.union(shared.select("b", "a"))
    degree = both.join(sizes.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.sum("n").alias("more"))
    found = classes.select("_k1", "_k2", "id", "n").join(links, ["_k1", "_k2"], "left") \
        .join(degree, F.col("id") == F.col("a"), "left").join(components, F.col("id") == F.col("node"), "left") \
        .select("_k1", "_k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_links"),
                F.coalesce("component", "id").alias("component"))
    return keyed.select("_id", "_k1", "_k2").join(found, ["_k1", "_k2"], "left").select(
        F.col("_id").alias("id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "_id").alias("component"))


#: Every pair of a label, in DuckDB.
ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e,
    coalesce(label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0, false) AS fit FROM embeddings),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND a.fit AND b.fit AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98),
reach AS (SELECT vec_id, vec_id AS r FROM v UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON reach.r = links.x),
c AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT c.vec_id, (SELECT count(*) FROM links WHERE x = c.vec_id)::BIGINT AS n_links, c.component_id,
       c.vec_id = c.component_id AS kept FROM c
"""


def op3(spark, sf_dir: str) -> DataFrame:
    out = near_vectors(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))
