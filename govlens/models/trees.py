"""Forests and boosted trees, grown level by level from histograms of binned rows.

The estimators take MLlib's parameters and follow MLlib's rules (at most
``maxBins`` bins a column, Gini or variance, a bag of Poisson counts and a
random choice of columns for each node, class trees whose sister leaves agree
are merged, boosting of the log loss) but not its random numbers.  What
differs is the work: a row is a byte for each column, a level of all trees is
one pass of array operations over the rows, and a partition sends the counts
of a level's nodes in the fewest bytes that hold them.  Rows keep no state for
each tree, so nothing grows with rows times trees; only statistics of columns,
splits of nodes and the trees come to the driver.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows of a stored block, and of one step of array operations (which a core's own cache holds); points that sum up a column
#: of a partition; nodes whose histograms are added up together; rows of a partition of blocks; cells (of a byte at least)
#: for each task that adds up.
BLOCK, STEP, POINTS, NODES, MOST_ROWS, CELLS = 1 << 17, 1 << 15, 1024, 2048, 8_000_000, 4_000_000
#: Nodes of a tree's level up to which partitions send their sums of labels as doubles; beyond, a partition's part of a sum
#: goes as a float, and the parts are added up as doubles.
EXACT = 512
#: Rounds of boosting after which the rows' sums are written into their blocks; until then the latest trees are asked again.
ROUNDS = 10
#: A leaf's bin: no row's is above it.
LEAF = 255


@dataclass
class Tree:
    """Nodes in arrays, each level after the one above; the right child comes next to the left, a leaf is its own left child."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    count: np.ndarray
    value: np.ndarray               # (nodes, classes) shares of the classes, or (nodes, 1) means

    def leaves(self) -> np.ndarray:
        return self.left == np.arange(len(self.left))

    @property
    def numNodes(self) -> int:
        return len(self.left)

    @property
    def depth(self) -> int:
        d = np.zeros(len(self.left), dtype=np.int64)
        for i in np.flatnonzero(~self.leaves()):
            d[self.left[i]:self.left[i] + 2] = d[i] + 1
        return int(d.max())

    @property
    def toDebugString(self) -> str:
        leaf, lines, todo = self.leaves(), [], [(0, 1)]
        while todo:
            i, indent = todo.pop()
            if isinstance(i, str):
                lines.append(" " * indent + i)
            elif leaf[i]:
                v = self.value[i]
                lines.append(" " * indent + f"Predict: {float(v.argmax()) if len(v) > 1 else float(v[0])}")
            else:
                f, t, c = self.feature[i], float(self.threshold[i]), int(self.left[i])
                lines.append(" " * indent + f"If (feature {f} <= {t})")
                todo += [(c + 1, indent + 1), (f"Else (feature {f} > {t})", indent), (c, indent + 1)]
        return f"Tree of depth {self.depth} with {self.numNodes} nodes\n" + "\n".join(lines) + "\n"


# ---------------------------------------------------------------- rows to bins

def thinned(v: np.ndarray, w: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their weights; ``most`` of them at equal steps of the weight, if there are more."""
    v, at = np.unique(v, return_inverse=True)
    w = np.bincount(at, weights=w, minlength=len(v))
    if len(v) <= most:
        return v, w
    total = np.cumsum(w)
    at = np.minimum(np.searchsorted(total, (np.arange(most) + 0.5) * total[-1] / most), len(v) - 1)
    at, n = np.unique(at, return_counts=True)
    return v[at], n * (total[-1] / most)


def thresholds(v: np.ndarray, w: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds halfway between neighbours of the sorted values: all, or MLlib's choice near equal shares of the weight."""
    at = np.arange(max(0, len(v) - 1))
    if len(at) > most:
        total = np.cumsum(w)
        step = target = total[-1] / (most + 1)
        at = []
        for i, (before, now) in enumerate(zip(total.tolist(), total[1:].tolist())):
            if abs(before - target) < abs(now - target):
                at.append(i)
                target += step
        at = np.array(at[:most], dtype=np.int64)
    t = v[at] / 2 + v[at + 1] / 2
    return np.unique(t[~np.isnan(t)])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _bins(x: np.ndarray, cuts: list[np.ndarray], stride: int) -> np.ndarray:
    """A byte for each column, row after row: how many thresholds are below the value (all of them if it isn't a number)."""
    out = np.zeros((len(x), stride), dtype=np.uint8)
    for f, t in enumerate(cuts):
        if len(t):
            out[:, f] = np.searchsorted(t, x[:, f])
    return out


@dataclass
class Binned:
    """Rows as blocks of bytes (persisted), in partitions that have their number in each block."""
    blocks: DataFrame
    cuts: list[np.ndarray]
    n: int
    classes: int
    width: int
    stride: int
    cores: int

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(t) + 1 for t in self.cuts], dtype=np.int64)


def binned(dataset: DataFrame, features: str, label: str, max_bins: int, classify: bool) -> Binned:
    """Two passes: one sums up the columns for their thresholds, from all rows; one writes the bins."""
    if not 2 <= max_bins <= LEAF + 1:
        raise ValueError(f"maxBins must be 2 to {LEAF + 1}")
    rows = dataset.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"))

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        n, least, top, odd, width = 0, np.inf, -np.inf, 0, 0
        for b in batches:
            if not len(b):
                continue
            y = b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            width = len(b.column(0).flatten()) // len(b)
            x = _matrix(b.column(0), width)
            n, odd = n + len(y), odd + int((np.isnan(y) | (y != np.floor(y))).sum())
            least, top = min(least, np.nanmin(y, initial=np.inf)), max(top, np.nanmax(y, initial=-np.inf))
            for f in range(width):
                c = x[:, f]
                c = c[~np.isnan(c)]
                own = thinned(c, np.ones(len(c)), POINTS)
                if f in held:
                    own = thinned(np.concatenate([held[f][0], own[0]]), np.concatenate([held[f][1], own[1]]), POINTS)
                held[f] = own
        if n:
            held[-1] = np.array([n, least, top, odd, width], dtype=np.float64), np.zeros(0)
        yield pa.RecordBatch.from_pydict({"f": pa.array(list(held), pa.int32()), "v": pa.array([v for v, _ in held.values()], pa.list_(pa.float64())),
                                          "w": pa.array([w for _, w in held.values()], pa.list_(pa.float64()))})

    found: dict[int, list] = {}
    t = rows.mapInArrow(sum_up, "f int, v array<double>, w array<double>").toArrow()      # a partition's column is POINTS values at most
    for f, v, w in zip(t["f"].to_pylist(), t["v"], t["w"]):
        found.setdefault(f, []).append((v.values.to_numpy(zero_copy_only=False), w.values.to_numpy(zero_copy_only=False)))
    if -1 not in found:
        raise ValueError("a tree needs rows to learn from")
    about = np.array([v for v, _ in found[-1]])
    n, width = int(about[:, 0].sum()), int(about[:, 4].max())
    if classify and (about[:, 3].any() or about[:, 1].min() < 0):
        raise ValueError("classes must be 0, 1, 2 and so on")
    cuts = []
    for f in range(width):
        v, at = np.unique(np.concatenate([v for v, _ in found[f]]), return_inverse=True)
        cuts.append(thresholds(v, np.bincount(at, weights=np.concatenate([w for _, w in found[f]]), minlength=len(v)), max_bins - 1))
    stride = width + width % 2

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bins, ys, held = TaskContext.get().partitionId(), [], [], 0

        def block() -> pa.RecordBatch:
            b, y = np.concatenate(bins), np.concatenate(ys)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "bins": pa.array([b.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

        for b in batches:
            if len(b):
                bins.append(_bins(_matrix(b.column(0), width), cuts, stride))
                ys.append(b.column(1).to_numpy(zero_copy_only=False).astype(np.float64))
                held += len(b)
            if held >= BLOCK:
                yield block()
                bins, ys, held = [], [], 0
        if held:
            yield block()

    cores = dataset.sparkSession.sparkContext.defaultParallelism
    blocks = rows.coalesce(max(cores, -(-n // MOST_ROWS))).mapInArrow(write, "part int, bins binary, y binary") \
        .persist(StorageLevel.MEMORY_AND_DISK)
    return Binned(blocks, cuts, n, int(about[:, 2].max()) + 1 if classify else 0, width, stride, cores)


# ---------------------------------------------------------------- passes over the rows

def walk(bins: np.ndarray, at: np.ndarray, feature: np.ndarray, bin_: np.ndarray, left: np.ndarray, steps: int) -> np.ndarray:
    """The node that each row, whose bins begin ``at``, reaches from the root."""
    out = np.zeros(len(at), dtype=np.int64)
    for a in range(0, len(at) if steps else 0, STEP):
        some, node = at[a:a + STEP], out[a:a + STEP]
        for _ in range(steps):
            right = np.take(bins, some + np.take(feature, node, mode="clip"), mode="clip") > np.take(bin_, node, mode="clip")
            node = np.take(left, node, mode="clip") + right
        out[a:a + STEP] = node
    return out


def _poisson() -> np.ndarray:
    """Poisson counts of mean 1 by a 16-bit number (each count's share rounded to 1 in 65,536)."""
    share = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(9)])
    return np.searchsorted(share, (np.arange(65536) + 0.5) / 65536).astype(np.uint8)


def bag(seed: int, tree: int, part: int, n: int) -> np.ndarray:
    """How often a tree has each row of a partition."""
    return np.take(_poisson(), np.random.Generator(np.random.SFC64([seed, tree, part])).integers(0, 65536, n, dtype=np.uint16))


def chosen(seed: int, tree: int, level: int, nodes: int, width: int, m: int) -> np.ndarray:
    """(nodes, m): the columns that each node of a level may split by, ascending."""
    if m >= width:
        return np.tile(np.arange(width), (nodes, 1))
    r = np.random.Generator(np.random.SFC64([seed, tree, level])).random((nodes, width))
    return np.sort(np.argpartition(r, m - 1, axis=1)[:, :m], axis=1)


def _smallest(x: np.ndarray) -> np.ndarray:
    top = x.max(initial=0)
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def best_splits(n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each node the best of its columns and bins: (column's place, bin, gain, left's count and sums, the node's own).

    ``n`` (nodes, columns, bins) counts rows, ``s`` (nodes, columns, bins, c) sums class marks or labels.  The loss of Gini
    impurity or variance by a split is the product of the parts' shares times the squared distance of their means.
    """
    ln, ls = np.cumsum(n, axis=2)[:, :, :-1], np.cumsum(s, axis=2)[:, :, :-1]
    tn, ts = n[:, 0].sum(axis=1), s[:, 0].sum(axis=1)
    rn, rs = tn[:, None, None] - ln, ts[:, None, None, :] - ls
    ok = (ln > 0) & (rn > 0)
    gap = ls / np.where(ok, ln, 1)[..., None] - rs / np.where(ok, rn, 1)[..., None]
    gain = np.where(ok, ln * rn / np.maximum(tn, 1)[:, None, None] ** 2 * (gap ** 2).sum(axis=3), -1.0).reshape(len(n), -1)
    if not gain.shape[1]:
        return np.zeros(len(n), int), np.zeros(len(n), int), np.full(len(n), -1.0), tn * 0, ts * 0, tn, ts
    top = gain.argmax(axis=1)
    r = np.arange(len(n))
    return (top // ln.shape[2], top % ln.shape[2], gain[r, top], ln.reshape(len(n), -1)[r, top], ls.reshape(len(n), -1, s.shape[3])[r, top], tn, ts)


class _Growing:
    """A tree that still grows, as the driver keeps it."""

    def __init__(self, stats: int):
        self.feature, self.bin, self.left = np.zeros(1, np.int32), np.full(1, LEAF, np.uint8), np.zeros(1, np.int32)
        self.gain, self.n, self.s = np.zeros(1), np.zeros(1), np.zeros((1, stats))
        self.starts, self.open = [0], np.zeros(1, np.int64)

    def split(self, place: np.ndarray, bin_: np.ndarray, gain: np.ndarray, ln: np.ndarray, ls: np.ndarray, tn: np.ndarray, ts: np.ndarray,
              pure, last: bool) -> None:
        """The open nodes' splits (``place`` names the columns) become the next level; its nodes are open unless they can't be split."""
        self.n[self.open], self.s[self.open] = tn, ts
        do = np.flatnonzero(gain > 0)
        parents, size = self.open[do], len(self.left)
        self.feature[parents], self.bin[parents], self.gain[parents] = place[do], bin_[do], gain[do]
        self.left[parents] = size + 2 * np.arange(len(do))
        n = np.column_stack([ln[do], (tn - ln)[do]]).ravel()
        s = np.stack([ls[do], (ts - ls)[do]], axis=1).reshape(2 * len(do), self.s.shape[1])
        fresh = np.arange(size, size + 2 * len(do))
        self.starts.append(size)
        self.feature, self.bin = np.concatenate([self.feature, fresh * 0]).astype(np.int32), np.concatenate([self.bin, fresh * 0 + LEAF]).astype(np.uint8)
        self.left, self.gain = np.concatenate([self.left, fresh]).astype(np.int32), np.concatenate([self.gain, fresh * 0.0])
        self.n, self.s = np.concatenate([self.n, n]), np.concatenate([self.s, s])
        self.open = fresh[:0] if last else fresh[(n > 1) & ~pure(n, s)]

    def slots(self) -> np.ndarray:
        out = np.full(len(self.left), -1, dtype=np.int32)
        out[self.open] = np.arange(len(self.open))
        return out

    def done(self, cuts: list[np.ndarray], merge: bool) -> Tree:
        leaf, i = self.left == np.arange(len(self.left)), np.arange(len(self.left))
        ends = [*self.starts[1:], len(self.left)]
        spans = [i[a:b] for a, b in zip(self.starts, ends)]
        if merge:                                          # sister leaves of one class are one leaf
            best = self.s.argmax(axis=1)
            for span in reversed(spans):
                inner = span[~leaf[span]]
                c = self.left[inner]
                leaf[inner[leaf[c] & leaf[c + 1] & (best[c] == best[c + 1])]] = True
        keep = i == 0
        for span in spans:
            c = self.left[span[keep[span] & ~leaf[span]]]
            keep[c] = keep[c + 1] = True
        new, leaf = np.cumsum(keep) - 1, leaf[keep]
        left = np.where(leaf, np.arange(len(leaf)), new[self.left[keep]]).astype(np.int32)
        cut = np.array([0.0 if end else cuts[f][b] for f, b, end in zip(self.feature[keep], self.bin[keep], leaf)])
        return Tree(np.where(leaf, 0, self.feature[keep]).astype(np.int32), cut, left, np.where(leaf, 0.0, self.gain[keep]), self.n[keep],
                    self.s[keep] / np.maximum(self.n[keep], 1)[:, None])


def _whole(batches: Iterator[pa.RecordBatch]) -> tuple[int, np.ndarray, np.ndarray]:
    """A partition's number, bins and labels."""
    part, bins, y = 0, [], []
    for b in batches:
        for p, x, v in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            part = p
            bins.append(np.frombuffer(x.as_buffer(), np.uint8))
            y.append(np.frombuffer(v.as_buffer(), np.float64))
    return part, np.concatenate(bins) if bins else np.zeros(0, np.uint8), np.concatenate(y) if y else np.zeros(0)


def grow_forest(rows: Binned, n_trees: int, depth: int, m: int, seed: int, bags: bool = True) -> list[Tree]:
    """One pass over all rows for a level of all trees; the nodes' histograms are added up, and split, by tasks of their own."""
    spark, k, sizes, width, stride = rows.blocks.sparkSession, rows.classes, rows.sizes, rows.width, rows.stride
    trees, kind = [_Growing(k or 1) for _ in range(n_trees)], np.uint16 if k < 256 else np.int64
    pure = (lambda n, s: s.max(axis=1) == n) if k else (lambda n, s: np.zeros(len(n), dtype=bool))
    for level in range(depth):
        nodes = {t: len(g.open) for t, g in enumerate(trees) if len(g.open)}
        if not nodes:
            break
        real = np.float64 if max(nodes.values()) <= EXACT else np.float32
        sent = spark.sparkContext.broadcast({t: (trees[t].feature, trees[t].bin, trees[t].left, trees[t].slots()) for t in nodes})

        def count(batches: Iterator[pa.RecordBatch], level=level, nodes=nodes, sent=sent, real=real) -> Iterator[pa.RecordBatch]:
            part, bins, y = _whole(batches)
            marks = y.astype(kind) if k else None
            for t in nodes if len(y) else ():
                feature, bin_, left, slot = sent.value[t]
                w = bag(seed, t, part, len(y)) if bags else np.ones(len(y), np.uint8)
                in_bag, feats = np.flatnonzero(w), chosen(seed, t, level, nodes[t], width, m).T
                cells = sizes[feats]
                begin = np.cumsum(cells, axis=1) - cells                       # of a node's cells among those of its j-th column
                first, feats = begin * max(k, 1), feats.astype(np.int32)
                length = (begin[:, -1] + cells[:, -1]).tolist()
                counts = [np.zeros(n * max(k, 1)) for n in length]
                sums = [np.zeros(n) for n in length] if not k else []
                step = max(STEP, 2 * max(length))
                for a in range(0, len(in_bag), step):
                    r = in_bag[a:a + step]
                    at = r * stride
                    own = np.take(slot, walk(bins, at, feature, bin_, left, level), mode="clip")
                    if own.min() < 0:
                        r, at, own = r[own >= 0], at[own >= 0], own[own >= 0]
                    own = own.astype(np.int64)
                    weight = np.take(w, r, mode="clip").astype(np.float64)
                    mark = np.take(marks, r, mode="clip") if k else None
                    pull = None if k else weight * np.take(y, r, mode="clip")
                    for j in range(len(feats)):
                        cell = np.take(bins, at + np.take(feats[j], own, mode="clip"), mode="clip")
                        if k:
                            cell = cell.astype(kind) * kind(k) + mark
                            counts[j] += np.bincount(np.take(first[j], own, mode="clip") + cell, weight, len(counts[j]))
                        else:
                            cell = np.take(first[j], own, mode="clip") + cell
                            counts[j] += np.bincount(cell, weight, len(counts[j]))
                            sums[j] += np.bincount(cell, pull, len(sums[j]))
                for c in range(0, nodes[t], NODES):
                    span = [slice(int(begin[j, c]), int(begin[j, c + NODES]) if c + NODES < nodes[t] else length[j]) for j in range(len(feats))]
                    n = _smallest(np.concatenate([counts[j][s.start * max(k, 1):s.stop * max(k, 1)] for j, s in enumerate(span)]))
                    v = np.concatenate([sums[j][s] for j, s in enumerate(span)]).astype(real) if not k else np.zeros(0, real)
                    yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "chunk": pa.array([c], pa.int32()), "size": pa.array([n.itemsize], pa.int32()),
                                                      "n": pa.array([n.tobytes()], pa.binary()), "s": pa.array([v.tobytes()], pa.binary())})

        def decide(batches: Iterator[pa.RecordBatch], level=level, nodes=nodes, real=real) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, list] = {}
            for b in batches:
                for t, c, size, n, s in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3), b.column(4)):
                    n, s = np.frombuffer(n.as_buffer(), f"u{size}"), np.frombuffer(s.as_buffer(), real)
                    if (t, c) not in held:
                        held[t, c] = [n.astype(np.uint32 if size < 8 else np.uint64), s.astype(np.float64)]
                    else:
                        if size == 8 or int(held[t, c][0].max(initial=0)) + int(n.max(initial=0)) >= 1 << 32:
                            held[t, c][0] = held[t, c][0].astype(np.uint64)
                        held[t, c][0] += n.astype(held[t, c][0].dtype)
                        held[t, c][1] += s
            for (t, c), (n, s) in held.items():
                feats = chosen(seed, t, level, nodes[t], width, m)[c:c + NODES]
                cells = sizes[feats].T.ravel()                                 # column after column, a node's cells together
                row = np.repeat(np.arange(len(cells)), cells)
                bin_ = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
                j, node = row // len(feats), row % len(feats)
                full = np.zeros((*feats.shape, int(cells.max()), max(k, 1)))
                if k:
                    full[node, j, bin_] = n.reshape(-1, k)
                    got = best_splits(full.sum(axis=3), full)
                else:
                    of = np.zeros(full.shape[:3])
                    of[node, j, bin_], full[node, j, bin_, 0] = n, s
                    got = best_splits(of, full)
                got = (feats[np.arange(len(feats)), got[0]], *got[1:])
                out = {"tree": pa.array([t], pa.int32()), "chunk": pa.array([c], pa.int32())}
                yield pa.RecordBatch.from_pydict(out | {x: pa.array([np.ascontiguousarray(v, np.float64).tobytes()], pa.binary()) for x, v in zip(names, got)})

        names = ["f", "b", "gain", "ln", "ls", "tn", "ts"]
        cells = sum(nodes.values()) * m * int(sizes.max()) * max(k, 4)
        parts = max(1, min(rows.cores if cells < CELLS * rows.cores else -(-cells // CELLS), 1000, sum(-(-n // NODES) for n in nodes.values())))
        got = rows.blocks.mapInArrow(count, "tree int, chunk int, size int, n binary, s binary").repartition(parts, "tree", "chunk") \
            .mapInArrow(decide, "tree int, chunk int, " + ", ".join(f"{x} binary" for x in names)).toArrow().sort_by([("tree", "ascending"), ("chunk", "ascending")])
        by_tree: dict[int, list] = {}
        for i, t in enumerate(got["tree"].to_pylist()):
            by_tree.setdefault(t, []).append([np.frombuffer(got[x][i].as_buffer(), np.float64) for x in names])
        for t, parts_ in by_tree.items():
            f, b, gain, ln, ls, tn, ts = (np.concatenate(x) for x in zip(*parts_))
            trees[t].split(f.astype(np.int32), b.astype(np.uint8), gain, ln, ls.reshape(len(f), -1), tn, ts.reshape(len(f), -1), pure, level + 1 == depth)
        sent.destroy()
    if not depth:
        raise ValueError("a tree needs a level")
    return [g.done(rows.cuts, bool(k)) for g in trees]


def grow_boosted(rows: Binned, rounds: int, depth: int, step: float) -> tuple[list[Tree], list[float]]:
    """Trees on the slopes of the log loss of marks -1 and 1, and their weights: the first one's is 1, the others' ``step``."""
    stride, width, sizes = rows.stride, rows.width, rows.sizes
    bits = max(1, int(sizes.max() - 1).bit_length())
    most, joint = int(sizes.max()), 1 << 2 * bits
    # blocks of (bins, labels, margins); passes are many and short, and an RDD's elements reach the workers with fewer copies
    state = rows.blocks.select("bins", "y").rdd.map(lambda r: (bytes(r[0]), bytes(r[1]), None)).persist(StorageLevel.MEMORY_AND_DISK)
    state.count()
    rows.blocks.unpersist()
    trees, weights, late = [], [], []                      # late: those that aren't in the blocks' margins yet

    def arrays(block: tuple, late: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bins, labels as -1 and 1, and the sums of all trees so far."""
        bins, y = np.frombuffer(block[0], np.uint8), 2 * np.frombuffer(block[1], np.float64) - 1
        margin, at = np.zeros(len(y)) if block[2] is None else np.frombuffer(block[2], np.float64).copy(), np.arange(len(y)) * stride
        for f, b, left, value, w in late:
            margin += np.take(value * w, walk(bins, at, f, b, left, depth), mode="clip")
        return bins, y, margin

    for i in range(rounds):
        g = _Growing(1)
        for level in range(depth):
            if not len(g.open):
                break
            now = (g.feature, g.bin, g.left, g.slots(), len(g.open))

            def count(blocks: Iterator[tuple], first=not trees, level=level, now=now, late=tuple(late)) -> Iterator[np.ndarray]:
                feature, bin_, left, slot, nodes = now
                total = np.zeros((2, stride // 2, nodes * joint))
                for block in blocks:
                    bins, y, margin = arrays(block, late)
                    slope = y if first else 4 * y / (1 + np.exp(2 * y * margin))
                    both = bins.view("<u2").reshape(len(y), -1)
                    for a in range(0, len(y), STEP):
                        pull, pairs = slope[a:a + STEP], both[a:a + STEP]
                        own = np.take(slot, walk(bins, np.arange(a, a + len(pull)) * stride, feature, bin_, left, level), mode="clip").astype(np.int64)
                        keep = own >= 0
                        if not keep.all():
                            pairs, own, pull = pairs[keep], own[keep], pull[keep]
                        own *= joint
                        for p in range(stride // 2):           # two columns at once: their joint counts give both
                            v = pairs[:, p]
                            cell = own + ((v & 255) | (v >> 8 << bits))
                            total[0, p] += np.bincount(cell, minlength=nodes * joint)
                            total[1, p] += np.bincount(cell, pull, nodes * joint)
                full = total.reshape(2, stride // 2, nodes, 1 << bits, 1 << bits)
                yield np.stack([full.sum(axis=3), full.sum(axis=4)], axis=2).reshape(2, stride, nodes, 1 << bits)[:, :width, :, :most]

            # a partition sends the counts of the level's few nodes
            h = sum(state.mapPartitions(count).collect()).transpose(0, 2, 1, 3)
            place, *rest = best_splits(h[0], h[1][..., None])
            g.split(place, *rest, lambda n, s: np.zeros(len(n), dtype=bool), level + 1 == depth)
        trees.append(g.done(rows.cuts, False))
        weights.append(step if i else 1.0)
        late.append((g.feature, g.bin, g.left, g.s[:, 0] / np.maximum(g.n, 1), weights[-1]))
        if len(late) == ROUNDS and i + 1 < rounds:
            before = state
            state = before.map(lambda block, late=tuple(late): (*block[:2], arrays(block, late)[2].tobytes())).persist(StorageLevel.MEMORY_AND_DISK)
            state.count()
            before.unpersist()
            late = []
    state.unpersist()
    return trees, weights


# ---------------------------------------------------------------- models

def scorer(trees: list[Tree], weights: list[float], width: int):
    """A function of rows (n, width): the weighted sum of the values of the leaves that they reach."""
    every = [np.unique(np.concatenate([t.threshold[~t.leaves() & (t.feature == f)] for t in trees])) for f in range(width)]
    used = np.array([f for f in range(width) if len(every[f])], dtype=np.int64)
    cuts, place = [every[f] for f in used], np.zeros(width, np.int32)
    place[used] = np.arange(len(used))
    kind = np.uint8 if all(len(c) < LEAF for c in cuts) else np.uint32
    flat = []
    for t in trees:
        leaf, bin_ = t.leaves(), np.full(len(t.left), np.iinfo(kind).max, dtype=kind)
        for f, c in zip(used, cuts):
            at = np.flatnonzero(~leaf & (t.feature == f))
            bin_[at] = np.searchsorted(c, t.threshold[at])
        flat.append((place[t.feature], bin_, t.left, t.value, t.depth))

    def score(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), trees[0].value.shape[1]))
        for a in range(0, len(x), STEP):
            some, sums = x[a:a + STEP], out[a:a + STEP]
            bins = np.zeros((len(some), max(1, len(used))), dtype=kind)
            for i, (f, c) in enumerate(zip(used, cuts)):
                bins[:, i] = np.searchsorted(c, some[:, f])
            bins, at = bins.ravel(), np.arange(len(some)) * max(1, len(used))
            for (feature, bin_, left, value, depth), w in zip(flat, weights):
                sums += w * np.take(value, walk(bins, at, feature, bin_, left, depth), axis=0)
        return out

    return score


class _Trees(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """What the models share: their trees, importances, and a file of the trees beside the parameters."""

    def __init__(self, trees: list[Tree] | None = None, weights: list[float] | None = None, width: int = 0):
        super().__init__()
        self.trees, self.treeWeights, self.numFeatures = trees or [], weights or [], width

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def totalNumNodes(self) -> int:
        return sum(t.numNodes for t in self.trees)

    per_tree = True                 # each tree's importances sum to one before they are added

    @property
    def featureImportances(self) -> DenseVector:
        """Gains by column, each times the rows of its node; summing to one (to zero without any split)."""
        total = np.zeros(self.numFeatures)
        for t in self.trees:
            own = np.bincount(t.feature, t.gain * t.count, self.numFeatures)
            total += own / own.sum() if self.per_tree and own.sum() else own
        return DenseVector(total / total.sum() if total.sum() else total)

    def _numbers(self, trees: list[Tree], weights: list[float], width: int):
        """A function that gives a row's column of results from its columns; travels with the job."""
        raise NotImplementedError

    def _answer(self, dataset: DataFrame):
        """The array of results of each row."""
        width, numbers = self.numFeatures, self._numbers(self.trees, self.treeWeights, self.numFeatures)

        @F.arrow_udf("array<double>")
        def answer(x: pa.Array) -> pa.Array:
            got = numbers(_matrix(x, width))
            return pa.ListArray.from_arrays(pa.array(np.arange(0, got.size + 1, got.shape[1]), pa.int32()), pa.array(got.ravel()))

        return dataset.withColumn("_trees", answer(vector_to_array(F.col(self.getFeaturesCol()))))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Classes(_Trees, HasRawPredictionCol, HasProbabilityCol):
    """Raw numbers, shares and the first largest of the classes, in this order in the array of results."""

    @property
    def numClasses(self) -> int:
        return max(2, self.trees[0].value.shape[1])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        k = self.numClasses
        return self._answer(dataset) \
            .withColumn(self.getRawPredictionCol(), array_to_vector(F.slice("_trees", 1, k))) \
            .withColumn(self.getProbabilityCol(), array_to_vector(F.slice("_trees", k + 1, k))) \
            .withColumn(self.getPredictionCol(), F.element_at("_trees", 2 * k + 1)).drop("_trees")


class ForestClassificationModel(_Classes):
    def _numbers(self, trees, weights, width):
        score = scorer(trees, [1.0] * len(trees), width)

        def numbers(x: np.ndarray) -> np.ndarray:
            raw = score(x)
            if raw.shape[1] == 1:
                raw = np.column_stack([raw, raw * 0])
            return np.column_stack([raw, raw / raw.sum(axis=1, keepdims=True), raw.argmax(axis=1)])

        return numbers


class BoostedClassificationModel(_Classes):
    per_tree = False

    def _numbers(self, trees, weights, width):
        score = scorer(trees, weights, width)

        def numbers(x: np.ndarray) -> np.ndarray:
            m = score(x)[:, 0]
            with np.errstate(over="ignore"):
                one = 1 / (1 + np.exp(-2 * m))
            return np.column_stack([-m, m, 1 - one, one, m > 0])

        return numbers


class ForestRegressionModel(_Trees):
    def _numbers(self, trees, weights, width):
        score = scorer(trees, [1.0] * len(trees), width)
        return lambda x: score(x) / len(trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._answer(dataset).withColumn(self.getPredictionCol(), F.element_at("_trees", 1)).drop("_trees")


class _Writer(MLWriter):
    def __init__(self, model: _Trees):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"features": m.numFeatures, "stats": m.trees[0].value.shape[1]})
        lists = {c: pa.array([getattr(t, c).ravel() for t in m.trees], pa.list_(kind)) for c, kind in _COLUMNS.items()}
        t = pa.table({"tree": pa.array(range(len(m.trees)), pa.int32()), "weight": pa.array(m.treeWeights, pa.float64())} | lists)
        self.sparkSession.createDataFrame(t).write.parquet(os.path.join(path, "trees"))


_COLUMNS = {"feature": pa.int32(), "threshold": pa.float64(), "left": pa.int32(), "gain": pa.float64(), "count": pa.float64(), "value": pa.float64()}


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> _Trees:
        spark: SparkSession = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        t = spark.read.parquet(os.path.join(path, "trees")).toArrow().sort_by("tree")
        trees = [Tree(*(t[c][i].values.to_numpy(zero_copy_only=False) for c in _COLUMNS)) for i in range(len(t))]
        for x in trees:
            x.value = x.value.reshape(-1, meta["stats"])
        model = self.cls(trees, t["weight"].to_pylist(), meta["features"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


# ---------------------------------------------------------------- estimators

def _named(model: _Trees, estimator, *names: str) -> _Trees:
    for name in ("featuresCol", "predictionCol", *names):
        model._set(**{name: estimator.getOrDefault(name)})
    return model


def _fit_forest(est, dataset: DataFrame, classify: bool) -> list:
    """Trees, weights and columns."""
    plain = {"subsamplingRate": 1.0, "minInstancesPerNode": 1, "minInfoGain": 0.0, "featureSubsetStrategy": "auto",
             "minWeightFractionPerNode": 0.0}
    if odd := [p for p, v in plain.items() if est.getOrDefault(p) != v] + [p for p in ("weightCol", "thresholds") if est.hasParam(p) and est.isSet(p)]:
        raise ValueError(f"not built for other values of {odd}")
    rows = binned(dataset, est.getFeaturesCol(), est.getLabelCol(), est.getMaxBins(), classify)
    n = est.getNumTrees()
    m = rows.width if n == 1 else math.ceil(math.sqrt(rows.width)) if classify else math.ceil(rows.width / 3)
    try:
        return [grow_forest(rows, n, est.getMaxDepth(), m, est.getSeed() % (1 << 63), est.getBootstrap()), [1.0] * n, rows.width]
    finally:
        rows.blocks.unpersist()


class ForestClassifier(RandomForestClassifier):
    def _fit(self, dataset: DataFrame) -> ForestClassificationModel:
        return _named(ForestClassificationModel(*_fit_forest(self, dataset, True)), self, "rawPredictionCol", "probabilityCol")


class ForestRegressor(RandomForestRegressor):
    def _fit(self, dataset: DataFrame) -> ForestRegressionModel:
        return _named(ForestRegressionModel(*_fit_forest(self, dataset, False)), self)


class BoostedClassifier(GBTClassifier):
    def _fit(self, dataset: DataFrame) -> BoostedClassificationModel:
        rows = binned(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getMaxBins(), True)
        try:
            if rows.classes > 2:
                raise ValueError(f"boosting tells two classes apart, not {rows.classes}")
            trees, weights = grow_boosted(rows, self.getMaxIter(), self.getMaxDepth(), self.getStepSize())
        finally:
            rows.blocks.unpersist()
        return _named(BoostedClassificationModel(trees, weights, rows.width), self, "rawPredictionCol", "probabilityCol")
