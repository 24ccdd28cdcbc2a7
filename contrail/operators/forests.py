"""Decision trees and forests fitted on every row (M6, M7), stored and scored as tables.

Spark's learners hold all nodes of all trees on the driver and send the statistics of every open node with
each task; deep forests on whole tables pass neither. Here rows become cells (one interval of every feature:
at most ``maxBins`` each, cut at exact quantiles of all rows) with their counts by class, which say as much as
the rows do: a bootstrap weight of n rows is a Poisson draw of mean n. Trees are grown in tasks, a few
to a task, and written there; scoring brings the cells to the trees. The driver sees thresholds and importances.

A task that grows trees holds all cells of the fit (about 75 bytes each), one that scores holds its few trees.
What executors run is closed over numpy and pandas only: they need not have this package.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import stats as ST
from contrail.operators.joins import join_group_values
from contrail.session import materialize, scratch_path

#: Trees that one task grows or scores. A fixed number: the order of the sums of their votes is the same on any cluster.
GROUP_TREES = 5
#: Cells in a packed row, nodes in a stored row: a few MB each.
BLOCK_CELLS = 100_000
ROW_NODES = 500_000
_LEAF = 255

_BLOCK = "cell binary, n0 binary, n1 binary"
_TREE = "tree int, part int, feature binary, bin binary, left binary, share binary, importance array<double>"


@dataclass
class TreeTable:
    """Fitted trees, stored as rows. ``grid``: per feature the thresholds in order, then infinity."""
    features: list[str]
    grid: list[list[float]]
    n_trees: int
    importances: list[float]
    path: str

    def trees(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_TREE).parquet(self.path)


def numeric(df: DataFrame, features: Sequence[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType)) for c in features)


def _inputs(features: Sequence[str]) -> tuple[list[Column], Column]:
    """(the features as doubles, whether all of them are valid)."""
    inputs = [F.col(c).cast("double") for c in features]
    return inputs, reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in inputs])


def thresholds(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Per feature the thresholds of at most ``bins`` intervals, from all rows, then infinity.

    No more values than that: between any two neighbours. Else a value that fills two intervals or more has one of its
    own, and the intervals left over are cut at exact quantiles of the other values' rows.
    """
    inputs, valid = _inputs(features)
    long = rows.where(valid).select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), c.alias("v")) for i, c in enumerate(inputs)])).alias("x"))
    counts = materialize(long.select("x.f", "x.v").groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")), "feature-values")
    sizes = {r["f"]: r for r in counts.groupBy("f").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    per_feature = lambda value: F.element_at(F.create_map(*[F.lit(x) for f in sizes for x in (f, value(f))]), F.col("f"))
    cuts = {f: [] for f in range(len(features))}
    few = [f for f, r in sizes.items() if r["d"] <= bins]
    values = {f: [] for f in few}
    for r in counts.where(F.col("f").isin(few)).select("f", "v").collect():
        values[r["f"]].append(r["v"])
    for f, v in values.items():
        cuts[f] = [a + (b - a) / 2 for a, b in zip(sorted(v), sorted(v)[1:])]
    many = [f for f in sizes if f not in values]
    if many:
        counts = counts.where(F.col("f").isin(many))
        is_heavy = F.col("n") * bins >= 2 * per_feature(lambda f: sizes[f]["n"])
        heavy = {f: [] for f in many}
        for r in counts.where(is_heavy).select("f", "v", "n").collect():  # bins / 2 at most for each feature
            heavy[r["f"]].append(r["n"])
            cuts[r["f"]] += [float(np.nextafter(r["v"], -np.inf)), r["v"]]
        total = per_feature(lambda f: max(sizes[f]["n"] - sum(heavy.get(f, [])), 1))
        left = per_feature(lambda f: bins - 2 * len(heavy.get(f, [])))
        # the values at which another interval is full
        interval = lambda upto: F.floor(upto * left / total)
        full = (interval(F.col("upto")) > interval(F.col("upto") - F.col("n"))) & (F.col("upto") < total)
        for r in ST.running_counts(counts.where(~is_heavy), "f", "v", "n").where(full).select("f", "v").collect():
            cuts[r["f"]].append(r["v"])
    return [[*sorted({c for c in cuts[f] if f in sizes and sizes[f]["low"] <= c < sizes[f]["high"]}), math.inf] for f in range(len(features))]


def cells_number(grid: Sequence[Sequence[float]]) -> int:
    return math.prod(len(g) for g in grid)


def _celled(rows: DataFrame, features: Sequence[str], grid: Sequence[Sequence[float]]) -> DataFrame:
    """The valid rows with the number of their cell."""
    edges = [np.array(g) for g in grid]

    def number(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            cell = np.zeros(len(columns[0]), dtype=np.int64)
            for e, c in zip(edges, columns):
                cell = cell * len(e) + np.searchsorted(e, c.to_numpy(dtype=float))
            yield pd.Series(cell)
    inputs, valid = _inputs(features)
    return rows.where(valid).withColumn("__cell", F.pandas_udf(number, "long")(*inputs))


def _packed(cells: DataFrame) -> DataFrame:
    """Rows (__cell, n0, n1) as rows of many cells each, written."""
    size = BLOCK_CELLS

    def pack(batches):
        held, n = [], 0
        for b in batches:
            while len(b):
                part, b = b.iloc[:size - n], b.iloc[size - n:]
                held.append(part)
                n += len(part)
                if n == size:
                    yield row(held)
                    held, n = [], 0
        if n:
            yield row(held)

    def row(held):
        b = pd.concat(held)
        return pd.DataFrame({c: [b[k].to_numpy(dtype=np.int64).tobytes()] for c, k in (("cell", "__cell"), ("n0", "n0"), ("n1", "n1"))})
    return materialize(cells.select("__cell", "n0", "n1").mapInPandas(pack, _BLOCK), "cells")


def _group_keys(spark: SparkSession, groups: int) -> list[int]:
    """A number for each group, so that dealing by it into as many partitions gives each partition one group."""
    ids = spark.range(64 * groups, numPartitions=1)
    found = {r["p"]: r["id"] for r in ids.groupBy(F.pmod(F.hash("id"), F.lit(groups)).alias("p")).agg(F.min("id").alias("id")).collect()}
    spare = iter(range(64 * groups, 65 * groups))  # a partition that no number hits: its group shares one
    return [found[p] if p in found else next(spare) for p in range(groups)]


def tree_grower(sizes: Sequence[int], depth: int, tries: int, bootstrap: bool, seed: int, row_nodes: int):
    """(cells, rows of class 0 and 1 in each, number of a tree) -> the tree's stored rows.

    As Spark's learner: gini gain, ``tries`` features drawn anew for each node, a leaf where none of them gains; the first of
    equal thresholds; two leaves of one class below a node become one. All weights are whole numbers, so every sum is exact
    in whatever order.
    """
    n_features, width = len(sizes), max(sizes)

    def sums(key, w0, w1, size):
        """(the keys that occur, in order; their weights' sums)."""
        if size <= 16 * len(key) + 4096 and size <= 2**23:
            at = np.flatnonzero(np.bincount(key, minlength=size))
            return at, np.bincount(key, w0, size)[at], np.bincount(key, w1, size)[at]
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        return key[start], np.add.reduceat(w0[order], start), np.add.reduceat(w1[order], start)

    def best_splits(x, node, w0, w1, t0, t1, rng):
        """Per open node: (feature or _LEAF, bin, weights that go left, gain)."""
        k = len(t0)
        parent = (t0 * t0 + t1 * t1) / (t0 + t1)
        best, feature, cut = parent * (1 + 1e-12), np.full(k, _LEAF, dtype=np.uint8), np.zeros(k, dtype=np.uint8)
        left0, left1 = np.zeros(k), np.zeros(k)
        drawn = np.argsort(rng.random((k, n_features)), axis=1)[:, :tries] if tries < n_features else np.broadcast_to(np.arange(n_features), (k, n_features))
        place = np.arange(len(node))
        flat = x.ravel()
        for j in range(tries):
            key = node * width + flat.take(drawn[:, j].take(node) * len(node) + place)
            at, s0, s1 = sums(key, w0, w1, k * width)
            of = at // width
            first = np.r_[True, of[1:] != of[:-1]]
            start, rank = np.flatnonzero(first), np.cumsum(first) - 1
            c0, c1 = np.cumsum(s0), np.cumsum(s1)
            l0, l1 = c0 - (c0 - s0)[start][rank], c1 - (c1 - s1)[start][rank]
            r0, r1 = t0[of] - l0, t1[of] - l1
            left, right = l0 + l1, r0 + r1
            value = np.where(right > 0, (l0 * l0 + l1 * l1) / left + (r0 * r0 + r1 * r1) / np.where(right > 0, right, 1.0), -1.0)
            top = np.maximum.reduceat(value, start)
            hit = np.flatnonzero(value == top[rank])
            hit = hit[np.r_[True, rank[hit][1:] != rank[hit][:-1]]]  # the first of each node
            n = of[start]
            better = top > best[n]
            n, hit = n[better], hit[better]
            best[n], feature[n], cut[n] = top[better], drawn[n, j], at[hit] % width
            left0[n], left1[n] = l0[hit], l1[hit]
        return feature, cut, left0, left1, best - parent

    def joined(levels):
        """The levels' nodes in one array each, without leaves that say what their sibling says."""
        ends = np.cumsum([0, *[len(n[0]) for n in levels]])
        feature, cut, left, share, gain = (np.concatenate(c) for c in zip(*levels))
        is_one = share > 0.5
        for start, end in reversed([*zip(ends, ends[1:])]):
            at = start + np.flatnonzero(feature[start:end] != _LEAF)
            child = left[at]
            at = at[(feature[child] == _LEAF) & (feature[child + 1] == _LEAF) & (is_one[child] == is_one[child + 1])]
            feature[at], cut[at], left[at], gain[at] = _LEAF, 0, 0, 0.0
        stays = np.zeros(len(feature), dtype=bool)
        child = left[feature != _LEAF]
        stays[0] = stays[child] = stays[child + 1] = True
        left = np.where(feature != _LEAF, (np.cumsum(stays) - 1)[left], 0).astype(np.int32)
        return tuple(a[stays] for a in (feature, cut, left, share, gain))

    def grow(cell, n0, n1, tree):
        rng = np.random.default_rng([seed & 0xFFFFFFFF, tree])
        w0, w1 = (rng.poisson(n0), rng.poisson(n1)) if bootstrap else (n0, n1)
        used = np.flatnonzero((w0 > 0) | (w1 > 0))
        rest, x = cell[used], np.empty((n_features, len(used)), dtype=np.uint8)
        for f in reversed(range(n_features)):
            rest, x[f] = np.divmod(rest, sizes[f])
        w0, w1 = w0[used].astype(float), w1[used].astype(float)
        node = np.zeros(len(used), dtype=np.int64)
        t0, t1 = np.array([w0.sum()]), np.array([w1.sum()])
        levels, done = [], 0
        for level in range(depth + 1):
            k = len(t0)
            feature, cut, left, gains = np.full(k, _LEAF, dtype=np.uint8), np.zeros(k, dtype=np.uint8), np.zeros(k, dtype=np.int32), np.zeros(k)
            total = t0 + t1
            levels.append((feature, cut, left, np.divide(t1, total, out=np.zeros(k), where=total > 0), gains))
            is_open = (t0 > 0) & (t1 > 0)
            if level == depth or not is_open.any():
                break
            at = np.flatnonzero(is_open)
            stay = is_open[node]
            x, w0, w1, node = x[:, stay], w0[stay], w1[stay], (np.cumsum(is_open) - 1)[node[stay]]
            f, b, l0, l1, gain = best_splits(x, node, w0, w1, t0[at], t1[at], rng)
            splits = f != _LEAF
            if not splits.any():
                break
            rank = np.cumsum(splits) - 1
            feature[at], cut[at], gains[at] = f, b, gain
            left[at[splits]] = done + k + 2 * rank[splits]
            done += k
            stay = splits[node]
            x, w0, w1, node = x[:, stay], w0[stay], w1[stay], node[stay]
            goes_right = x.ravel().take(f.take(node).astype(np.int64) * len(node) + np.arange(len(node))) > b.take(node)
            node = 2 * rank.take(node) + goes_right
            right0, right1 = t0[at] - l0, t1[at] - l1
            t0, t1 = (np.column_stack([a[splits], c[splits]]).ravel() for a, c in ((l0, right0), (l1, right1)))
        feature, cut, left, share, gain = joined(levels)
        inner = feature != _LEAF
        importance = np.bincount(feature[inner], gain[inner], n_features)
        importance = importance / importance.sum() if importance.sum() > 0 else importance
        at = range(0, len(feature), row_nodes)
        part = lambda a: [a[i:i + row_nodes].tobytes() for i in at]
        return pd.DataFrame({"tree": [tree] * len(at), "part": [*range(len(at))], "feature": part(feature), "bin": part(cut), "left": part(left),
                             "share": part(share), "importance": [importance.tolist()] * len(at)})
    return grow


def fit_trees(rows: DataFrame, label: str, features: Sequence[str], grid: Sequence[Sequence[float]], n_trees: int, depth: int, tries: int,
              bootstrap: bool, seed: int) -> TreeTable:
    """``n_trees`` trees on all valid ``rows`` (``label`` 0 or 1), by ``tree_grower``."""
    spark = rows.sparkSession
    counts = _celled(rows, features, grid).groupBy("__cell").agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    return grow_on(spark, _packed(counts), features, grid, n_trees, depth, tries, bootstrap, seed)


def grow_on(spark: SparkSession, blocks: DataFrame, features: Sequence[str], grid: Sequence[Sequence[float]], n_trees: int, depth: int, tries: int,
            bootstrap: bool, seed: int) -> TreeTable:
    """``n_trees`` trees on packed cells."""
    keys = _group_keys(spark, -(-n_trees // GROUP_TREES))
    trees_of = {key: range(g * GROUP_TREES, min((g + 1) * GROUP_TREES, n_trees)) for g, key in enumerate(keys)}
    grow = tree_grower([len(g) for g in grid], depth, tries, bootstrap, seed, ROW_NODES)

    def grown(batches):
        def of(key, held):
            cell, n0, n1 = (np.concatenate([np.frombuffer(r[i], dtype=np.int64) for r in held]) for i in range(3))
            order = np.argsort(cell)  # one order, however the cells lay
            for tree in trees_of[key]:
                yield grow(cell[order], n0[order], n1[order], tree)
        now, held = None, []
        for b in batches:
            for r in b.itertuples(index=False):
                if now is not None and r.g != now:
                    yield from of(now, held)
                    held = []
                now = r.g
                held.append((r.cell, r.n0, r.n1))
        if now is not None:
            yield from of(now, held)
    dealt = blocks.withColumn("g", F.explode(F.array(*[F.lit(k).cast("long") for k in keys]))).repartition(len(keys), "g").sortWithinPartitions("g")
    path = scratch_path(spark, "trees", keep=True)
    dealt.mapInPandas(grown, _TREE).write.parquet(path)
    out = TreeTable(list(features), [[float(t) for t in g] for g in grid], n_trees, [], path)
    each = np.zeros((n_trees, len(features)))
    for r in out.trees(spark).where(F.col("part") == 0).select("tree", "importance").collect():
        each[r["tree"]] = r["importance"]
    total = each.sum(axis=0)
    out.importances = (total / total.sum() if total.sum() > 0 else total).tolist()
    return out


def tree_votes(sizes: Sequence[int]):
    """(cells, a tree's node arrays) -> the share of class 1 in the leaf of each cell."""
    n_features = len(sizes)

    def bins(cell):
        rest, x = cell, np.empty((n_features, len(cell)), dtype=np.uint8)
        for f in reversed(range(n_features)):
            rest, x[f] = np.divmod(rest, sizes[f])
        return x

    def votes(x, feature, cut, left, share):
        flat, n = x.ravel(), x.shape[1]
        node, rows = np.zeros(n, dtype=np.int64), np.arange(n)
        while len(rows):
            here = node.take(rows)
            f = feature.take(here)
            inner = f != _LEAF
            rows, here, f = rows[inner], here[inner], f[inner].astype(np.int64)
            node[rows] = left.take(here) + (flat.take(f * n + rows) > cut.take(here))
        return share.take(node)
    return bins, votes


def score_cells(model: TreeTable, cells: DataFrame) -> DataFrame:
    """Rows (__cell, __n) with ``__s``: the mean of the trees' shares of class 1, and the class that has more of them."""
    spark = cells.sparkSession
    blocks = _packed(cells.select("__cell", F.col("__n").alias("n0"), F.lit(0).cast("long").alias("n1")))
    keys = _group_keys(spark, -(-model.n_trees // GROUP_TREES))
    group = F.element_at(F.array(*[F.lit(k).cast("long") for k in keys]), (F.floor(F.col("tree") / GROUP_TREES) + 1).cast("int"))
    none = F.lit(None).cast("binary")
    trees = model.trees(spark).select(group.alias("g"), F.lit(0).alias("kind"), "tree", "part", "feature", "bin", "left", "share", none.alias("cell"), none.alias("n"))
    asked = blocks.select(F.explode(F.array(*[F.lit(k).cast("long") for k in keys])).alias("g"), F.lit(1).alias("kind"), F.lit(0).alias("tree"), F.lit(0).alias("part"),
                          none.alias("feature"), none.alias("bin"), none.alias("left"), none.alias("share"), "cell", F.col("n0").alias("n"))
    bins, votes = tree_votes([len(g) for g in model.grid])
    place, n_trees = {k: i for i, k in enumerate(keys)}, model.n_trees

    def voted(batches):
        """The trees of a group come first, then all cells, block by block."""
        now, parts, ready = None, {}, []
        for b in batches:
            for r in b.itertuples(index=False):
                if r.g != now:
                    now, parts, ready = r.g, {}, []
                if r.kind == 0:
                    parts.setdefault(r.tree, []).append([np.frombuffer(a, dtype=d) for a, d in ((r.feature, np.uint8), (r.bin, np.uint8), (r.left, np.int32), (r.share, float))])
                    continue
                if parts:
                    ready, parts = [[np.concatenate(c) for c in zip(*parts[t])] for t in sorted(parts)], {}
                x = bins(np.frombuffer(r.cell, dtype=np.int64))
                out = np.zeros(x.shape[1])
                for tree in ready:
                    out += votes(x, *tree)
                yield pd.DataFrame({"block": [int(np.frombuffer(r.cell[:8], dtype=np.int64)[0])], "at": [place[now]], "votes": [out.tobytes()],
                                    "cell": [r.cell if place[now] == 0 else None], "n": [r.n if place[now] == 0 else None]})

    def summed(held):
        held = held.sort_values("at")  # groups in order: the same sum every time
        p = reduce(lambda a, b: a + b, [np.frombuffer(v, dtype=float) for v in held["votes"]]) / n_trees
        return pd.DataFrame({"__cell": np.frombuffer(held["cell"].iloc[0], dtype=np.int64), "__n": np.frombuffer(held["n"].iloc[0], dtype=np.int64),
                             "p": p, "prediction": (p > 0.5).astype(float)})
    dealt = trees.unionByName(asked).repartition(len(keys), "g").sortWithinPartitions("g", "kind", "tree", "part")
    parts = dealt.mapInPandas(voted, "block long, at int, votes binary, cell binary, n binary")
    sums = parts.groupBy("block").applyInPandas(summed, "__cell long, __n long, p double, prediction double")
    return sums.select("__cell", "__n", F.struct("p", "prediction").alias("__s"))


def score_rows(model: TreeTable, rows: DataFrame) -> DataFrame:
    """The valid rows with ``__s``; rows of one cell share a score, which is computed once."""
    celled = _celled(rows, model.features, model.grid)
    cells = score_cells(model, celled.groupBy("__cell").agg(F.count(F.lit(1)).alias("__n")))
    return join_group_values(celled, ["__cell"], cells, "__n", ["__s"]).drop("__cell")
