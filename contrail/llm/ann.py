"""Approximate nearest neighbours by cross-polytope hashing.

Vectors go to the unit sphere, each by its own length, are turned by fast Hadamard
pseudo-rotations (three rounds of random signs and a Hadamard transform) and hashed to
the nearest signed axis. A table's cell is the axis of one rotation, or of several whose
number grows with the logarithm of the row count, so cells stay small. A query probes in
each table the cells nearest to it (by the distances to the axes); the probed share falls
as the table grows. Candidates are reranked exactly on the original vectors.

Directions alone would lose long vectors at a wide angle, whose inner products are large
all the same: a vector is entered in as many of its nearest cells as it is longer than the
median vector, so very long ones are candidates of every query. The k + 1 longest ones are
too, so that k neighbours are found where there are k.

Equal vectors are one class that is searched once. Bucket and query groups above a
block size are split into blocks that meet pairwise, so a hot bucket spreads over
tasks and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import cut
from contrail.operators.joins import broadcast_if_small

TABLES = 12
#: Share of a table's cells that a query probes at SHARE_ROWS rows; it falls with this power of the row count.
SHARE, SHARE_ROWS, FALL = 0.04, 10_000, 0.2
#: Rows of a cell at least, on average: more rows take one more rotation per table.
CELL_ROWS = 64
BLOCK = 8192
SEED = 20
#: The longest vectors that are candidates of every query, beyond the k + 1 longest: none are needed.
HEAD = 0
HEAD_TABLE = -1


def plan(rows: int, dim: int) -> tuple[int, int]:
    """(rotations per table, probed cells per table) for so many rows."""
    axes = 2 * _axes(dim)
    rotations = max(1, int(np.log(max(rows / CELL_ROWS, 1)) / np.log(axes)))
    share = SHARE * (SHARE_ROWS / max(rows, 1)) ** FALL
    return rotations, int(min(axes**rotations, max(1, np.ceil(axes**rotations * share))))


def _axes(dim: int) -> int:
    size = 1
    while size < dim:
        size *= 2
    return size


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of each row (row length a power of two)."""
    n, d = x.shape
    step = 1
    while step < d:
        pair = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def rotate(x: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """Pseudo-rotation of one table: fixed by (seed, table) on whichever executor it runs."""
    rng = np.random.default_rng([seed, table])
    for signs in rng.integers(0, 2, (3, x.shape[1])) * 2.0 - 1.0:
        x = hadamard(x * signs)
    return x


def _sphere(vectors: list, dim: int) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64).reshape(len(vectors), dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    out = np.zeros((len(x), _axes(dim)))
    out[:, :dim] = x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def nearest_cells(x: np.ndarray, table: int, rotations: int, take: int, seed: int = SEED) -> np.ndarray:
    """Per row the ``take`` cells of a table nearest to it, nearest first: a cell is one signed axis per rotation, its
    distance the sum of squared gaps to the best axes."""
    cells, gaps = np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1))
    for r in range(rotations):
        turned = rotate(x, table * rotations + r, seed)
        signed = np.concatenate([turned, -turned], axis=1)
        gap = (signed.max(axis=1, keepdims=True) - signed) ** 2
        # a cell among the nearest has its part so far among the nearest, so no more than ``take`` of those are kept
        sums = (gaps[:, :, None] + gap[:, None, :]).reshape(len(x), -1)
        names = (cells[:, :, None] * signed.shape[1] + np.arange(signed.shape[1])).reshape(len(x), -1)
        keep = np.argsort(sums, axis=1, kind="stable")[:, :take]
        cells, gaps = np.take_along_axis(names, keep, axis=1), np.take_along_axis(sums, keep, axis=1)
    return cells


def _hasher(dim: int, tables: int, rotations: int, probes: int, query: bool, seed: int) -> Callable:
    """mapInPandas: (cls, first, vec, copies) -> one row (cls, first, vec, tab, bucket) per table and cell; queries have
    ``probes`` cells per table, and one bucket for the longest vectors."""
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            if query:
                yield pdf[["cls", "first", "vec"]].assign(tab=HEAD_TABLE, bucket=0)
            takes = np.full(len(pdf), probes) if query else pdf["copies"].to_numpy()
            for take in np.unique(takes):
                every = np.flatnonzero(takes == take)
                step = max(1, 2_000_000 // (int(take) * 2 * _axes(dim)))  # rows whose sums fit some ten megabytes
                for at in range(0, len(every), step):
                    part = pdf.iloc[every[at:at + step]]
                    x = _sphere(list(part["vec"]), dim)
                    for table in range(tables):
                        near = nearest_cells(x, table, rotations, int(take), seed)
                        rows = np.repeat(np.arange(len(part)), near.shape[1])
                        yield pd.DataFrame({"cls": part["cls"].to_numpy()[rows], "first": part["first"].to_numpy()[rows],
                                            "vec": part["vec"].to_numpy()[rows], "tab": table, "bucket": near.ravel()})
    return run


def _best(dim: int, top: int) -> Callable:
    """Cogrouped block of one bucket: each query's ``top`` best classes, exact scores, ties to the class with the smaller first vec_id."""
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(queries):
            return pd.DataFrame({"q_cls": [], "cls": [], "score": []})
        order = np.lexsort((index["cls"].to_numpy(), index["first"].to_numpy()))
        ids = index["cls"].to_numpy()[order]
        x = np.array(list(index["vec"]), dtype=np.float64).reshape(-1, dim)[order]
        found = []
        for at in range(0, len(queries), 1024):
            part = queries.iloc[at:at + 1024]
            scores = np.array(list(part["vec"]), dtype=np.float64).reshape(-1, dim) @ x.T
            # first vec_ids ascend, so a stable sort leaves ties with the smaller one first
            best = np.argsort(-scores, axis=1, kind="stable")[:, :top]
            found.append(pd.DataFrame({"q_cls": np.repeat(part["cls"].to_numpy(), best.shape[1]), "cls": ids[best].ravel(),
                                       "score": np.take_along_axis(scores, best, axis=1).ravel()}))
        return pd.concat(found)
    return run


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, vec: rows whose vector is not null, empty or zero, without null or non-finite components."""
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
            .where(F.col("vec_id").isNotNull() & vec.isNotNull() & (F.size(vec) > 0))
            .where(finite).where(F.exists(vec, lambda x: x != 0)))


def nearest(embeddings: DataFrame, query_every: int = 20, k: int = 20, tables: int = TABLES, probes: int | None = None,
            block: int = BLOCK, seed: int = SEED, head: int = HEAD) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose vec_id is divisible by ``query_every``.

    Score is the inner product in double precision on the original vectors; nearest
    first, ties to the smaller vec_id; a query is not its own neighbour.

    - vectors that are null, empty, zero or hold a null or non-finite component take no part;
    - vectors of another length than the most frequent (ties: the longer) take no part, as no inner product exists;
    - rows that repeat a vec_id and its vector count once; a vec_id with several vectors keeps each of them;
    - k neighbours wherever there are k others, else all others; an empty table gives an empty result.
    """
    # One row of equal vec_id and vector, then classes of equal vectors. A neighbour list can use
    # at most k+1 members of a class (the query itself may be one), always those of smallest id;
    # the rank limit is applied before the shuffle too, so a huge class stays small.
    rows = usable_vectors(embeddings).withColumn("dim", F.size("vec")).dropDuplicates(["vec_id", "vec"])
    dims = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return embeddings.sparkSession.createDataFrame([], schema)
    dim = int(dims[0]["dim"])
    rows = rows.where(F.col("dim") == dim).drop("dim")
    by_vec = Window.partitionBy("vec").orderBy("vec_id")
    members = rows.withColumn("rn", F.row_number().over(by_vec)).where(F.col("rn") <= k + 1)
    classes = cut(members.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                  .withColumn("cls", F.xxhash64("vec", F.col("ids")[0])), "ann-classes")

    # rows and classes meet on the vector; queries of one class share one search
    asked = rows.where(F.col("vec_id") % query_every == 0)
    asked = cut(asked.join(classes.select("vec", "cls"), "vec").select("vec_id", "cls"), "ann-queries")
    hashed = "cls long, first long, vec array<double>, tab int, bucket long"
    # logarithm of the length, finite for components of any size
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    length = F.log(largest) + F.log(F.aggregate("vec", F.lit(0.0), lambda s, x: s + (x / largest) * (x / largest))) / 2
    named = classes.select("cls", F.col("ids")[0].alias("first"), "vec", length.alias("length"))
    size = named.agg(F.count("*").alias("n"), F.percentile_approx("length", 0.5, 1000).alias("median")).first()
    rotations, cells = plan(size["n"], dim)
    probes = probes or cells
    most = (2 * _axes(dim)) ** rotations
    # times longer than the median, to the power of the rotations; rounded up to a power of two
    doubled = F.ceil((F.col("length") - F.lit(size["median"])) * F.lit(rotations / np.log(2)) - F.lit(1e-9))
    copies = F.least(F.lit(most), F.pow(F.lit(2.0), F.greatest(F.lit(0), F.least(doubled, F.lit(40)))).cast("long")).alias("copies")
    asked_classes = named.join(asked.select("cls").distinct(), "cls", "left_semi").select("cls", "first", "vec")
    # the longest vectors are one bucket more, and every query probes it
    longest = named.orderBy(F.desc("length"), "first", "cls").limit(max(head, k + 1)).select(
        "cls", "first", "vec", F.lit(HEAD_TABLE).alias("tab"), F.lit(0).cast("long").alias("bucket"))
    entered = named.select("cls", "first", "vec", copies)
    index = cut(entered.mapInPandas(_hasher(dim, tables, rotations, 0, False, seed), hashed).unionByName(longest), "ann-index")
    queries = cut(asked_classes.mapInPandas(_hasher(dim, tables, rotations, probes, True, seed), hashed), "ann-probes")

    # the buckets that need more than one block, by either side
    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias(name)).where(F.col(name) > 1)
    wide = cut(blocks(index, "n_i").join(blocks(queries, "n_q"), ["tab", "bucket"], "full"), "ann-blocks")
    sizes = broadcast_if_small(wide.select("tab", "bucket", F.coalesce("n_i", F.lit(1)).alias("n_i"), F.coalesce("n_q", F.lit(1)).alias("n_q")))
    sized = lambda df: df.join(sizes, ["tab", "bucket"], "left").fillna(1, ["n_i", "n_q"])
    key = ["tab", "bucket", "i", "q"]
    own = lambda n: F.pmod(F.xxhash64("cls", F.lit(7)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sized(index).withColumn("i", own("n_i")).withColumn("q", every("n_q")).select(*key, "cls", "first", "vec")
    right = sized(queries).withColumn("q", own("n_q")).withColumn("i", every("n_i")).select(*key, "cls", "first", "vec")
    scored = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_best(dim, k + 1), "q_cls long, cls long, score double")

    # the same pair may come from several tables
    pairs = scored.groupBy("q_cls", "cls").agg(F.max("score").alias("score")).join(classes.select("cls", "ids"), "cls")
    per_class = Window.partitionBy("q_cls").orderBy(F.desc("score"), F.col("ids")[0])
    best = pairs.withColumn("rn", F.row_number().over(per_class)).where(F.col("rn") <= k + 1)
    listed = best.select("q_cls", "score", F.explode("ids").alias("vec_id"))
    lists = listed.withColumn("rn", F.row_number().over(Window.partitionBy("q_cls").orderBy(F.desc("score"), "vec_id")))
    lists = lists.where(F.col("rn") <= k + 1).groupBy("q_cls").agg(F.array_sort(F.collect_list(F.struct("rn", "vec_id", "score"))).alias("near"))
    found = asked.join(lists, asked["cls"] == lists["q_cls"]).select(F.col("vec_id").alias("query_id"), "near")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return found.select("query_id", F.posexplode(others).alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), "x.vec_id", "x.score")
