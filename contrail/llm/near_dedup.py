"""MinHash near-deduplication by chosen-path set similarity join.

Documents become sets of word shingles; equal sets are one item. Each of several
trees starts with all items. The roots select coordinates of the minwise sketch without
replacement, two each; in any other node two are selected by the node's own hash. An
item follows both: its child is
named by the coordinate and the token it has there, so similar items keep meeting
while others part. Nodes of one item end; small nodes are compared exhaustively on
their sketches; large ones branch again. A pair of similarity s is missed by a tree
with probability at most 1 - (2s - 1) / s^2 at any depth (0.03 at 0.85), and by all
trees with about that to the power of their number: they share no coordinate at the
roots, where a pair that meets nowhere is missed with (1 - s)^6, but may further down.

Similarity is decided on full shingle sets inside the nodes: the texts of a block of
items meet in one task, their overlaps are computed at once, and only a spanning
forest of the confirmed links leaves it, so output grows with the items and not with
their pairs. The first tree links most of what there is; the others then only look at
nodes that hold items of different components. Nodes that stay large (a large group
of near copies never parts) are handled in blocks: within blocks first, then the
items outside a node's most frequent component against all its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ROW_KEY, cut, keyed, same_row

SHINGLE_WORDS = 5
PERCENT = 80
SKETCH = 64
TREES = 3
BRANCH = 2
DEPTH = 3
#: Nodes of up to this many items are compared exhaustively; larger ones at DEPTH in blocks of it.
NODE = 128
#: In a node that stays large, the second round sets blocks of so many items against blocks of so many askers.
BLOCK = 512
SEED = 10
WORDS_REMEMBERED = 500_000

_rng = np.random.default_rng(SEED)
_FACTOR = _rng.integers(0, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 2**63, SKETCH, dtype=np.uint64)
#: Coordinates in the order in which the roots of the trees take them, BRANCH each.
_ROOT_ORDER = np.random.default_rng([SEED, 1]).permutation(SKETCH).tolist()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted 64-bit hashes of a text's distinct shingles; remembers word hashes of its task."""

    def __init__(self, size: int):
        self.size = size
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """Words are runs without ASCII white space, A-Z in lower case; fewer words than a shingle are one shingle."""
        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.known) > WORDS_REMEMBERED:
            self.known = {}
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        codes = np.array([known[w] for w in words], dtype=np.uint64)
        size = min(self.size, len(codes))
        out = np.full(len(codes) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + codes[i:len(codes) - size + 1 + i])
        return np.unique(out)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """SKETCH minwise tokens (32 bits each)."""
    least = np.full(SKETCH, 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[i:i + 4096, None] * _FACTOR + _SHIFT).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def least_estimate(percent: int) -> float:
    """Share of equal tokens below which a pair is no candidate: 4.5 standard deviations under the threshold."""
    s = percent / 100
    return s - 4.5 * (s * (1 - s) / SKETCH) ** 0.5


def _describe(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            n, ids, sketches = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingler(text)
                n.append(len(s))
                ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sketches.append(sketch(s).view(np.int32) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_hash"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(sketches, pa.list_(pa.int32()))], names=["doc_id", "row_hash", "n_shingles", "item", "sketch"])
    return run


# ---- trees -------------------------------------------------------------------------------------------------------

def _children(rows: DataFrame, roots: bool) -> DataFrame:
    """(tree, node, item, sketch) -> the BRANCH children of each row, named by selected coordinate and token."""
    if roots:
        order = F.array(*[F.lit(c) for c in _ROOT_ORDER])
        taken = (F.col("tree") - 1) * BRANCH
        picks = [F.get(order, F.pmod(taken + i, F.lit(SKETCH)).cast("int")) for i in range(BRANCH)]
        return _followed(rows, picks)
    first = F.pmod(F.xxhash64("node", F.lit(0)), F.lit(SKETCH))
    step = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(SKETCH - 1)) + 1
    return _followed(rows, [F.pmod(first + step * F.lit(i), F.lit(SKETCH)).cast("int") for i in range(BRANCH)])


def _followed(rows: DataFrame, picks: list[Column]) -> DataFrame:
    chosen = rows.withColumn("at", F.explode(F.array(*picks)))
    return chosen.select("tree", F.xxhash64("node", "at", F.get("sketch", F.col("at"))).alias("node"), "item")


def leaf_nodes(items: DataFrame, trees: int = TREES, depth: int = DEPTH, node_size: int = NODE) -> DataFrame:
    """(tree, node, n, item): members of the nodes to compare; n is the node's size (above ``node_size`` only at ``depth``)."""
    level = items.select(F.explode(F.sequence(F.lit(1), F.lit(trees))).alias("tree"), "item", "sketch")
    level = level.select("tree", F.col("tree").cast("long").alias("node"), "item", "sketch")
    leaves = None
    for d in range(1, depth + 1):
        rows = cut(_children(level, d == 1), "path-level")
        sizes = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        sized = cut(rows.join(sizes, "node").select("tree", "node", "n", "item"), "path-sized")
        large = sized.where(F.col("n") > node_size)
        last = d == depth or large.isEmpty()
        mine = sized if last else sized.where(F.col("n") <= node_size)
        leaves = mine if leaves is None else leaves.unionByName(mine)
        if last:
            return leaves
        level = large.select("tree", "node", "item").join(items.select("item", "sketch"), "item")
    return leaves


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of each key of a partition sorted by it."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        keys = table[key].to_numpy()
        heads = np.flatnonzero(np.diff(keys)) + 1
        start = 0
        for end in heads.tolist():
            yield table.slice(start, end - start)
            start = end
        rest = table.slice(start)
    if rest is not None and rest.num_rows:
        yield rest


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block")


def _alike(least: float, across: bool):
    """mapInArrow over blocks with sketches: the rows of items that have a candidate partner in
    the block (``across``: in another component, one of the two asking)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, "block"):
            tokens = np.array(block["sketch"].combine_chunks().flatten()).reshape(block.num_rows, SKETCH)
            if across:
                label = np.unique(block["label"].to_pylist(), return_inverse=True)[1]
                asks = np.array(block["asks"].to_pylist())
            near = np.zeros(len(tokens), dtype=bool)
            for i in range(len(tokens) - 1):
                hit = (tokens[i + 1:] == tokens[i]).mean(axis=1) >= least
                if across:
                    hit &= (label[i + 1:] != label[i]) & (asks[i + 1:] | asks[i])
                near[i + 1:] |= hit
                near[i] |= hit.any()
            if near.any():
                yield from block.drop(["sketch"]).filter(pa.array(near)).to_batches()
    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from products of the sets' indicator matrix, column block by column block."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[code] > 1  # a shingle of one set is in no intersection
    owner, code = owner[shared], np.unique(code[shared], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    out = np.zeros((len(sets), len(sets)))
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, 8192):
        part = slice(*np.searchsorted(code, [low, low + 8192]))
        held = np.zeros((len(sets), 8192), dtype=np.float32)
        held[owner[part], code[part] - low] = 1
        out += held @ held.T
    np.fill_diagonal(out, size)
    return out.astype(np.int64)


def _links(size: int, percent: int, across: bool):
    """mapInArrow over blocks with texts: a spanning forest of the links confirmed on full sets
    (``across``: of the components, over links between them)."""
    def forest(block: pa.Table, shingler: Shingler) -> list[tuple[bytes, bytes]]:
        items = block["item"].to_pylist()
        sets = [shingler(t) for t in block["text"].to_pylist()]
        n, both = np.array([len(s) for s in sets]), overlaps(sets)
        linked = np.triu(100 * both >= percent * (n[:, None] + n[None, :] - both), 1)
        group = np.arange(len(items))
        if across:
            group = np.unique(block["label"].to_pylist(), return_inverse=True)[1]
        parent = list(range(len(items)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        out = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
            x, y = root(int(group[i])), root(int(group[j]))
            if x != y:
                parent[y] = x
                out.append((items[i], items[j]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for block in _groups(batches, "block"):
            if block.num_rows > 1 and (found := forest(block, shingler)):
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"])
    return run


_LINK = "a binary, b binary"


def _with_sketch(rows: DataFrame, items: DataFrame) -> DataFrame:
    return _by_block(rows.join(items.select("item", "sketch"), "item"))


def _with_text(rows: DataFrame, texts: DataFrame) -> DataFrame:
    return _by_block(rows.join(texts, "item"))


def _n_blocks(node_size: int):
    return F.ceil(F.col("n") / node_size).cast("int")


def first_blocks(small: DataFrame, large: DataFrame, node_size: int = NODE) -> DataFrame:
    """(block, item) of the first round: the small nodes of the first tree, and for each item of its
    large nodes one node, in blocks that also hold the node's first item."""
    one = large.where("tree = 1").groupBy("item").agg(F.min(F.struct("node", "n")).alias("x")).select("item", "x.node", "x.n")
    own = F.pmod(F.xxhash64("item"), _n_blocks(node_size))
    leaders = one.groupBy("node", "n").agg(F.min("item").alias("item")).select(
        "node", "item", F.explode(F.sequence(F.lit(0), _n_blocks(node_size) - 1)).alias("i"))
    placed = one.select(F.xxhash64("node", own.cast("int")).alias("block"), "item").unionByName(
        leaders.select(F.xxhash64("node", "i").alias("block"), "item"))
    return small.where("tree = 1").select(F.col("node").alias("block"), "item").unionByName(placed).distinct()


def crossing_blocks(small: DataFrame, large: DataFrame, labels: DataFrame, node_size: int = NODE, block: int = BLOCK) -> DataFrame:
    """(block, item, label, asks) of the second round: nodes whose items lie in several components.

    Small nodes of the first tree are done; the other small ones are one block each. In a
    large node the items outside its most frequent component ask: every block of askers
    meets every block of items, so no block grows with the node.
    """
    rows = small.where("tree > 1").unionByName(large).join(labels, "item")
    kinds = rows.groupBy("node", "label").agg(F.count("*").alias("m")).groupBy("node").agg(
        F.count("*").alias("k"), F.sum("m").alias("here"), F.max(F.struct("m", "label")).alias("common")).where("k > 1")
    count = lambda n: F.greatest(F.lit(1), F.ceil(n / block).cast("int"))
    kinds = kinds.select("node", F.col("common.label").alias("common"), count(F.col("here")).alias("n_items"),
                         count(F.col("here") - F.col("common.m")).alias("n_askers"))
    split = F.col("n") > node_size
    asks = ~split | (F.col("label") != F.col("common"))
    part = lambda seed, n: F.pmod(F.xxhash64("item", F.lit(seed)), F.col(n)).cast("int")
    place = lambda i, j, ask: F.struct(i.alias("i"), j.alias("j"), F.lit(ask).alias("asks"))
    answers = F.transform(F.sequence(F.lit(0), F.col("n_askers") - 1), lambda j: place(part(1, "n_items"), j, False))
    asked = F.transform(F.sequence(F.lit(0), F.col("n_items") - 1), lambda i: place(i, part(2, "n_askers"), True))
    one = F.array(place(F.lit(0), F.lit(0), True))
    places = F.when(~split, one).when(asks, F.concat(answers, asked)).otherwise(answers)
    placed = rows.join(kinds, "node").select("node", "item", "label", F.explode(places).alias("at"))
    return placed.select(F.xxhash64("node", "at.i", "at.j").alias("block"), "item", "label", "at.asks").distinct()


# ---- components --------------------------------------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(item, label) for every linked item: label is the least item of its component.

    Alternates large-star and small-star steps (each keeps the components and shortens
    paths) until nothing changes; then every item points at its least one.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = cut(edges, "stars")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every edge now points at a smaller item; each item's neighbours move to its least one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        edges = cut(moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                    .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("item"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("item"), F.col("v").alias("label")).distinct())
        state = now


def near_dedup(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH,
               node_size: int = NODE) -> DataFrame:
    """One row per input row: doc_id, row_hash, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links (Jaccard similarity of
    the shingle sets at least ``percent``/100), the document's own included.

    - texts that are null, empty or without words have no shingles and link with nothing;
    - equal sets are linked; rows alike in doc_id and text share their result;
    - a null doc_id is smallest only where its component has no other;
    - an empty table gives an empty result; other columns are ignored.
    """
    rows = keyed(docs)
    described = cut(rows.mapInArrow(_describe(size), "doc_id long, row_hash long, n_shingles long, item binary, sketch array<int>"), "sketches")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")
    # an item's sketch follows from its set, so any of its rows gives it
    found = described.where("item is not null").groupBy("item").agg(F.min(rank).alias("one"), F.max("sketch").alias("sketch"))
    items = cut(found.select("item", "one.doc_id", "one.row_hash", "sketch"), "items")

    leaves = leaf_nodes(items, trees, depth, node_size)
    large = leaves.where(F.col("n") > node_size)
    alone = leaves.where(F.col("n") <= node_size).withColumn("block", F.col("node"))
    kind = "item binary, tree int, node long, n long, block long"
    small = cut(_with_sketch(alone, items).select("item", "tree", "node", "n", "block", "sketch")
                .mapInArrow(_alike(least_estimate(percent), False), kind).drop("block"), "candidates")
    need = cut(small.select("item").unionByName(large.select("item")).distinct(), "candidate-items")
    wanted = items.select("item", *ROW_KEY).join(need, "item")
    texts = same_row(rows.select(*ROW_KEY, "text"), wanted, "inner").select("item", "text")
    if docs_repeat(described):  # rows alike in doc_id and text would come more than once
        texts = texts.dropDuplicates(["item"])
    texts = cut(texts, "texts")

    links = cut(_with_text(first_blocks(small, large, node_size), texts).select("block", "item", "text")
                .mapInArrow(_links(size, percent, False), _LINK), "links")
    labels = cut(components(links), "labels")
    # candidates without a link so far are components of their own
    named = need.join(labels, "item", "left").select("item", F.coalesce("label", "item").alias("label"))
    crossing = crossing_blocks(small, large, named, node_size, min(BLOCK, 4 * node_size))
    alike = cut(_with_sketch(crossing, items).select("block", "item", "label", "asks", "sketch")
                .mapInArrow(_alike(least_estimate(percent), True), "block long, item binary, label binary, asks boolean"), "crossing")
    further = cut(_with_text(alike.drop("asks").distinct(), texts).select("block", "item", "label", "text")
                  .mapInArrow(_links(size, percent, True), _LINK), "links")
    if not further.isEmpty():
        labels = cut(components(links.unionByName(further)), "labels")

    owner = items.select("item", F.col("doc_id").alias("own")).join(labels, "item", "left").select(
        "item", "own", F.coalesce("label", "item").alias("label"))
    least = owner.groupBy("label").agg(F.min("own").alias("component"))
    component = cut(owner.join(least, "label").select("item", "component"), "components")
    out = described.drop("sketch").join(component, "item", "left")
    at = F.when(F.col("item").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select(*ROW_KEY, "n_shingles", at.alias("component_id"), F.col("doc_id").eqNullSafe(at).alias("kept"))


def docs_repeat(described: DataFrame) -> bool:
    """Whether any row repeats another's doc_id and text."""
    return not described.groupBy(*ROW_KEY).agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group, all columns; rows that repeat a kept doc_id and text stay together."""
    kept = near_dedup(docs, size, percent).where("kept").select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash")).distinct()
    on = docs["doc_id"].cast("long").eqNullSafe(kept["_id"]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == kept["_hash"])
    return docs.join(kept, on, "left_semi")
