"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted with numpy on a bounded sample of labelled rows, flattened into
heap-ordered arrays (split feature, threshold, leaf value) and applied to every
document of a batch and every tree at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import bound_batches

#: The only bound: labelled rows used to fit, taken in order of a digest of doc_id. All documents are scored.
MAX_FIT_ROWS = 20_000
KEEP_SCORE = 0.7

STATISTICS = [
    "log_bytes", "log_words", "log_lines", "mean_word", "longest_word", "short_words", "distinct_words", "distinct_lines",
    "mean_line", "upper", "lower", "digits", "spaces", "high_bytes", "stops", "commas", "shouts", "pipes", "marks", "quotes",
    "brackets", "other_signs", "byte_entropy", "words_per_stop", "control",
]


def _bytes(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), dtype=np.uint8)


_GROUPS = {
    "stops": _bytes("."), "commas": _bytes(",;:"), "shouts": _bytes("!?"), "pipes": _bytes("|"), "marks": _bytes("&$%#*@~^"),
    "quotes": _bytes("\"'`"), "brackets": _bytes("()[]{}<>"), "other_signs": _bytes("+-/=\\_"),
}


def statistics(text: str | None) -> list[float]:
    """STATISTICS of one whole text; shares are per byte, all 0 for an empty text."""
    raw = (text or "").encode("utf-8", "replace")
    n = len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    n_words = max(1, len(words))
    share = count[count > 0] / n
    group = {k: float(count[v].sum()) for k, v in _GROUPS.items()}
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), float(lengths.sum()) / n_words,
        float(lengths.max()) if len(words) else 0.0, float((lengths <= 3).sum()) / n_words, len(set(words)) / n_words,
        len(set(lines)) / len(lines), n / len(lines), count[65:91].sum() / n, count[97:123].sum() / n, count[48:58].sum() / n,
        count[32] / n, count[128:].sum() / n, *(group[k] / n for k in _GROUPS),
        float(-(share * np.log2(share)).sum()), len(words) / (1.0 + group["stops"]), (count[:32].sum() - count[9] - count[10] - count[13]) / n,
    ]


@dataclass
class Trees:
    """Complete trees of one depth in heap order: ``feature``/``threshold`` (trees, 2^depth - 1), ``leaf`` (trees, 2^depth)."""
    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row; all trees of a row descend together."""
        if not self.feature.size or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        tree = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        inner = self.feature.shape[1]
        row = np.arange(len(x))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
        return 1 / (1 + np.exp(-(self.base + self.leaf[tree, at - inner].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.1,
        shrink: float = 2.0, least: float = 4.0) -> Trees:
    """Second-order boosting of the logistic loss on binned features (no labels: an even score)."""
    if not len(y):
        return Trees(0.0, np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 1)))
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    code = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    rate_1 = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(rate_1 / (1 - rate_1)))
    margin = np.full(n, base)
    inner, column = 2**depth - 1, np.arange(width)[None, :]
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            k = 2**level
            slot = ((node[:, None] * width + column) * bins + code).ravel()
            hist_g = np.bincount(slot, np.repeat(g, width), k * width * bins).reshape(k, width, bins).cumsum(axis=2)
            hist_h = np.bincount(slot, np.repeat(h, width), k * width * bins).reshape(k, width, bins).cumsum(axis=2)
            all_g, all_h = hist_g[:, :, -1:], hist_h[:, :, -1:]
            gain = hist_g**2 / (hist_h + shrink) + (all_g - hist_g)**2 / (all_h - hist_h + shrink) - all_g**2 / (all_h + shrink)
            gain[(hist_h < least) | (all_h - hist_h < least)] = 0
            best = gain.reshape(k, -1).argmax(axis=1)
            feature, split = best // bins, best % bins
            useful = gain.reshape(k, -1).max(axis=1) > 1e-9
            for i in np.flatnonzero(useful):
                out.feature[t, k - 1 + i] = feature[i]
                out.threshold[t, k - 1 + i] = edges[feature[i]][split[i]]
            right = useful[node] & (code[np.arange(n), feature[node]] > split[node])
            node = 2 * node + right
        sums = np.bincount(node, g, inner + 1), np.bincount(node, h, inner + 1)
        out.leaf[t] = -rate * sums[0] / (sums[1] + shrink)
        margin += out.leaf[t][node]
    return out


def held_out() -> Column:
    """Rows never learnt from: crc32 of doc_id as text has remainder 2 modulo 4 (a null doc_id is not held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Trees:
    """Fit on at most ``max_rows`` labelled documents that are not held out.

    Labels other than 0 and 1 and null doc_ids are left out; a doc_id labelled more than
    once counts with its mean label; a doc_id with several texts adds each of them.
    """
    bound_batches(docs.sparkSession)
    labelled = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
                .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
                .groupBy("doc_id").agg(F.avg("quality").alias("quality")))
    chosen = labelled.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # at most max_rows

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(stats, pa.list_(pa.float64())), batch.column("quality")],
                                             names=["doc_id", "stats", "quality"])

    # rows that repeat a doc_id could exceed the bound: it holds for what reaches the fit as well
    rows = texts.mapInArrow(describe, "doc_id long, stats array<double>, quality double")
    rows = rows.orderBy("doc_id", "stats").limit(max_rows).toPandas()
    x = np.array(rows["stats"].tolist(), dtype=np.float64).reshape(len(rows), len(STATISTICS))
    return fit(x, rows["quality"].to_numpy(dtype=np.float64))


def _scores(model: Trees, texts: list[str | None], block: int = 2000) -> np.ndarray:
    parts = [model.score(np.array([statistics(t) for t in texts[i:i + block]], dtype=np.float64).reshape(-1, len(STATISTICS)))
             for i in range(0, len(texts), block)]
    return np.concatenate(parts) if parts else np.zeros(0)


def score_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.7).

    Every whole text is scored, empty and null ones too (alike). Only the text is an
    input of a score, so repeated texts score alike. Without labels every score is 0.5.
    An empty table gives an empty result; other columns are ignored.
    """
    model = train(docs, labels, max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scores(model, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= KEEP_SCORE).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """The documents predicted to be good, all columns as they came."""
    model = train(docs, labels, max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array(_scores(model, texts) >= KEEP_SCORE))

    return docs.mapInArrow(run, docs.schema)
