"""Spelling variant grouping with PartEnum signatures.

A word's letters are a multiset, and a multiset is a binary vector with one dimension
per (letter, how many before it). One replaced letter changes two dimensions, one
inserted or deleted letter changes one. PartEnum deals the dimensions to parts and
enumerates the subsets of parts that the changes can have left alone, so near words
share at least one signature: none is missed. Signatures are equi-joined and the pairs
verified by edit distance.

Letters alone make large groups (anagrams, words of frequent syllables). An edit leaves
one half of the word as it is, so a signature is completed by a half: a word enters under
its first half and under its last half, and large groups fall apart without loss.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, id_and_text, mixed64

# Fixed values of the contract.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DELETE_EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5

#: (changed dimensions, parts): subsets of parts - changed are enumerated.
REPLACED = (2, 4)
INSERTED = (1, 2)
#: Distinct words that a task holds before it hands its counts on.
FLUSH = 200_000


def dropped(doc_id: int | None, run: str) -> str:
    """The run, or for one in DELETE_EVERY (document, run) pairs the run without one letter."""
    h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
    if h % DELETE_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n over all whole texts; tasks hand on partial counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            texts = pc.ascii_lower(batch.column("text")).to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                for word, n in Counter(RUN.findall(text)).items():
                    word = dropped(doc_id, word)
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) > FLUSH:
                    yield flush()
        yield flush()

    parts = id_and_text(docs).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _dimensions(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, dimension) of every letter: its code and how many equal ones the word has before it."""
    lengths = np.array([len(w) for w in words])
    owner = np.repeat(np.arange(len(words)), lengths)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    order = np.lexsort((letters, owner))
    owner, letters = owner[order], letters[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (letters[1:] != letters[:-1])
    at = np.arange(len(owner))
    before = at - np.maximum.accumulate(np.where(new, at, 0))
    return owner, letters * (1 << 32) + before


def signatures(words: list[str], changed: int, parts: int) -> np.ndarray:
    """One column per subset of ``parts - changed`` parts: the sum of the hashed dimensions in those parts."""
    owner, dims = _dimensions(words)
    hashed = mixed64(dims)
    part = (mixed64(dims + 1) % np.uint64(parts)).astype(np.int64)
    sums = np.zeros((len(words), parts), dtype=np.uint64)
    np.add.at(sums, (owner, part), hashed)
    with np.errstate(over="ignore"):
        return np.stack([mixed64(sums[:, list(c)].sum(axis=1, dtype=np.uint64) + np.uint64(i + 1))
                         for i, c in enumerate(combinations(range(parts), parts - changed))], axis=1)


def _halves(words: list[str], shorter: list[int]) -> np.ndarray:
    """Digests of the first and of the last half, by the length of the shorter word of a pair."""
    first = [zlib.crc32(w[:n // 2].encode()) for w, n in zip(words, shorter, strict=True)]
    last = [zlib.crc32(w[len(w) - (n - n // 2):].encode()) + (1 << 32) for w, n in zip(words, shorter, strict=True)]
    return np.array([first, last], dtype=np.uint64).T


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, n) -> (key, word, n): words that differ by one edit share a key."""
    for pdf in batches:
        if not len(pdf):
            continue
        words = pdf["word"].tolist()
        lengths = np.array([len(w) for w in words])
        columns = []
        # two words of one length, and a word as the shorter or as the longer of a pair
        for kind, (changed, parts), less in (("same", REPLACED, 0), ("other", INSERTED, 0), ("other", INSERTED, 1)):
            shorter = lengths - less
            tag = mixed64(shorter * 2 + (kind == "same"))
            halves = _halves(words, shorter.tolist())
            for signature in signatures(words, changed, parts).T:
                columns += [mixed64(signature ^ tag ^ mixed64(halves[:, side])) for side in (0, 1)]
        keys = np.stack(columns, axis=1)
        rows = np.repeat(np.arange(len(words)), keys.shape[1])
        yield pd.DataFrame({"key": keys.ravel().view(np.int64), "word": pdf["word"].to_numpy()[rows], "n": pdf["n"].to_numpy()[rows]})


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: every two words that differ by exactly one inserted, deleted or replaced letter, once (a < b)."""
    keys = cut(words.mapInPandas(_keys, "key long, word string, n long"), "spelling-keys")
    left = keys.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = keys.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    near = (F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    return left.join(right, (left["key"] == right["key"]) & near).select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the last one, the distance doubling with each round.

    Each form is at least RATIO times as frequent as its word, so chains are short and have no circles.
    """
    at = cut(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("w"), F.col("root").alias("next"))
        step = at.join(ahead, at["root"] == ahead["w"], "left")
        moved = cut(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are the runs of RUN in the texts, A-Z in lower case, some of them less one letter
    (``dropped``), of at least ``min_length`` letters and ``min_count`` occurrences. Near words
    differ by one edit; a word's form is its most frequent near word (ties: the smaller word)
    if that is ``ratio`` (at least 2) times as frequent; its root is the last form that follows.

    - null and empty texts have no words; repeated rows count as often as they stand;
    - a null doc_id stands as the text 'null';
    - a near word counts whether or not it is frequent enough to be the form; the form is null where it is not;
    - an empty table gives an empty result; columns other than doc_id and text are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2: equal counts could form a circle")
    words = cut(word_counts(docs, min_length, min_count), "spelling-words")
    pairs = near_pairs(words)
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
                    F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near")))
    near = pairs.select(F.inline(sides)).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left").withColumn("best_n", -F.col("best.order"))
    is_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    named = cut(found.select("word", F.when(is_form, F.col("best.near")).alias("form"), "n",
                             F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
