"""Substring deduplication by hashing lines or paragraphs.

Units (lines, or paragraphs between blank lines) are normalised and digested; the
digests are grouped over the whole corpus; the earliest ranked occurrence of each
stays and every later one is cut out of its document, with the original offsets of
what was removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ROW_KEY, cut, keyed, same_row, squeeze
from contrail.operators.joins import join_group_values

SEPARATOR = {"line": "\n", "paragraph": "\n\n"}
#: Every unit that is not empty counts, whatever its length or script; a caller may spare short ones.
MIN_WORDS = 1


def normalise(unit: Column) -> Column:
    """Lower case, one space between words, none at the ends."""
    return F.trim(squeeze(F.lower(unit)))


def units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, row_hash, pos, digest of every unit that is not empty and has at least ``min_words`` words."""
    parts = keyed(docs).select(*ROW_KEY, F.posexplode(F.split("text", SEPARATOR[unit], -1)).alias("pos", "unit"))
    normal = parts.select(*ROW_KEY, "pos", normalise(F.col("unit")).alias("unit"))
    long_enough = F.col("unit") != ""
    if min_words > 1:
        long_enough = F.size(F.split("unit", " ", min_words)) >= min_words
    return normal.where(long_enough).select(*ROW_KEY, "pos", F.unhex(F.md5("unit")).alias("digest"))


def removals(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, row_hash, gone: ascending positions of the units that a document loses.

    Rank: doc_id (nulls last), then the row's digest, then position. Rows alike in
    doc_id and text are one document.
    """
    seen = cut(units(docs, unit, min_words), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash", "pos")
    repeated = (seen.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("__last"), F.count("*").alias("n"))
                .where(F.col("first") != F.col("__last")).select("digest", "first", "n"))
    # a frequent line's rows stay where they are: their first rank is broadcast
    ranked = join_group_values(seen, ["digest"], repeated, "n", ["first"])
    later = ranked.where(F.col("first").isNotNull() & (rank != F.col("first")))
    return later.groupBy(*ROW_KEY).agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def substring_dedup(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_units, n_removed, removed_chars, removed_spans, kept_spans, kept_text.

    Spans are 'start:end' in code points of the original text, end exclusive, joined by
    commas. ``kept_text`` joins the kept units by the separator.

    - null text is empty (one empty unit, nothing removed); empty units, white space alone included, always stay;
    - units repeated inside one document count like any other repeat;
    - rows alike in doc_id and text get the same result;
    - an empty table gives an empty result; other columns are ignored.
    """
    sep = SEPARATOR[unit]
    joined = same_row(keyed(docs), removals(docs, unit, min_words)).select("doc_id", "text", "gone")

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, text, gone in zip(pdf["doc_id"], pdf["text"], pdf["gone"], strict=True):
                drop = set() if gone is None else set(map(int, gone))
                start, kept, kept_at, gone_at, chars = 0, [], [], [], 0
                parts = text.split(sep)
                for i, part in enumerate(parts):
                    end = start + len(part)
                    if i in drop:
                        gone_at.append(f"{start}:{end}")
                        chars += len(part)
                    else:
                        kept.append(part)
                        kept_at.append(f"{start}:{end}")
                    start = end + len(sep)
                rows.append((doc_id, len(parts), len(drop), chars, ",".join(gone_at), ",".join(kept_at), sep.join(kept)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_units", "n_removed", "removed_chars", "removed_spans", "kept_spans", "kept_text"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return joined.mapInPandas(rebuild, "doc_id long, n_units long, n_removed long, removed_chars long, "
                                       "removed_spans string, kept_spans string, kept_text string")
