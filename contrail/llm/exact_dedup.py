"""Exact deduplication by content-defined chunk recipes (native DataFrame functions only).

Each normalised text is cut into chunks where its own content says so, a document
becomes the ordered list of its chunk identifiers (its recipe), and recipes are
compared instead of texts. Long documents are moved once, as distinct chunks, to
verify that no two different chunks share an identifier; after that only lists of
8-byte identifiers travel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, free_name, id_and_text, squeeze
from contrail.operators.joins import join_group_values

MIN_CHUNK = 384
MAX_CHUNK = 4096
#: Where a chunk ends is a property of the few characters around the place alone, so a shifted passage is cut in the same
#: places: between certain letters of two words (Latin; then Greek, Cyrillic, Hebrew, Arabic, Devanagari, Korean), between two
#: frequent characters of scripts without spaces, and between two certain characters of a long run without spaces (code,
#: base64). Each is met about once in a hundred characters: places more frequent than that would keep a shift going for long.
#: The first look at each place is a cheap one, as most places are none.
BOUNDARY = ("(?:"
            r"[dgkmpvyzé][,.;:!?]?\x20(?=[b-hB-H])"
            r"|(?=[^\x00-\x7F])(?:"
            r"[\u03B9-\u03BD\u0438-\u043E\u05D9-\u05DD\u0643-\u0646\u0928-\u0930\uAC00-\uB3FF]\x20"
            r"(?=[\u03B1-\u03B5\u0430-\u0435\u05D0-\u05D5\u0627-\u062B\u0905-\u0915\uAC00-\uB3FF])"
            r"|[\u3001\u3002\u7684\u662F\u4E86\u5728\u4E0D\u4E00\u306E\u306F\u306B\u3092\u304C\u0E32\u0E19]"
            r"[\u7684\u662F\u4E86\u5728\u4E0D\u4E00\u306E\u306F\u306B\u3092\u304C\u0E32\u0E19])"
            r"|(?=[45EFef])(?<=[01ABab])(?<=[\x21-\x7E]{21})"
            ")")


def chunk_pattern(min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK, boundary: str = BOUNDARY) -> str:
    """One chunk: the shortest stretch of at least ``min_chunk`` characters that ends in a boundary,
    or ``max_chunk`` characters (or the rest) where there is none."""
    return rf"(?s)(?:.{{{min_chunk},{max_chunk}}}?{boundary}|.{{1,{max_chunk}}})"


def _chunked(docs: DataFrame, pattern: str, chunk_id: Callable[[Column], Column]) -> DataFrame:
    """doc_id, norm, chunks: array of (h, c) in order."""
    base = id_and_text(docs).select("doc_id", squeeze(F.col("text")).alias("norm"))
    chunks = F.regexp_extract_all("norm", F.lit(pattern), F.lit(0))
    return base.select("doc_id", "norm", F.transform(chunks, lambda c: F.struct(chunk_id(c).alias("h"), c.alias("c"))).alias("chunks"))


def exact_dedup(docs: DataFrame, pattern: str | None = None,
                chunk_id: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Texts are equal when identical after white-space runs become one space; the row
    with the smallest doc_id of equal texts stays.

    - null text counts as empty; all empty texts are equal;
    - rows that repeat both doc_id and text have a result row each and the same decision; ``group_size`` counts rows;
    - rows that share a doc_id but not the text are separate documents;
    - a null doc_id is never the smallest unless its whole group has none;
    - no rows in, no rows out; columns other than doc_id and text are ignored.
    """
    pattern = pattern or chunk_pattern()
    chunked = _chunked(docs, pattern, chunk_id)

    # Verify the identifiers: distinct chunks (combined before the shuffle), then identifiers
    # that stand for more than one text. With 64 bits this is almost always empty.
    distinct = chunked.select(F.inline("chunks")).distinct()
    clashing = cut(distinct.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "chunk-clashes")

    recipe = F.transform("chunks", lambda x: x["h"])
    per_text = chunked.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), recipe.alias("recipe"))
    if clashing.isEmpty():
        listed = per_text.withColumn("variants", F.array().cast("array<int>"))
    else:
        listed = _with_variants(chunked, per_text, distinct, clashing)

    seen = cut(listed, "recipes")
    groups = (seen.groupBy("recipe", "variants").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .where("group_size > 1"))
    # rows of a recipe with very many copies meet its group by broadcast and are not shuffled
    out = join_group_values(seen, ["recipe", "variants"], groups, "group_size", ["keep_id", "group_size"])
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", F.size("recipe").alias("n_chunks"))


def _with_variants(chunked: DataFrame, per_text: DataFrame, distinct: DataFrame, clashing: DataFrame) -> DataFrame:
    """Recipes of texts that hold a clashing identifier also list which of its texts each one is."""
    texts = distinct.join(clashing, "h", "left_semi")
    number = F.count("*").over(_below("h", "c")).cast("int")
    variants = texts.select("h", "c", number.alias("variant"))
    spot = F.posexplode("chunks").alias("pos", "x")
    spots = chunked.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), spot).select(
        "doc_id", "text_sha256", "pos", "x.h", "x.c")
    found = spots.join(variants, ["h", "c"]).groupBy("doc_id", "text_sha256").agg(
        F.array_sort(F.collect_set(F.struct("pos", "variant"))).alias("found"))
    found = found.select(F.col("doc_id").alias("f_id"), F.col("text_sha256").alias("f_sha"),
                         F.transform("found", lambda x: x["variant"]).alias("variants"))
    on = per_text["doc_id"].eqNullSafe(found["f_id"]) & (per_text["text_sha256"] == found["f_sha"])
    return per_text.join(found, on, "left").select(
        "doc_id", "text_sha256", "recipe", F.coalesce("variants", F.array().cast("array<int>")).alias("variants"))


def _below(key: str, order: str):
    from pyspark.sql import Window
    return Window.partitionBy(key).orderBy(order)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; rows that repeat a kept doc_id and text stay once.

    Decisions join back on doc_id and the text's digest, so only digests move besides the documents.
    An empty table gives an empty one.
    """
    sha = F.sha2(squeeze(F.coalesce(F.col("text").cast("string"), F.lit(""))), 256)
    kept = cut(exact_dedup(docs).where("kept").groupBy(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_sha"))
               .agg(F.count("*").alias("n_rows")), "kept")
    on = docs["doc_id"].cast("long").eqNullSafe(kept["_keep"]) & (sha == kept["_sha"])
    out = docs.join(kept, on, "left_semi")
    if kept.where("n_rows > 1").isEmpty():
        return out
    name = free_name(docs, "_sha")
    return out.withColumn(name, sha).dropDuplicates(["doc_id", name]).drop(name)
