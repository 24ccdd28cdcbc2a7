"""Mixing sources to target weights by Poisson replication.

Every document is repeated a Poisson-distributed number of times whose mean is the
repetition rate that takes its source to its target weight. The Poisson variable is
the inverse of the distribution function at a uniform number hashed from the seed
and the doc_id, so any retry of a task draws the same counts. The copies are then
shuffled globally by a hash of (seed, doc_id, copy).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, text_or_empty
from contrail.operators.joins import lookup_join

#: A rate above this is drawn as the sum of equal, independent draws of at most this mean.
MAX_RATE_PER_DRAW = 64.0


def _uniform(seed: int, doc: Column, draw: Column) -> Column:
    """In [0, 1), from the first 52 bits of a digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc, draw.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, total_rate: float = 1.0) -> DataFrame:
    """Per source: size in characters, target weight, mean repetition rate, and the Poisson table.

    ``weights`` maps sources to relative targets (a source it lacks gets 0); None asks for
    equal weights. ``total_rate`` is the expected size of the mix relative to all input.
    Rates count characters, so a source's expected share of characters is its weight.
    """
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).agg(
        F.sum(F.char_length(text_or_empty())).alias("chars"), F.count("*").alias("n_docs"))
    if weights is None:
        target = F.lit(1.0)
    else:
        listed = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else None
        target = F.coalesce(listed[F.col("source")], F.lit(0.0)) if weights else F.lit(0.0)
    # a source of no characters at all cannot be weighted: its documents stay once each on average
    usable = sizes.withColumn("target", F.when(F.col("chars") > 0, target).otherwise(F.lit(0.0)))
    totals = usable.agg(F.sum("chars").alias("all_chars"), F.sum("target").alias("all_target"))
    rate = F.when(F.col("chars") == 0, F.lit(1.0)).when(F.col("all_target") == 0, F.lit(0.0)).otherwise(
        F.col("target") / F.col("all_target") * (F.col("all_chars") * F.lit(float(total_rate))) / F.col("chars"))
    rates = usable.join(F.broadcast(totals)).withColumn("rate", rate)  # totals: one row
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(MAX_RATE_PER_DRAW)).cast("int"))
    per_draw = rates.withColumn("draws", draws).withColumn("lam", F.col("rate") / F.col("draws"))
    # distribution function at 0, 1, 2, ... far beyond the last value that 52 bits can reach
    table = F.expr("""
        aggregate(sequence(1, cast(ceil(lam + 12 * sqrt(lam) + 24) as int)),
                  named_struct('p', exp(-lam), 'c', array(exp(-lam))),
                  (s, k) -> named_struct('p', s.p * lam / k, 'c', concat(s.c, array(element_at(s.c, -1) + s.p * lam / k))),
                  s -> s.c)""")
    return per_draw.select("source", "chars", "n_docs", "target", "rate", "draws", table.alias("cdf"))


def _copies(docs: DataFrame, weights: dict[str, float] | None, total_rate: float, seed: int) -> DataFrame:
    """_row (a struct of all columns of ``docs``), n_copies, copy, shuffle_key, in global shuffle order."""
    known = lambda c: F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))
    rates = cut(source_rates(docs, weights, total_rate).select(known(F.col("source")).alias("__source"), "draws", "cdf"), "source-rates")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), known(F.col("source")).alias("__source"))
    # one row per source, its size checked: documents do not move for it, nor, above the limit, those of hot sources
    joined = lookup_join(rows, rates, ["__source"], "inner", check_unique=False)
    doc = F.coalesce(F.col("_row.doc_id").cast("string"), F.lit("null"))

    def one(total: Column, j: Column) -> Column:
        u = _uniform(seed, doc, j)
        return total + F.size(F.filter("cdf", lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(0), F.col("draws") - 1), F.lit(0), one)
    copies = (joined.select("_row", count.alias("n_copies")).where("n_copies > 0")
              .select("_row", "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy")))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}-shuffle"), doc, F.col("copy").cast("string")))
    return copies.withColumn("shuffle_key", key).orderBy("shuffle_key")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, total_rate: float = 1.0, seed: int = 17) -> DataFrame:
    """All columns of ``docs`` plus n_copies, copy (1..n_copies) and shuffle_key, in global shuffle order.

    - a null source is a source of its own; a null or empty text counts no characters;
    - rows that repeat a doc_id draw the same count;
    - a null doc_id draws as the text 'null';
    - input columns called n_copies, copy or shuffle_key, in whatever case, are replaced
      (``repeat_documents`` keeps them);
    - an empty table gives an empty result.
    """
    made = ("n_copies", "copy", "shuffle_key")
    own = [F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in made]
    return _copies(docs, weights, total_rate, seed).select(*own, *made)


def repeat_documents(docs: DataFrame, weights: dict[str, float] | None = None, total_rate: float = 1.0, seed: int = 17) -> DataFrame:
    """The copies alone: the columns of ``docs`` with their own values, whatever their names, in global shuffle order."""
    return _copies(docs, weights, total_rate, seed).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
