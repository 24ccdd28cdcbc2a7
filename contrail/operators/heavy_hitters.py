"""Most frequent values without counting all of them.

Every task keeps at most ``counters`` values per column (Misra-Gries): a value it counts
c times occurs between c and c + e times in the task's rows, and a value it does not keep at
most e times, e being at most rows / (counters + 1). Summaries add up: over all tasks a value
lies between C and C + E. A value outside the summaries occurs at most E times, so where the
k-th largest C is above E the k most frequent values are among those with C + E no smaller
than it; one more pass counts these exactly. Where it is not (flat columns), the summary proves
nothing and the column's values are counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.joins import broadcast_if_small
from contrail.session import materialize

COUNTERS = 1_000


def shrink(counts: dict, counters: int) -> int:
    """Take the (counters + 1)-th largest count off every count and drop what is left with none; returns what was taken off."""
    if len(counts) <= counters:
        return 0
    off = sorted(counts.values(), reverse=True)[counters]
    for value in [v for v, c in counts.items() if c <= off]:
        del counts[value]
    for value in counts:
        counts[value] -= off
    return off


def _summaries(counters: int):
    """Batches of (column_name, value) -> (column_name, value, n, e): a column's error on a row of its own with a null value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict] = {}
        error: dict[str, int] = {}
        for batch in batches:
            # equal pairs of a batch are counted first
            table = pa.Table.from_batches([batch]).group_by(["column_name", "value"]).aggregate([([], "count_all")])
            for name in pc.unique(table.column("column_name")).to_pylist():
                some = table.filter(pc.equal(table.column("column_name"), name))
                mine = counts.setdefault(name, {})
                for value, n in zip(some.column("value").to_pylist(), some.column("count_all").to_pylist(), strict=True):
                    mine[value] = mine.get(value, 0) + n
                    if len(mine) > 4 * counters:
                        error[name] = error.get(name, 0) + shrink(mine, counters)
        rows = []
        for name, mine in counts.items():
            error[name] = error.get(name, 0) + shrink(mine, counters)
            rows += [(name, value, n, 0) for value, n in mine.items()] + [(name, None, 0, error[name])]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                                         names=["column_name", "value", "n", "e"])
    return run


def frequent_values(pairs: DataFrame, k: int, counters: int = COUNTERS) -> DataFrame:
    """column_name, value, n: exact counts of a set of values that holds the ``k`` most frequent ones of every column.

    ``pairs``: column_name, value (text; null values are left out). What is shuffled is bounded by the
    summaries, ``counters`` values per column and task, but for columns too flat for a proof.
    ``pairs`` is read twice.
    """
    rows = pairs.select("column_name", F.col("value").cast("string").alias("value")).where("column_name IS NOT NULL AND value IS NOT NULL")
    found = materialize(rows.mapInArrow(_summaries(counters), "column_name string, value string, n long, e long")
                        .groupBy("column_name", "value").agg(F.sum("n").alias("n"), F.sum("e").alias("e")), "frequent-summaries")
    error = found.where("value IS NULL").select("column_name", "e")
    values = found.where("value IS NOT NULL").select("column_name", "value", "n")
    by_count = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    kth = values.withColumn("r", F.row_number().over(by_count)).where(F.col("r") <= k).groupBy("column_name").agg(
        F.min("n").alias("least"), F.count("*").alias("seen"))
    # fewer than k values and nothing dropped: all values are known
    bound = error.join(kth, "column_name", "left").select(
        "column_name", F.when(F.coalesce("seen", F.lit(0)) < k, F.lit(0)).otherwise(F.col("least") - F.col("e")).alias("from_n"),
        F.when(F.coalesce("seen", F.lit(0)) < k, F.col("e") == 0).otherwise((F.col("least") > F.col("e")) | (F.col("e") == 0)).alias("proven"))
    bound = materialize(bound, "frequent-bounds")  # one row per column
    survivors = materialize(values.join(F.broadcast(bound.where("proven")), "column_name").where("n >= from_n").select("column_name", "value"), "frequent-survivors")
    exact = rows.join(broadcast_if_small(survivors), ["column_name", "value"], "left_semi")
    flat = rows.join(F.broadcast(bound.where("NOT proven").select("column_name")), "column_name", "left_semi")
    return exact.unionByName(flat).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def top_values(pairs: DataFrame, k: int, counters: int = COUNTERS) -> DataFrame:
    """column_name, value, n, rank: the ``k`` most frequent values of every column, ties by value; exact."""
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    return frequent_values(pairs, k, counters).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def cells(columns: dict[str, Column]) -> Column:
    """Array of (column_name, value) of the given cells, nulls left out: explode it into ``pairs``."""
    return F.array_compact(F.array(*[F.when(c.isNotNull(), F.struct(F.lit(name).alias("column_name"), c.cast("string").alias("value")))
                                     for name, c in columns.items()]))
