"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import materialize

#: ASCII white space as the contracts define it.
WS_CLASS = r"[\x20\x09-\x0D]"
#: Runs of white space that are not already one single space.
WS_RUN = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"

#: Key of a row inside an operator: doc_id plus a digest of the text. Rows alike in both
#: are the same document and always get the same result.
ROW_KEY = ["doc_id", "row_hash"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def squeeze(text: Column) -> Column:
    """Every run of white space becomes one space (only runs that are not one already are touched)."""
    return F.regexp_replace(text, WS_RUN, " ")


#: Rows of one Arrow batch of whole texts: at Spark's default of 10,000 a task and its worker hold
#: well over 100 MB of batch. A size that the user has set is kept.
TEXT_BATCH = 1000
_ARROW_ROWS, _SPARK_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to TEXT_BATCH unless it has been set."""
    if spark.conf.get(_ARROW_ROWS) == _SPARK_DEFAULT:
        spark.conf.set(_ARROW_ROWS, TEXT_BATCH)


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that text operators read: doc_id as long, text with null as empty."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """``id_and_text`` plus the digest that tells apart rows which share a doc_id."""
    return id_and_text(docs).withColumn("row_hash", F.xxhash64("text"))


def same_row(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on ROW_KEY, null doc_ids matching each other; the right side's key columns go."""
    on = (left["doc_id"].eqNullSafe(right["doc_id"])) & (left["row_hash"] == right["row_hash"])
    out = left.join(right, on, how)
    return out.drop(right["doc_id"]).drop(right["row_hash"])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: a Parquet table in the shared folder of spark.checkpoint.dir, read back."""
    return materialize(df, f"llm-{name}")


def mixed64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing of integers (splitmix64), the same on every executor."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
