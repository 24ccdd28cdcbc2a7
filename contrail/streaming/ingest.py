"""Run stage 1 of the batch plan (cleaning, lookups, scalar features) on newly
arriving raw files with Structured Streaming.

Every stage-1 operator is row-level or a stream-static join against a small,
size-checked lookup, so the same functions apply unchanged to a streaming
DataFrame. The per-group counts of stage 2 need whole groups and stay batch.
The stream's progress lives in a checkpoint under the shared
``spark.checkpoint.dir``; an executor or driver restart resumes from it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contrail import schema as S
from contrail.operators.cleaning import clean_flights
from contrail.operators.enrich import enrich_flights
from contrail.operators.features import add_scalar_features
from contrail.session import ensure_checkpoint_dir


def cleaned_stream(raw: DataFrame, airlines: DataFrame, airports: DataFrame,
                   patches: Mapping[str, tuple[float, float]] = S.COORDINATE_PATCHES) -> DataFrame:
    """Stage 1 over a (streaming or batch) raw frame."""
    return add_scalar_features(enrich_flights(clean_flights(raw, airports), airlines, airports, patches))


def clean_stream(spark: SparkSession, source_dir: str, airlines: DataFrame, airports: DataFrame,
                 sink_dir: str, name: str = "flights-stage1", fmt: str = "csv",
                 schema: T.StructType = S.FLIGHTS_RAW,
                 patches: Mapping[str, tuple[float, float]] = S.COORDINATE_PATCHES,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental stage-1 job: new files in ``source_dir`` -> Parquet
    under ``sink_dir`` partitioned by MONTH. Returns the running query."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = cleaned_stream(reader.load(source_dir), airlines, airports, patches)
    checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    writer = (out.writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .partitionBy("MONTH").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)
