"""End-to-end plans: raw flights -> cleaned -> enriched -> features.

The chain has two persisted stages, both written as Parquet under the shared
checkpoint folder (or a given output path):

1. *enriched*: row-level cleaning, airport filter, lookup joins, coordinate
   patch and the scalar features -- all narrow work (broadcast joins only).
2. *features*: the per-group utilisation counts joined back onto stage 1.

Persisting stage 1 cuts the lineage before the shuffles (a lost executor
re-reads files instead of recomputing the joins) and keeps each later plan a
short scan instead of a copy of the whole cleaning chain per join branch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from contrail import schema as S
from contrail.operators.cleaning import clean_flights, clean_rows
from contrail.operators.enrich import enrich_flights
from contrail.operators.features import (
    CONGESTION, PER_DAY, PER_WEEK, add_origin_congestion, add_scalar_features, add_tail_counts, congestion_groups, tail_count_groups,
)
from contrail.session import intermediates, materialize, session_key
from contrail.sources.files import read_airlines, read_airports, read_flights
from contrail.sources.fixtures import FIXTURE_COORDINATE_PATCHES, flight_views

COUNTS = (PER_DAY, PER_WEEK, CONGESTION)


@dataclass
class FlightFrames:
    raw: DataFrame
    airlines: DataFrame
    airports: DataFrame

    @property
    def cleaned(self) -> DataFrame:
        return clean_flights(self.raw, self.airports)

    def enriched(self, patches: Mapping[str, tuple[float, float]] = S.COORDINATE_PATCHES) -> DataFrame:
        # one inner join per airport role filters and enriches
        return enrich_flights(clean_rows(self.raw), self.airlines, self.airports, patches, how="inner")


def enriched_rows(frames: FlightFrames, patches: Mapping[str, tuple[float, float]] = S.COORDINATE_PATCHES) -> DataFrame:
    """Stage 1: cleaned + enriched + scalar features."""
    return add_scalar_features(frames.enriched(patches))


def enriched_stage(frames: FlightFrames, patches: Mapping[str, tuple[float, float]] = S.COORDINATE_PATCHES,
                   output: str | None = None) -> DataFrame:
    """Stage 1, persisted: cleaned + enriched + scalar features."""
    return _persist(enriched_rows(frames, patches), "flights-enriched", output)


def feature_stage(enriched: DataFrame, output: str | None = None,
                  partition_by: Sequence[str] = ("MONTH",), persist: bool = False,
                  reads: Sequence[str] = COUNTS, **skew) -> DataFrame:
    """Stage 2: stage 1 plus the three per-group counts.

    The two group tables are aggregated and persisted first, except those of which the caller
    ``reads`` no column: their counts are planned, not computed until a query reads them. The whole table is
    written only where the caller asks for it, with ``output`` or ``persist=True``
    (worth it where many reads follow and a group table is too big to broadcast).
    """
    whole = bool(output or persist)
    tail_read, cong_read = whole or PER_DAY in reads or PER_WEEK in reads, whole or CONGESTION in reads
    tail_g, cong_g = tail_count_groups(enriched), congestion_groups(enriched)
    table = (enriched.transform(add_tail_counts, groups=materialize(tail_g, "tail-groups") if tail_read else tail_g, unread=not tail_read, **skew)
             .transform(add_origin_congestion, groups=materialize(cong_g, "congestion-groups") if cong_read else cong_g, unread=not cong_read, **skew))
    return _persist(table, "flights-features", output, partition_by) if whole else table


def _persist(table: DataFrame, name: str, output: str | None,
             partition_by: Sequence[str] = ("MONTH",)) -> DataFrame:
    if output is None:
        return materialize(table, name)
    table.write.mode("overwrite").partitionBy(*partition_by).parquet(output)
    return table.sparkSession.read.parquet(output)


def build_feature_table(raw: DataFrame, airlines: DataFrame, airports: DataFrame,
                        patches: Mapping[str, tuple[float, float]] = S.COORDINATE_PATCHES,
                        output: str | None = None, partition_by: Sequence[str] = ("MONTH",),
                        **skew) -> DataFrame:
    """The whole batch job: raw flights and lookups in, the feature table out.

    With ``output`` the final table is written there (Parquet partitioned by
    ``partition_by`` -- MONTH for one year of flights, YEAR and MONTH for
    several -- so month filters prune files); the intermediate stage always goes
    to the shared checkpoint folder.
    """
    stage1 = enriched_stage(FlightFrames(raw, airlines, airports), patches)
    return feature_stage(stage1, output, partition_by, **skew)


# ---------------------------------------------------------------------------
# The same chain over the flight-shaped views of the driver tables
# ---------------------------------------------------------------------------

_MEMO: dict[tuple[str, ...], DataFrame] = {}


def fixture_frames(spark: SparkSession, sf_dir: str) -> FlightFrames:
    raw, airlines, airports = flight_views(spark, sf_dir)
    return FlightFrames(raw, airlines, airports)


def fixture_enriched(spark: SparkSession, sf_dir: str, persist: bool = False) -> DataFrame:
    """Stage 1 over ``sf_dir`` (planned once per session and input), written only with ``persist=True``.

    Its 73 columns take longer to compute and write than one query takes to compute those that it
    reads: unless many queries follow, each is planned down to the raw flights' files.
    """
    key = (session_key(spark), sf_dir, "enriched")
    if persist or key not in _MEMO:
        build = enriched_stage if persist else enriched_rows
        _MEMO[key] = build(fixture_frames(spark, sf_dir), FIXTURE_COORDINATE_PATCHES)
    return _MEMO[key]


def fixture_features(spark: SparkSession, sf_dir: str, persist: bool = False, reads: Sequence[str] = COUNTS) -> DataFrame:
    """Stage 2 over ``sf_dir`` (planned once per session, input and counts that are read); its group tables are persisted.
    ``persist``: on a written stage 1, in whose files' order its rows come. ``reads``: the counts that the query reads; a
    table planned for more of them serves as well."""
    kind = "features-written" if persist else "features"
    whole = (session_key(spark), sf_dir, kind)
    key = whole if persist or set(COUNTS) <= set(reads) else (*whole, "reads", *sorted(reads))
    if whole in _MEMO:
        return _MEMO[whole]
    if key not in _MEMO:
        stage1 = enriched_stage(fixture_frames(spark, sf_dir), FIXTURE_COORDINATE_PATCHES) if persist else fixture_enriched(spark, sf_dir)
        _MEMO[key] = feature_stage(stage1, reads=COUNTS if key == whole else reads)
    return _MEMO[key]


def reset_memo() -> None:
    _MEMO.clear()


def run_batch(spark: SparkSession, flights_path: str, airlines_path: str, airports_path: str, output: str,
              fmt: str = "csv", patches: Mapping[str, tuple[float, float]] = S.COORDINATE_PATCHES,
              partition_by: Sequence[str] = ("MONTH",), **skew) -> DataFrame:
    """The production job: raw flight file(s) and the two lookup files in, the
    feature table out (Parquet under ``output``, partitioned by MONTH)."""
    raw = read_flights(spark, flights_path, fmt)
    airlines = read_airlines(spark, airlines_path)
    airports = read_airports(spark, airports_path)
    with intermediates(spark):  # the output is complete when the block ends; what led to it goes
        return build_feature_table(raw, airlines, airports, patches, output, partition_by, **skew)
