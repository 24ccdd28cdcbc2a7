import tempfile

from contrail.plans.pipeline import fixture_frames
from contrail.sources.fixtures import FIXTURE_COORDINATE_PATCHES
from contrail.streaming.ingest import clean_stream, cleaned_stream

SF = "/root/testdata/sf0.001"


def test_stream_stage1_equals_batch(spark):
    fr = fixture_frames(spark, SF)
    src = tempfile.mkdtemp(prefix="contrail-src-")
    sink = tempfile.mkdtemp(prefix="contrail-sink-")
    raw = fr.raw
    # two arrivals of raw files
    raw.where("l_orderkey % 2 = 0").write.mode("append").parquet(src)
    raw.where("l_orderkey % 2 = 1").write.mode("append").parquet(src)
    q = clean_stream(spark, src, fr.airlines, fr.airports, sink, name=f"t-{sink[-6:]}", fmt="parquet",
                     schema=raw.schema, patches=FIXTURE_COORDINATE_PATCHES)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    want = cleaned_stream(raw, fr.airlines, fr.airports, FIXTURE_COORDINATE_PATCHES)
    cols = sorted(want.columns)
    assert got.count() == want.count()
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
