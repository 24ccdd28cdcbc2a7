import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.operators.enrich import join_airlines
from contrail.operators import joins
from contrail.operators.joins import (
    attach_group_count, fits_broadcast, join_group_values, lookup_join, row_count_at_most, semi_join, skewed_lookup_join,
)


def _skewed(spark):
    rows = [("HOT", i % 3) for i in range(300)] + [(f"k{i % 40}", i % 2) for i in range(200)] + \
           [(None, 1) for _ in range(50)]
    return spark.createDataFrame([(i, k, g) for i, (k, g) in enumerate(rows)], "id int, k string, g int")


@pytest.mark.parametrize("max_hot", [10_000, 2])
def test_attach_group_count_matches_window(spark, max_hot):
    df = _skewed(spark)
    got = {r.id: r.n for r in attach_group_count(df, ["k", "g"], "n", max_hot_groups=max_hot).collect()}
    w = Window.partitionBy("k", "g")
    want = {r.id: (r.n if r.k is not None else None)
            for r in df.withColumn("n", F.count(F.lit(1)).over(w)).collect()}
    assert got == want


def test_attach_group_count_null_safe_counts_null_group(spark):
    df = _skewed(spark)
    got = {r.id: r.n for r in attach_group_count(df, ["k"], "n", null_safe=True, max_hot_groups=2).collect()}
    nulls = [i for i, v in got.items() if i >= 500]
    assert all(got[i] == 50 for i in nulls)
    assert got[0] == 300


def test_hot_groups_go_to_broadcast_side(spark):
    df = _skewed(spark)
    groups = df.where(F.col("k").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("w"), F.max("g").alias("mg"))
    out = join_group_values(df, ["k"], groups, "w", ["mg"], max_hot_groups=2)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "BroadcastHashJoin" in buf.getvalue()
    assert out.count() == df.count()


def test_lookup_join_refuses_duplicate_keys(spark):
    fact = spark.createDataFrame([("AA",)], "AIRLINE string")
    dup = spark.createDataFrame([("AA", "x"), ("AA", "y")], "IATA_CODE string, AIRLINE string")
    with pytest.raises(ValueError):
        join_airlines(fact, dup)
    ok = spark.createDataFrame([("AA", "x")], "IATA_CODE string, AIRLINE string")
    assert join_airlines(fact, ok).first().AIRLINE_FULL_NAME == "x"
    lk = spark.createDataFrame([("AA", "x")], "AIRLINE string, n string")
    assert lookup_join(fact, lk, ["AIRLINE"], max_broadcast_rows=0).count() == 1


def test_hot_identical_rows_are_not_shuffled_together(spark):
    """Copies of one row stay spread over the tasks that read them; other groups take the shuffle join."""
    rows = spark.range(0, 20_000, 1, 8).selectExpr("'HOT' AS k", "1 AS g").unionByName(
        spark.range(0, 400, 1, 2).selectExpr("IF(id % 50 = 0, NULL, concat('k', id % 40)) AS k", "CAST(id % 2 AS INT) AS g"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = attach_group_count(rows, ["k", "g"], "n", null_safe=True, max_hot_groups=2, broadcast_max_rows=0)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
        assert "SortMergeJoin" in buf.getvalue()
        hot = out.where("k = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) == 8 and {r["count"] for r in hot} == {2500}
        got = sorted(map(str, out.collect()))
        want = sorted(map(str, rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k", "g"))).collect()))
        assert got == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_proofs_do_not_pass_to_another_frame_of_the_same_shape(spark, tmp_path):
    """A good lookup first, one with duplicate keys second: in memory and from files."""
    fact = spark.createDataFrame([("AA",)], "AIRLINE string")
    good = [("AA", "x")]
    twice = [("AA", "x"), ("AA", "y")]
    frame = lambda rows: spark.createDataFrame(rows, "IATA_CODE string, AIRLINE string")
    assert join_airlines(fact, frame(good)).count() == 1
    with pytest.raises(ValueError):
        join_airlines(fact, frame(twice))
    path = str(tmp_path / "lookup")
    frame(good).write.parquet(path)
    assert join_airlines(fact, spark.read.parquet(path)).count() == 1
    frame(twice).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError):
        join_airlines(fact, spark.read.parquet(path))


def test_size_proofs_are_per_frame(spark):
    small = spark.createDataFrame([(i,) for i in range(5)], "k int")
    large = spark.createDataFrame([(i,) for i in range(500)], "k int")
    assert row_count_at_most(small, 100) and not row_count_at_most(large, 100)
    assert fits_broadcast(small, 100) and not fits_broadcast(large, 100)
    wide = spark.range(50).selectExpr("id", "repeat('x', 1000) AS t")
    assert fits_broadcast(wide, 100) and not fits_broadcast(wide, 100, max_bytes=10_000) and not fits_broadcast(wide, 0)


def test_file_proofs_are_kept(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "kept")
    spark.range(10).write.parquet(path)
    assert row_count_at_most(spark.read.parquet(path), 10)
    monkeypatch.setattr(joins.DataFrame, "limit", lambda *_: pytest.fail("read again"))
    assert row_count_at_most(spark.read.parquet(path), 10)


@pytest.fixture()
def plain_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_above_the_limit_with_a_hot_carrier(spark, plain_joins, how):
    """One carrier holds half the rows: they stay in the eight tasks that read them; the others are shuffled."""
    hot = spark.range(0, 4000, 1, 8).selectExpr("id", "'HOT' AS k")
    cold = spark.range(4000, 8000, 1, 8).selectExpr("id", "IF(id % 40 = 0, NULL, concat('k', id % 900)) AS k")
    fact = hot.unionByName(cold)
    lookup = spark.range(850).selectExpr("concat('k', id) AS k", "id * 2 AS v", "repeat('n', 5) AS name").unionByName(
        spark.sql("SELECT 'HOT' AS k, -1L AS v, 'hot' AS name"))
    # a key of 1/100 of the rows is hot here: only HOT
    got = lookup_join(fact, lookup, ["k"], how, max_broadcast_rows=0, max_hot_groups=100)
    want = fact.join(lookup, ["k"], how)
    assert got.columns == want.columns
    tasks = got.where("k = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 8 and {r["count"] for r in tasks} == {500}
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    tight = skewed_lookup_join(fact, lookup, ["k"], how, max_hot_groups=100_000, max_bytes=5_000)
    assert sorted(map(str, tight.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("limit", [0, 1000])
def test_semi_and_anti_join_of_a_hot_key(spark, plain_joins, limit):
    fact = spark.range(0, 4000, 1, 8).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'HOT' WHEN id % 41 = 0 THEN NULL ELSE concat('k', id % 70) END AS k")
    keys = spark.createDataFrame([("HOT",), ("HOT",), (None,)] + [(f"k{i}",) for i in range(30)], "code string")
    for anti, how in ((False, "left_semi"), (True, "left_anti")):
        got = semi_join(fact, "k", keys, "code", anti=anti, max_broadcast_rows=limit, max_hot_groups=100)
        want = fact.join(keys, fact["k"] == keys["code"], how)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("broadcast_max_rows", [0, 1000])
def test_a_join_of_group_values_that_are_not_read_is_not_planned(spark, broadcast_max_rows):
    rows = spark.range(400).selectExpr("IF(id % 50 = 0, NULL, concat('k', id % 40)) AS k", "CAST(id % 2 AS INT) AS g", "id")
    out = attach_group_count(rows, ["k", "g"], "n", max_hot_groups=1, broadcast_max_rows=broadcast_max_rows)
    assert "Join" not in _plan(out.select("id", "g")) and "Join" in _plan(out)
    assert sorted(r["id"] for r in out.select("id").collect()) == list(range(400))
    got = {(r["id"], r["n"]) for r in out.collect()}
    counted = rows.where("k IS NOT NULL").groupBy("k", "g").agg(F.count(F.lit(1)).alias("n"))
    assert got == {(r["id"], r["n"]) for r in rows.join(counted, ["k", "g"], "left").collect()}


def test_unread_counts_are_planned_without_a_job_and_right_if_read(spark):
    from contrail.operators import features as FT
    from contrail.plans.pipeline import feature_stage
    rows = [(i, None if i % 7 == 0 else f"N{i % 5}", "A" if i % 3 else "B", None if i % 11 == 0 else 2015 + i % 2, i % 24) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, TAIL_NUMBER string, ORIGIN_AIRPORT string, y int, DEPARTURE_HOUR int")
    df = df.withColumn("FLIGHT_DATE", F.make_date("y", F.lit(3), F.lit(1) + F.col("k") % 9)).drop("y")
    spark.sparkContext.setJobGroup("unread", "unread")
    lean = feature_stage(df, reads=[])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("unread")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0
    assert "Join" not in lean.select("k", "ORIGIN_AIRPORT")._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, lean.collect()), key=str) == sorted(map(tuple, feature_stage(df).collect()), key=str)
    part = feature_stage(df, reads=[FT.CONGESTION])
    assert part.columns == lean.columns
    assert sorted(map(str, part.select("k", FT.CONGESTION).collect())) == sorted(map(str, lean.select("k", FT.CONGESTION).collect()))


def test_features_are_planned_apart_by_the_counts_that_are_read(spark, monkeypatch):
    from contrail.operators import features as FT
    from contrail.plans import pipeline as PL
    monkeypatch.setattr(PL, "fixture_enriched", lambda spark, sf: "stage 1")
    monkeypatch.setattr(PL, "feature_stage", lambda stage1, reads: tuple(reads))
    monkeypatch.setattr(PL, "_MEMO", {})
    assert PL.fixture_features(spark, "x", reads=[]) == ()
    assert PL.fixture_features(spark, "x", reads=[FT.CONGESTION]) == (FT.CONGESTION,)
    assert PL.fixture_features(spark, "x") == PL.COUNTS
    assert PL.fixture_features(spark, "x", reads=[]) == PL.COUNTS  # planned for all: serves as well
