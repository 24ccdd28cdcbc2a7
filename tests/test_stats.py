import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.operators import stats as ST


def _table(spark, counts):
    rows = []
    for g, (n0, n1) in counts.items():
        rows += [(g, 0, 1.0)] * n0 + [(g, 1, 2.0)] * n1
    return spark.createDataFrame(rows, "AIRLINE_NAME string, IS_DELAYED_ARRIVAL int, ARRIVAL_DELAY double")


def test_chi_square_2x2_with_continuity_correction(spark):
    df = _table(spark, {"A": (10, 20), "B": (30, 40)})
    r = ST.chi_square(df).first()
    assert r.statistic == pytest.approx(0.446429, abs=1e-6) and r.dof == 1 and r.n_rows == 100
    r2 = ST.chi_square(df, correction=False).first()
    assert r2.statistic == pytest.approx(0.793651, abs=1e-6)
    p = ST.chi_square_test(df).first()
    assert p.p_value == pytest.approx(0.5040, abs=1e-4) and p.reject_h0 is False


def test_chi_square_zero_cell_counts(spark):
    df = _table(spark, {"A": (10, 0), "B": (5, 5), "C": (0, 10)})
    # expected per cell: A,B,C rows of 10, columns 15/15 -> E = 5 everywhere
    r = ST.chi_square(df).first()
    assert r.statistic == pytest.approx((25 + 25 + 0 + 0 + 25 + 25) / 5) and r.dof == 2


def test_contingency(spark):
    out = {r.AIRLINE_NAME: (r.not_delayed, r.delayed) for r in ST.contingency(_table(spark, {"A": (3, 0), "B": (1, 2)})).collect()}
    assert out == {"A": (3, 0), "B": (1, 2)}


def test_anova_matches_hand_computation(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 5.0), ("b", 6.0)],
                               "AIRLINE_NAME string, ARRIVAL_DELAY double")
    r = ST.anova_test(df).first()
    assert r.f_statistic == pytest.approx(13.5) and (r.df_between, r.df_within) == (1, 4)
    assert r.p_value == pytest.approx(0.021311641128756723, rel=1e-8)


def test_correlation_and_box_stats(spark):
    df = spark.createDataFrame([("a", float(x), float(2 * x)) for x in range(1, 11)] + [("a", 100.0, 200.0)],
                               "AIRLINE_NAME string, ARRIVAL_DELAY double, ORIGIN_CONGESTION double")
    assert ST.correlation(df).first().pearson_r == pytest.approx(1.0)
    b = ST.box_stats(df).first()
    # values 1..10 and 100: q1 = 3.5, q3 = 8.5, upper fence 16 -> whisker at 10, low whisker at 1
    assert (b.q1, b.median, b.q3, b.whisker_low, b.whisker_high) == (3.5, 6.0, 8.5, 1.0, 10.0)


def test_stratified_sample_matches_brute_force(spark):
    rows = [("HOT", i) for i in range(400)] + [(f"g{i % 5}", 1000 + i) for i in range(60)]
    df = spark.createDataFrame(rows, "AIRLINE_NAME string, id int")
    got = ST.stratified_sample(df, "AIRLINE_NAME", n=25, seed=7, order_cols=["id"])
    got = sorted((r.AIRLINE_NAME, r.id) for r in got.collect())
    want = []
    for g in {r[0] for r in rows}:
        ids = sorted((hashlib.md5(f"7|{i}".encode()).hexdigest(), i) for gg, i in rows if gg == g)
        want += [(g, i) for _, i in ids[:25]]
    assert got == sorted(want)
    assert F is not None


def test_stratified_sample_beyond_the_default_size(spark):
    df = spark.range(0, 45_000).selectExpr("'HOT' AS AIRLINE_NAME", "id").unionByName(
        spark.range(0, 100).selectExpr("IF(id % 2 = 0, 'few', NULL) AS AIRLINE_NAME", "id + 100000 AS id"))
    got = ST.stratified_sample(df, "AIRLINE_NAME", seed=7, order_cols=["id"])
    order = sorted(range(45_000), key=lambda i: hashlib.md5(f"7|{i}".encode()).hexdigest())
    assert {r.id for r in got.where("AIRLINE_NAME = 'HOT'").collect()} == set(order[:ST.SAMPLE_PER_GROUP])
    assert got.where("AIRLINE_NAME = 'few'").count() == 50 and got.where("AIRLINE_NAME IS NULL").count() == 50


def test_tails_match_known_values():
    from contrail.functions.special import chi2_sf, f_sf
    # published critical values of the chi-square and F distributions
    for dof, x, p in [(1, 3.841459, .05), (2, 5.991465, .05), (5, 15.08627, .01), (24, 36.41503, .05)]:
        assert chi2_sf(x, dof) == pytest.approx(p, rel=1e-5)
    for f, a, b, p in [(4.9646027, 1, 10, .05), (3.3258345, 5, 10, .05), (5.1432528, 2, 6, .05), (1.5173, 24, 1_000_000, .05)]:
        assert f_sf(f, a, b) == pytest.approx(p, rel=1e-3)
    assert chi2_sf(0, 3) == 1.0 and f_sf(0, 2, 3) == 1.0


def test_quartiles_of_many_values_take_no_task_per_group(spark):
    """One group of a million distinct values beside small ones: every task counts about its share, and the result is exact."""
    big = spark.range(0, 1_000_000, 1, 8).selectExpr("'big' AS g", "CAST(pmod(id * 7919, 1000003) AS DOUBLE) / 3 AS v", "1L AS c")
    small = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("b", -7.0, 1), ("b", 5.0, 1), (None, 4.0, 2), ("z", 9.0, 1)], "g string, v double, c long")
    counts = big.unionByName(small)
    upto = ST.running_counts(counts, "g", "v", "c", ranges=8)
    plan = upto.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in plan) < 400_000
    got = {r.g: (r.n, r.q1, r.median, r.q3) for r in ST.quartiles(counts, "g", "v", "c", ranges=8).collect()}
    x = np.sort(np.array([i * 7919 % 1000003 for i in range(1_000_000)]) / 3.0)
    assert got["big"][0] == 1_000_000 and np.allclose(got["big"][1:], np.quantile(x, [0.25, 0.5, 0.75]), rtol=1e-14)
    assert got["a"] == (4, 1.0, 1.0, 1.25) and got[None] == (2, 4.0, 4.0, 4.0) and got["z"] == (1, 9.0, 9.0, 9.0)
    assert got["b"] == (2, -4.0, -1.0, 2.0)
    assert ST.quartiles(counts.limit(0), "g", "v", "c").count() == 0


def test_running_counts_do_not_depend_on_ranges(spark):
    counts = spark.range(500).selectExpr("CAST(id % 3 AS STRING) AS g", "CAST(id AS DOUBLE) AS v", "id % 4 + 1 AS c")
    rows = [sorted(map(tuple, ST.running_counts(counts, "g", "v", "c", ranges=n).collect())) for n in (1, 5, 64)]
    assert rows[0] == rows[1] == rows[2]
