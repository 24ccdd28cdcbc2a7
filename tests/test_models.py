import pytest

from contrail import schema as S
from contrail.operators import models as M
from contrail.operators import prescribe as P


def test_classification_report(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "y int, p int")
    r = {x["class"]: x for x in M.classification_report(df, "y", "p").collect()}
    assert r["1"].precision == pytest.approx(0.6) and r["1"].recall == pytest.approx(0.75) and r["1"].support == 4
    assert r["0"].precision == pytest.approx(0.8) and r["0"].recall == pytest.approx(4 / 6)
    assert r["accuracy"].precision == pytest.approx(0.7) and r["accuracy"].support == 10
    assert r["macro avg"].f1_score == pytest.approx(((2 * .6 * .75 / 1.35) + (2 * .8 * (4 / 6) / (.8 + 4 / 6))) / 2, abs=1e-6)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 0)], "y int, p int")
    r = {x["class"]: x for x in M.classification_report(df, "y", "p").collect()}
    assert r["1"].precision == 0.0 and r["0"].precision == 0.0 and r["0"].f1_score == 0.0


def test_hash_split_is_deterministic(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = M.with_split(df, 0.2, 42).where("is_test").count()
    b = M.with_split(df.repartition(7), 0.2, 42).where("is_test").count()
    assert a == b and 300 < a < 500
    assert M.hash_sample(df, 0.3).count() == M.hash_sample(df.repartition(3), 0.3).count()


def test_train_and_score_small(spark):
    rows = [(float(d), h, 1 + i % 7, c, int(d > 1500), int(h >= 18), cause, 1 + i % 3, 2 + i % 5, int(cause or h >= 20))
            for i, (d, h, c, cause) in enumerate([(100 + 37 * i % 2500, i % 24, i % 9, int(i % 4 == 0)) for i in range(400)])]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {'double' if c == 'DISTANCE' else 'int'}" for c in
                               ["DISTANCE", "DEPARTURE_HOUR", "DAY_OF_WEEK", "ORIGIN_CONGESTION", "IS_LONG_DISTANCE",
                                "IS_EVENING", "HAS_DELAY_CAUSE", "FLIGHTS_PER_TAIL_NUMBER_DAY",
                                "FLIGHTS_PER_TAIL_NUMBER_WEEK", "IS_DELAYED_ARRIVAL"]))
    tm = M.train_models(df, sample_fraction=None, max_fit_rows=None, forest_trees=5, forest_depth=4)
    comp = {r.model: r for r in M.model_comparison(tm).collect()}
    assert set(comp) == {"Logistic Regression", "Decision Tree", "Random Forest"}
    assert sum(r.is_best for r in comp.values()) >= 1 and all(0 <= r.accuracy <= 1 for r in comp.values())
    imp = M.feature_importance(tm).collect()
    assert len(imp) == 9 and abs(sum(r.importance for r in imp) - 1) < 1e-6
    scored = P.add_risk(M.delay_scores(tm, df))
    assert scored.count() == 400 and scored.where("delay_probability < 0 OR delay_probability > 1").count() == 0
    assert scored.where("is_train").count() == tm.n_fit and tm.n_fit + tm.test.count() == 400
    reports = M.model_reports(tm).groupBy("model").count().collect()
    assert len(reports) == 3 and {r["count"] for r in reports} == {5}
    small = M.train_models(df, max_fit_rows=50, features=[c for c in S.MODEL_FEATURES if c != "HAS_DELAY_CAUSE"],
                           forest_trees=3, forest_depth=3)
    assert 20 <= small.n_fit <= 90 and small.test.count() == tm.test.count()
    assert len(M.feature_importance(small).collect()) == 8


def test_small_fit_does_not_depend_on_many_table_partitions(spark):
    rows = [(i, float(100 + 37 * i % 2500), i % 24, 1 + i % 7, i % 9, i % 2, int(i % 24 >= 18), int(i % 4 == 0), 1 + i % 3, 2 + i % 5, int(i * 7 % 11 > 5))
            for i in range(600)]
    df = spark.createDataFrame(rows, "k int, DISTANCE double, " + ", ".join(f"{c} int" for c in [*S.MODEL_FEATURES[1:], S.MODEL_TARGET]))
    fits = [M.train_models(df.repartition(n), ["k"], sample_fraction=None, max_fit_rows=10_000, names=["Random Forest"], forest_trees=5, forest_depth=6)
            for n in (9, 30)]
    trees = [t.models["Random Forest"].stages[-1] for t in fits]
    assert fits[0].n_fit == fits[1].n_fit > 400
    assert trees[0].toDebugString.split("\n")[1:] == trees[1].toDebugString.split("\n")[1:]


def test_forest_scores_by_batches_as_spark_does(spark):
    rows = [(i, float(100 + 37 * i % 2500), i % 24, 1 + i % 7, i % 9, i % 2, int(i % 24 >= 18), int(i % 4 == 0), 1 + i % 3, 2 + i % 5, int(i * 7 % 11 > 5))
            for i in range(600)]
    df = spark.createDataFrame(rows, "k int, DISTANCE double, " + ", ".join(f"{c} int" for c in [*S.MODEL_FEATURES[1:], S.MODEL_TARGET]))
    tm = M.train_models(df, ["k"], sample_fraction=None, max_fit_rows=None, names=["Random Forest"], forest_trees=12, forest_depth=9)
    odd = df.unionByName(df.limit(3).withColumn("DISTANCE", M.F.lit(float("nan")))).unionByName(df.limit(2).withColumn("DAY_OF_WEEK", M.F.lit(None).cast("int")))
    got = M.delay_scores(tm, odd)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1  # one pass of the batch scorer
    assert got.columns == [*df.columns, "is_train", "prediction", "delay_probability"]
    want = tm.models["Random Forest"].transform(odd).withColumn("p", M.vector_to_array("probability")[1])
    a = {r.k: (r.delay_probability, r.prediction) for r in got.collect()}
    assert a == {r.k: (r.p, r.prediction) for r in want.collect()} and len(a) == got.count() == 600


def test_vote_counter_needs_no_package_on_the_executors():
    import subprocess
    import sys

    import numpy as np
    from pyspark import cloudpickle
    leaf = np.array([False, True, True])
    tree = (np.zeros(3, dtype=np.int64), np.array([2, 1, 1, 1, 2, 2]), leaf, np.array([[0.5, 0.25, 1.0], [0.5, 0.75, 0.0]]))
    sent = cloudpickle.dumps(M.vote_counter([(0, 1.5)], [tree, tree]))
    read = "import sys; sys.path[:] = [p for p in sys.path if p and 'repo' not in p]\nfrom pyspark import cloudpickle\nimport numpy as np\n" \
           "print(cloudpickle.loads(sys.stdin.buffer.read())(np.array([[1.0], [1.5], [2.0]])).tolist(), 'contrail' in sys.modules)"
    out = subprocess.run([sys.executable, "-c", read], input=sent, capture_output=True, cwd="/", check=True)
    assert out.stdout.decode().strip() == "[[0.5, 0.5, 2.0], [1.5, 1.5, 0.0]] False"


def test_a_dealt_fit_does_not_depend_on_where_the_rows_lie(spark):
    """The forest fitted on few rows dealt by their keys is the same from a table in one part or in many, in any order."""
    rows = [(i, float(100 + 37 * i % 2500), i * 7 % 24, i * 5 % 11, int(i % 4 == 0 or i % 13 > 9)) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, DISTANCE double, DEPARTURE_HOUR int, ORIGIN_CONGESTION int, IS_DELAYED_ARRIVAL int")
    features = ["DISTANCE", "DEPARTURE_HOUR", "ORIGIN_CONGESTION"]
    fit = lambda t: M.train_models(t, ["k"], features, sample_fraction=None, max_fit_rows=None, names=["Random Forest"], deal=True,
                                   forest_trees=5, forest_depth=6).models["Random Forest"].stages[-1]
    one = fit(df.coalesce(1))
    for other in (df.repartition(7), df.orderBy("DISTANCE").coalesce(2)):
        assert fit(other).toDebugString.split("\n")[1:] == one.toDebugString.split("\n")[1:]


def test_cells_of_a_forest_number_and_corner_every_side_of_a_threshold():
    import numpy as np
    import pandas as pd
    tests = [(0, 1.5), (0, 3.0), (2, -1.0), (0, 1.5)]
    grid = M.forest_grid(tests, 3)
    number, corners = M.cell_functions(grid)
    x = np.array([[a, b, c] for a in (-np.inf, 1.0, 1.5, 1.6, 3.0, 3.1, np.inf) for b in (0.0, 9.0) for c in (-2.0, -1.0, -0.5)])
    cells = next(number(iter([tuple(pd.Series(c) for c in x.T)]))).to_numpy()
    at = corners(cells)
    assert len(set(cells)) == 6  # the second feature is never tested
    for f, t in tests:
        assert ((x[:, f] <= t) == (at[:, f] <= t)).all()


def test_a_forest_scores_each_cell_of_its_grid_once(spark):
    """Rows that differ only between thresholds share a score, which the trees compute once."""
    base = [(float(100 + 37 * i % 2500), i * 7 % 24, int(i % 4 == 0 or i % 13 > 9)) for i in range(300)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(base)], "k long, DISTANCE double, DEPARTURE_HOUR int, IS_DELAYED_ARRIVAL int")
    tm = M.train_models(df, ["k"], ["DISTANCE", "DEPARTURE_HOUR"], sample_fraction=None, max_fit_rows=None, names=["Random Forest"], forest_trees=4, forest_depth=5)
    seen = spark.sparkContext.accumulator(0)
    plain = M.vote_counter

    def counted(tests, trees, *a):
        votes = plain(tests, trees, *a)

        def count(x):
            seen.add(len(x))
            return votes(x)
        return count
    many = df.crossJoin(spark.range(20).select((M.F.col("id") * 1e-9).alias("d"))).withColumn("DISTANCE", M.F.col("DISTANCE") + M.F.col("d")).drop("d")
    M.vote_counter = counted
    try:
        got = M.delay_scores(tm, many).select("k", "delay_probability").collect()
    finally:
        M.vote_counter = plain
    want = {r.k: r.p for r in tm.models["Random Forest"].transform(df).select("k", M.vector_to_array("probability")[1].alias("p")).collect()}
    assert len(got) == 6000 and all(r.delay_probability == want[r.k] for r in got)
    assert 0 < seen.value <= 600
