"""Trees on whole tables: every row is fitted, thresholds and votes are exact, and nothing depends on where the rows lie."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators import forests as FO
from contrail.operators import model_store as MS
from contrail.operators import models as M
from contrail.plans import registry_stats as R

FEATURES = ["a", "b", "c"]


def table(spark, n=6000, seed=5, wide=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(29), rng.randrange(11), rng.randrange(5)
        p = 0.1 + 0.5 * (a > 17) * (b < 6) + 0.3 * (c == 2)
        rows.append((i, rng.gauss(a, 3) if wide else float(a), b, c, int(rng.random() < p)))
    return spark.createDataFrame(rows, f"k long, a double, b int, c int, {S.MODEL_TARGET} int").repartition(3)


def stored(model, spark):
    """Tree number -> its node arrays."""
    out = {}
    for r in model.trees(spark).orderBy("tree", "part").collect():
        out.setdefault(r.tree, []).append([np.frombuffer(x, dtype=d) for x, d in ((r.feature, "u1"), (r.bin, "u1"), (r.left, "i4"), (r.share, "f8"))])
    return {t: [np.concatenate(c) for c in zip(*parts)] for t, parts in out.items()}


def walk(model, trees, values):
    """The trees' shares of class 1 for one row, by a plain walk."""
    bins = [sum(v > t for t in g) for v, g in zip(values, model.grid)]
    out = []
    for t in sorted(trees):
        feature, cut, left, share = trees[t]
        at = 0
        while feature[at] != 255:
            at = left[at] + (bins[feature[at]] > cut[at])
        out.append(share[at])
    return out


def test_every_row_that_is_not_held_out_is_fitted(spark):
    """Before: 30 % of them, and 4,000 at most."""
    for n in (900, 6000):
        df = table(spark, n)
        tm = M.train_models(df, ["k"], FEATURES, forest_trees=2, forest_depth=3)
        rest = M.with_split(df, cols=["k"]).where("NOT is_test")
        assert tm.n_fit == rest.count() > 0.7 * n and tm.fraction == 1.0
        assert {r.k for r in df.where(tm.is_train()).collect()} == {r.k for r in rest.collect()}
    counted = stored(tm.models["Decision Tree"], spark)[0][3][0]  # the root's share of class 1
    assert counted == rest.agg(F.avg(S.MODEL_TARGET)).first()[0]


@pytest.mark.parametrize("name", ["fitted_rows", "delay_score_keys"])
def test_the_sql_of_the_fitted_rows_has_no_sample(name):
    from contrail.plans import registry
    sql = registry.oracle_sql()[name]
    own = sql[sql.rindex("SELECT l_orderkey, l_linenumber"):]
    assert R._FITTED in own and own.count("md5(") == 1 and not re.search(r"least|0\.3|4000", own)


def test_a_tree_is_that_of_spark(spark):
    """No more values than bins: both cut between all values, and the best splits are the same."""
    df = table(spark)
    tm = M.train_models(df, ["k"], FEATURES, names=["Decision Tree"])
    assert isinstance(tm.models["Decision Tree"], FO.TreeTable) and M.TREE_MAX_DEPTH == 10
    train = M.assembler(FEATURES).transform(df.where(tm.is_train()).withColumn(M.LABEL, F.col(S.MODEL_TARGET).cast("double")))
    for depth in (1, 5):
        want = DecisionTreeClassifier(labelCol=M.LABEL, maxDepth=depth).fit(train)
        got = FO.fit_trees(train, M.LABEL, FEATURES, FO.thresholds(train, FEATURES, 32), 1, depth, 3, False, 42)
        p = {r.k: r.p for r in want.transform(M.assembler(FEATURES).transform(df)).select("k", M.vector_to_array("probability")[1].alias("p")).collect()}
        q = {r.k: r.p for r in FO.score_rows(got, df).select("k", "__s.p").collect()}
        assert q == pytest.approx(p, abs=1e-12) and len(q) == 6000
        assert got.importances == pytest.approx(want.featureImportances.toArray().tolist(), abs=1e-9)


def test_a_forest_scores_every_row_by_every_tree(spark):
    df = table(spark, wide=True)
    tm = M.train_models(df, ["k"], FEATURES, names=["Random Forest"], forest_trees=7, forest_depth=9)
    model = tm.models["Random Forest"]
    odd = df.unionByName(df.where("k < 3").withColumn("a", F.lit(float("nan")))).unionByName(df.where("k < 2").withColumn("b", F.lit(None).cast("int")))
    odd = odd.unionByName(df.where("k < 2").withColumns({"k": F.lit(-1), "a": F.when(F.col("k") == 0, F.lit(math.inf)).otherwise(F.lit(-1e9))}))
    scored = M.delay_scores(tm, odd)
    got = scored.collect()
    assert scored.columns == [*df.columns, "is_train", "prediction", "delay_probability"] and len(got) == 6002
    trees = stored(model, spark)
    assert sorted(trees) == [*range(7)] and len({len(t[0]) for t in trees.values()}) > 1
    for r in got[::40] + [r for r in got if r.k == -1]:
        p = sum(walk(model, trees, (r.a, r.b, r.c))) / 7
        assert r.delay_probability == pytest.approx(p, abs=1e-12) and r.prediction == float(r.delay_probability > 0.5)
    assert abs(sum(model.importances) - 1) < 1e-9 and M.feature_importance(tm).count() == 3


def test_a_forest_does_not_depend_on_where_the_rows_lie(spark, monkeypatch):
    df = table(spark, wide=True)

    def fit(t):
        tm = M.train_models(t, ["k"], FEATURES, names=["Random Forest"], forest_trees=6, forest_depth=12)
        return stored(tm.models["Random Forest"], spark), {r.k: (r.delay_probability, r.prediction) for r in M.delay_scores(tm, df).collect()}
    trees, scores = fit(df.coalesce(1))
    monkeypatch.setattr(FO, "BLOCK_CELLS", 50)  # many packed rows, and many stored rows of a tree
    monkeypatch.setattr(FO, "ROW_NODES", 30)
    other, same = fit(df.orderBy("a").repartition(7))
    assert all(np.array_equal(x, y) for t in trees for x, y in zip(trees[t], other[t])) and max(len(t[0]) for t in trees.values()) > 60
    assert scores == same and len(scores) == 6000


def test_leaves_hold_the_counts_of_their_weights():
    """A full tree without bootstrap: a leaf has the share of its cells, and neighbouring leaves are of two classes."""
    rng = np.random.default_rng(1)
    sizes = [6, 5, 4]
    cell = np.sort(rng.choice(120, 90, replace=False))
    n0, n1 = rng.integers(0, 4, 90), rng.integers(0, 4, 90)
    n0[0], n1[0] = 10**12, 1
    grow = FO.tree_grower(sizes, 30, 3, False, 42, row_nodes=7)
    part = grow(cell, n0, n1, 0)
    tree = [np.concatenate([np.frombuffer(b, dtype=d) for b in part[c]]) for c, d in (("feature", "u1"), ("bin", "u1"), ("left", "i4"), ("share", "f8"))]
    bins, votes = FO.tree_votes(sizes)
    got, total = votes(bins(cell), *tree), n0 + n1
    inner = np.flatnonzero(tree[0] != 255)
    assert len(part) > 3 and len(inner) > 10 and sorted([0, *tree[2][inner], *(tree[2][inner] + 1)]) == [*range(len(tree[0]))]
    for share in set(got[total > 0]):
        at = got == share
        assert share == pytest.approx(n1[at].sum() / total[at].sum(), rel=1e-9)
    pairs = [(a, a + 1) for a in tree[2][inner] if tree[0][a] == tree[0][a + 1] == 255]
    assert pairs and all((tree[3][a] > 0.5) != (tree[3][b] > 0.5) for a, b in pairs)
    mixed = n0 != n1  # the class of a cell that no split told apart may be another's
    assert ((got > 0.5) == (n1 > n0))[mixed & (total > 0)].mean() > 0.9


def test_thresholds_come_from_all_rows(spark):
    """The exact quantiles of the rows, a value of its own where it is frequent, and no value that a sample would miss."""
    rng = random.Random(2)
    even = [rng.random() for _ in range(20_000)]
    heavy = [1.0 if rng.random() < 0.9 else float(rng.randrange(2, 60)) for _ in even]
    rare = [0.0] * 19_999 + [7.0]
    df = spark.createDataFrame([*zip(even, heavy, rare, [5] * 20_000)], "e double, h double, r double, one int").repartition(5)
    e, h, r, one = FO.thresholds(df, ["e", "h", "r", "one"], 32)
    ranks = sorted(even)
    assert e == [*[ranks[20_000 * i // 32 - 1] for i in range(1, 32)], math.inf]
    assert h[0] == 1.0 and 20 < len(h) <= 32 and r == [3.5, math.inf] and one == [math.inf]
    # null, NaN and an empty table
    odd = df.withColumn("e", F.when(F.col("h") > 1, F.lit(float("nan"))).otherwise(F.col("e"))).withColumn("r", F.when(F.col("h") > 1, F.col("r")))
    assert FO.thresholds(odd, ["e", "r"], 32) == FO.thresholds(df.limit(0), ["e", "r"], 32) == [[math.inf], [math.inf]]


def test_stored_trees_score_alike(spark, tmp_path):
    df, path = table(spark, wide=True), str(tmp_path / "models")
    trained = M.train_models(df, ["k"], FEATURES, forest_trees=6, forest_depth=8)
    MS.save_models(trained, df, path, ["k"])
    loaded = MS.load_models(spark, path, df)
    score = lambda t: sorted((r.k, r.delay_probability, r.is_train, r.prediction) for r in M.delay_scores(t, df).collect())
    assert score(loaded) == score(trained) and loaded.n_fit == trained.n_fit > 4000
    assert sorted(M.model_comparison(loaded).collect()) == sorted(M.model_comparison(trained).collect())
    assert loaded.models["Decision Tree"].importances == trained.models["Decision Tree"].importances


def test_fits_beyond_the_bound_of_spark_have_few_partitions():
    assert [M.fit_partitions(n) for n in (0, 499, 4000, 4001, 400_001, 20_000_000)] == [1, 1, 8, 8, 9, 400]
