"""Delay prediction (M1-M13) with ``pyspark.ml``.

Training and scoring stay distributed: the model table is a DataFrame, the train/test
split is a predicate on a digest of the row's key (repeatable under retries and
repartitioning, unlike ``rand``), and metrics are aggregations of the prediction column.
Every row that is not held out is fitted, every held-out row is evaluated and every row is
scored. Only model summaries (accuracies, 9 importances) are small enough to be built on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.operators import forests as FO
from contrail.operators.features import PER_DAY, PER_WEEK, add_model_features
from contrail.operators.joins import join_group_values
from contrail.session import scratch_path

LABEL = "label"

# ---------------------------------------------------------------------------
# Sample (M2) and split fractions, seed, model settings
# ---------------------------------------------------------------------------
TRAIN_SAMPLE_FRACTION = 0.3
TEST_FRACTION = 0.2
SEED = 42
LOGISTIC_MAX_ITER = 1000
TREE_MAX_DEPTH = 10
FOREST_TREES = 150
FOREST_MAX_DEPTH = 30  # the deepest that Spark offers; the reference's trees have no limit
#: Up to this many rows, Spark's own learners fit the trees. They hold every node of every tree on the driver, and beyond 10,000
#: rows they take their thresholds from a sample of the rows; larger fits grow the trees by ``operators.forests``, on all rows too.
SPARK_TREE_ROWS = 1_000
#: Rows of such a small fit in a partition, about. Each task of a forest level holds the statistics of every open node of every
#: tree, however few rows it reads, and each iteration of a fit is a job of its own: small partitions cost, they do not help.
#: More partitions than that are dealt anew by the rows' keys; fewer stay as they are.
FIT_PARTITION_ROWS = 500
#: Rows of a larger fit in a partition, about, and its partitions at least.
LARGE_FIT_PARTITION_ROWS, LARGE_FIT_PARTITIONS = 50_000, 8
#: Up to this many rows, a model table is fitted in the order in which its rows lie; beyond, the fit's rows are dealt by their keys.
ORDERED_FIT_TABLE_ROWS = 100_000
#: Rows that one tree scores at a time: their split tests and the tree's nodes fit a core's cache.
SCORE_BLOCK_ROWS = 4_096

_BUCKETS = 1_000_000


def model_table(features: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """M1 (+E16-E18): the 9 model inputs and the 0/1 target, rows with a null dropped.
    The feature stage's per-tail counts are exposed under the model's names."""
    df = add_model_features(features)
    df = df.withColumnsRenamed({PER_DAY: "FLIGHTS_PER_TAIL_NUMBER_DAY", PER_WEEK: "FLIGHTS_PER_TAIL_NUMBER_WEEK"})
    cols = [*id_cols, *S.MODEL_FEATURES, S.MODEL_TARGET]
    out = df.select(*id_cols, *[F.col(c) for c in S.MODEL_FEATURES],
                    F.col(S.MODEL_TARGET).cast("int").alias(S.MODEL_TARGET))
    return out.dropna(subset=cols[len(id_cols):])


def _bucket(seed: int, cols: Sequence[str]) -> Column:
    """0 .. _BUCKETS - 1 from the first 8 hex digits of md5(seed|key...)."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(_BUCKETS)


def hash_sample(df: DataFrame, fraction: float, seed: int = SEED, cols: Sequence[str] | None = None) -> DataFrame:
    """M2: Bernoulli-like sample by a digest of the row's key ``cols`` (all columns without one)."""
    return df.where(_bucket(seed, list(cols or df.columns)) < int(fraction * _BUCKETS))


def with_split(df: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SEED,
               cols: Sequence[str] | None = None) -> DataFrame:
    """M3: add ``is_test`` (about ``test_fraction`` of rows) from a digest of the row's key."""
    b = _bucket(seed + 1, list(cols or df.columns))
    return df.withColumn("is_test", b < int(test_fraction * _BUCKETS))


def assembler(features: Sequence[str] = S.MODEL_FEATURES) -> VectorAssembler:
    """M4: feature vector; rows with an invalid value are skipped."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def classifiers(n_train: int, forest_trees: int = FOREST_TREES, forest_depth: int = FOREST_MAX_DEPTH,
                seed: int = SEED) -> dict[str, object]:
    """M5-M7. Logistic regression matches an L2 penalty of strength 1 on the summed
    loss (regParam = 1/n on Spark's mean loss, no standardisation)."""
    return {
        "Logistic Regression": LogisticRegression(labelCol=LABEL, maxIter=LOGISTIC_MAX_ITER,
                                                  regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                                                  standardization=False),
        "Decision Tree": DecisionTreeClassifier(labelCol=LABEL, maxDepth=TREE_MAX_DEPTH, seed=seed),
        "Random Forest": RandomForestClassifier(labelCol=LABEL, numTrees=forest_trees, maxDepth=forest_depth,
                                                featureSubsetStrategy="sqrt", seed=seed,
                                                # rows remember their nodes: 150 deep trees are not sent with each level's tasks
                                                cacheNodeIds=True),
    }


@dataclass
class ForestArrays:
    """A binary forest in arrays. ``tests``: its distinct (feature, threshold) pairs; per tree: the test of each node times
    ``SCORE_BLOCK_ROWS``, its children (2 * node: right, 2 * node + 1: left; a leaf is its own), and its share of each class."""
    tests: list[tuple[int, float]]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def vote_counter(tests: list[tuple[int, float]], trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], block_rows: int = SCORE_BLOCK_ROWS):
    """Rows (n x features) -> summed class shares (2 x n) of the leaves that they reach, added up in tree order. The function
    goes to the executors whole: they need numpy, not this package."""
    def votes(x: np.ndarray) -> np.ndarray:
        out = np.zeros((2, len(x)))
        left = np.zeros((len(tests), block_rows), dtype=np.int8)  # small, to stay in the cache
        for at in range(0, len(x), block_rows):
            block = x[at:at + block_rows].T
            n = block.shape[1]
            for i, (feature, threshold) in enumerate(tests):
                left[i, :n] = block[feature] <= threshold
            for test, child, is_leaf, shares in trees:
                node, rows = np.zeros(n, dtype=np.int64), np.arange(n)
                while len(rows):
                    here = node[rows]
                    for _ in range(4):  # levels between two looks for rows that have arrived
                        here = child.take(2 * here + left.take(test.take(here) + rows))
                    node[rows] = here
                    rows = rows[~is_leaf.take(here)]
                out[:, at:at + n] += shares[:, node]
        return out
    return votes


def forest_arrays(model: PipelineModel, df: DataFrame) -> ForestArrays | None:
    """The forest of a fitted pipeline of assembler and forest, read from its stored form; None for any other model.

    The nodes are as many as the fit's bounded rows allow, whatever the table to be scored.
    """
    forest = model.stages[-1]
    if len(model.stages) != 2 or not isinstance(forest, RandomForestClassificationModel) or forest.numClasses != 2 or forest.isDefined("thresholds"):
        return None
    if not all(isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType)) for c in model.stages[0].getInputCols()):
        return None
    spark = df.sparkSession
    path = scratch_path(spark, "forest")
    forest.write().overwrite().save(path)
    split = F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"), F.col("nodeData.leftChild").alias("l"), F.col("nodeData.rightChild").alias("r"),
        split["featureIndex"].alias("feature"), F.get(split["leftCategoriesOrThreshold"], 0).alias("threshold"), split["numCategories"].alias("kinds"),
        *[F.get("nodeData.impurityStats", i).alias(f"c{i}") for i in (0, 1)]).orderBy("tree", "id").toPandas()
    is_leaf = (nodes["l"] < 0).to_numpy()
    if (nodes["kinds"][~is_leaf] >= 0).any():  # a split by categories has no threshold
        return None
    tests = sorted(set(zip(nodes["feature"][~is_leaf].astype(int), nodes["threshold"][~is_leaf].astype(float))))
    number = {t: i for i, t in enumerate(tests)}
    trees = []
    for _, tree in nodes.groupby("tree", sort=True):
        place = pd.Series(np.arange(len(tree)), index=tree["id"])
        leaf = (tree["l"] < 0).to_numpy()
        child = np.repeat(np.arange(len(tree)), 2)
        child[0::2][~leaf], child[1::2][~leaf] = place[tree["r"][~leaf]], place[tree["l"][~leaf]]
        test = np.zeros(len(tree), dtype=np.int64)
        test[~leaf] = [number[int(f), float(t)] * SCORE_BLOCK_ROWS for f, t in zip(tree["feature"][~leaf], tree["threshold"][~leaf])]
        counts = tree[["c0", "c1"]].to_numpy(dtype=float).T
        total = counts[0] + counts[1]
        trees.append((test, child, leaf, np.divide(counts, total, out=np.zeros_like(counts), where=total != 0)))
    # trees of one leaf test nothing; a first test is looked up all the same
    return ForestArrays(tests or [(0, 0.0)], trees)


def forest_grid(tests: list[tuple[int, float]], n_features: int) -> list[np.ndarray]:
    """Per feature the distinct thresholds in order, then infinity: all values from one threshold (exclusive) to the next
    (inclusive) take the same way through every tree."""
    return [np.array([*sorted({t for i, t in tests if i == f}), np.inf]) for f in range(n_features)]


def cell_functions(grid: list[np.ndarray]):
    """(rows' features -> number of their cell of the grid, numbers -> the cells' upper corners, which every tree sends where
    it sends the rows). The functions go to the executors whole, like that of ``vote_counter``."""
    def number(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            cell = np.zeros(len(columns[0]), dtype=np.int64)
            for edges, c in zip(grid, columns):
                cell = cell * len(edges) + np.searchsorted(edges, c.to_numpy(dtype=float))
            yield pd.Series(cell)

    def corners(cell: np.ndarray) -> np.ndarray:
        out = np.empty((len(cell), len(grid)))
        for f in reversed(range(len(grid))):
            cell, place = np.divmod(cell, len(grid[f]))
            out[:, f] = grid[f][place]
        return out
    return number, corners


_SCORE = "p double, prediction double"


def _row_probabilities(votes):
    """Batches of columns -> probability of class 1 and prediction, by the votes for the rows' matrix."""
    def probabilities(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            v = votes(np.column_stack([c.to_numpy() for c in (columns if isinstance(columns, tuple) else (columns,))]))
            total = v.sum(axis=0)
            yield pd.DataFrame({"p": np.divide(v[1], total, out=v[1].copy(), where=total != 0), "prediction": (v[1] > v[0]).astype(float)})
    return probabilities


@dataclass
class TrainedModels:
    models: dict[str, PipelineModel | FO.TreeTable]
    test: DataFrame
    fitted: Column
    n_fit: int
    features: list[str] = field(default_factory=lambda: list(S.MODEL_FEATURES))
    fraction: float = 1.0
    test_fraction: float = TEST_FRACTION
    seed: int = SEED
    #: ``forest_arrays`` of the forests scored so far, by model name
    arrays: dict[str, ForestArrays | None] = field(default_factory=dict, repr=False)

    def is_train(self) -> Column:
        """True for rows the models were fitted on (a predicate on the row's key)."""
        return self.fitted


def fit_partitions(rows: int) -> int:
    if rows > SPARK_TREE_ROWS:
        return max(LARGE_FIT_PARTITIONS, math.ceil(rows / LARGE_FIT_PARTITION_ROWS))
    return max(1, math.ceil(rows / FIT_PARTITION_ROWS))


def train_models(table: DataFrame, key: Sequence[str] | None = None, features: Sequence[str] = S.MODEL_FEATURES,
                 sample_fraction: float | None = None, max_fit_rows: int | None = None,
                 test_fraction: float = TEST_FRACTION, seed: int = SEED,
                 names: Sequence[str] | None = None, deal: bool | None = None, **kw) -> TrainedModels:
    """M2-M7: split, fit each classifier on the whole training side in a pipeline with the assembler.

    ``key``: the row's key columns, which decide split and sample (all columns without
    one). ``sample_fraction`` and ``max_fit_rows`` are for callers who ask for a sample: a part of the
    training side, and a smaller one where that would give more rows. The trees of more than
    ``SPARK_TREE_ROWS`` rows are grown by ``operators.forests``. ``test`` holds every held-out row. ``deal``: whether the rows of the fit are dealt anew by their keys (by
    default, where ``table`` has more partitions than the fit needs).
    """
    cols = list(key or table.columns)
    split = with_split(table.withColumn(LABEL, F.col(S.MODEL_TARGET).cast("double")), test_fraction, seed, cols)
    fraction = sample_fraction or 1.0
    if max_fit_rows:
        n_train = split.where(~F.col("is_test")).count()
        fraction = min(fraction, max_fit_rows / max(n_train, 1))
    sampled, _ = _sides(cols, fraction, test_fraction, seed)
    # Iterative learners re-read the training rows many times: keep them on the
    # executors (memory, spilling to disk) until the fits are done; a lost block is
    # recomputed from the persisted feature table.
    order = list(dict.fromkeys([*cols, *features, LABEL]))
    train = split.where(~F.col("is_test") & sampled).select(*order).persist(StorageLevel.MEMORY_AND_DISK)
    n_fit = train.count()
    parts = fit_partitions(n_fit)
    if train.rdd.getNumPartitions() > parts if deal is None else deal:
        few = train.repartition(parts, *cols).sortWithinPartitions(*order).persist(StorageLevel.MEMORY_AND_DISK)
        few.count()
        train.unpersist()
        train = few
    models, grid = {}, None
    for name, est in classifiers(n_fit, seed=seed, **kw).items():
        if names and name not in names:
            continue
        if n_fit > SPARK_TREE_ROWS and isinstance(est, (DecisionTreeClassifier, RandomForestClassifier)) and FO.numeric(train, features):
            grid = grid or FO.thresholds(train, features, est.getMaxBins())
            if FO.cells_number(grid) < 2**63:  # more cells than a long can number: by Spark's learner
                models[name] = _grown(est, train, features, grid)
                continue
        models[name] = Pipeline(stages=[assembler(features), est]).fit(train)
    train.unpersist()
    return trained(models, table, cols, features, fraction, test_fraction, seed, n_fit)


def _grown(est, train: DataFrame, features: Sequence[str], grid: list[list[float]]) -> FO.TreeTable:
    """The trees that the learner's settings ask for: a forest's on bootstrap weights with a few features drawn for each node."""
    if isinstance(est, RandomForestClassifier):
        tries = math.ceil(math.sqrt(len(features)))
        return FO.fit_trees(train, LABEL, features, grid, est.getNumTrees(), est.getMaxDepth(), tries, True, est.getSeed())
    return FO.fit_trees(train, LABEL, features, grid, 1, est.getMaxDepth(), len(features), False, est.getSeed())


def _sides(cols: Sequence[str], fraction: float, test_fraction: float, seed: int) -> tuple[Column, Column]:
    """(in the sample, held out), both by a digest of the row's key."""
    return _bucket(seed, cols) < int(fraction * _BUCKETS), _bucket(seed + 1, cols) < int(test_fraction * _BUCKETS)


def trained(models: dict[str, PipelineModel | FO.TreeTable], table: DataFrame, key: Sequence[str], features: Sequence[str], fraction: float,
            test_fraction: float, seed: int, n_fit: int) -> TrainedModels:
    """Fitted models with the held-out rows of ``table`` and the predicate of the rows they were fitted on."""
    sampled, held_out = _sides(list(key), fraction, test_fraction, seed)
    split = with_split(table.withColumn(LABEL, F.col(S.MODEL_TARGET).cast("double")), test_fraction, seed, list(key))
    return TrainedModels(models, split.where(F.col("is_test")).drop("is_test"), sampled & ~held_out, n_fit, list(features), fraction, test_fraction, seed)


def accuracy(label: str = LABEL, prediction: str = "prediction") -> Column:
    """M8 as an aggregate expression."""
    return F.avg((F.col(label) == F.col(prediction)).cast("double"))


def score(trained: TrainedModels, rows: DataFrame, name: str, probability: str | None = None) -> DataFrame:
    """``rows`` with the model's ``prediction`` (and, named by ``probability``, that of class 1); rows with an invalid
    feature are skipped.

    A forest scores Arrow batches tree by tree, with the sums of ``model.transform`` in the same order: that one walks all
    trees for each row, and most of its steps wait for memory. Rows between the same thresholds of every feature (one cell
    of the forest's grid) have one score: each cell that holds rows is scored once and joined back. Trees stored as a table
    score cells in the same way, but the cells are brought to the trees.
    """
    model = trained.models[name]
    if isinstance(model, FO.TreeTable):
        scored = FO.score_rows(model, rows).withColumn("prediction", F.col("__s.prediction"))
        return (scored.withColumn(probability, F.col("__s.p")) if probability else scored).drop("__s")
    if name not in trained.arrays:
        trained.arrays[name] = forest_arrays(model, rows)
    forest = trained.arrays[name]
    if forest is None:
        scored = model.transform(rows)
        if probability:
            scored = scored.withColumn(probability, vector_to_array(F.col("probability"))[1])
        return scored.drop("features", "rawPrediction", *(["probability"] if probability != "probability" else []))

    votes = vote_counter(forest.tests, forest.trees)
    inputs = [F.col(c).cast("double") for c in model.stages[0].getInputCols()]
    valid = reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in inputs])
    grid = forest_grid(forest.tests, len(inputs))
    if math.prod(len(g) for g in grid) >= 2**63:  # more cells than a long can number: each row by itself
        scored = rows.where(valid).withColumn("__s", F.pandas_udf(_row_probabilities(votes), _SCORE)(*inputs))
    else:
        number, corners = cell_functions(grid)
        celled = rows.where(valid).withColumn("__cell", F.pandas_udf(number, "long")(*inputs))
        cells = celled.groupBy("__cell").agg(F.count(F.lit(1)).alias("__n"))
        # a cell is few bytes and much work: it is dealt by count, not by size
        cells = cells.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, "__cell")
        cells = cells.withColumn("__s", F.pandas_udf(_row_probabilities(lambda x: votes(corners(x[:, 0]))), _SCORE)(F.col("__cell")))
        scored = join_group_values(celled, ["__cell"], cells, "__n", ["__s"]).drop("__cell")
    scored = scored.withColumn("prediction", F.col("__s.prediction"))
    return (scored.withColumn(probability, F.col("__s.p")) if probability else scored).drop("__s")


def model_comparison(trained: TrainedModels) -> DataFrame:
    """M10 + M12: accuracy on all held-out rows per model (scored once each) and the best one."""
    parts = [score(trained, trained.test, name).agg(accuracy().alias("accuracy")).withColumn("model", F.lit(name))
             for name in trained.models]
    rows = reduce(DataFrame.unionByName, parts).agg(F.collect_list(F.struct("accuracy", "model")).alias("rows"))
    best = rows.withColumn("best", F.array_max("rows")["model"]).select(F.explode("rows").alias("r"), "best")
    return best.select("r.model", "r.accuracy", (F.col("r.model") == F.col("best")).alias("is_best"))


def model_reports(trained: TrainedModels) -> DataFrame:
    """M9: the classification report of every model on all held-out rows."""
    return reduce(DataFrame.unionByName, [
        classification_report(score(trained, trained.test, name), LABEL, "prediction").withColumn("model", F.lit(name))
        for name in trained.models])


def feature_importance(trained: TrainedModels, name: str = "Random Forest") -> DataFrame:
    """The forest's feature importances, largest first."""
    model = trained.models[name]
    weights = model.importances if isinstance(model, FO.TreeTable) else model.stages[-1].featureImportances.toArray()
    rows = list(zip(trained.features, [float(x) for x in weights]))
    spark = trained.test.sparkSession
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def delay_scores(trained: TrainedModels, rows: DataFrame, name: str = "Random Forest") -> DataFrame:
    """M13 (+Q16): class-1 probability for every row, flagged when the row was used
    for training."""
    flagged = rows.withColumn("is_train", trained.is_train())
    return score(trained, flagged, name, "delay_probability")


def classification_report(df: DataFrame, label: str, prediction: str, digits: int = 6) -> DataFrame:
    """M9: precision, recall, F1 and support per class, accuracy, macro and
    weighted averages (0 on a zero division) -- from one confusion-count
    aggregation over the whole frame."""
    lab = F.col(label).cast("int")
    pred = F.col(prediction).cast("int")
    conf = df.agg(F.count(F.lit(1)).alias("n"),
                  *[F.count_if((lab == c) & (pred == c)).alias(f"tp{c}") for c in (0, 1)],
                  *[F.count_if(pred == c).alias(f"pp{c}") for c in (0, 1)],
                  *[F.count_if(lab == c).alias(f"sup{c}") for c in (0, 1)])

    def safe(num: Column, den: Column) -> Column:
        return F.when(den == 0, F.lit(0.0)).otherwise(num / den)

    p = {c: safe(F.col(f"tp{c}"), F.col(f"pp{c}")) for c in (0, 1)}
    r = {c: safe(F.col(f"tp{c}"), F.col(f"sup{c}")) for c in (0, 1)}
    f1 = {c: safe(2 * p[c] * r[c], p[c] + r[c]) for c in (0, 1)}
    acc = (F.col("tp0") + F.col("tp1")) / F.col("n")
    n = F.col("n")

    def row(name, pr, rc, f, sup):
        return F.struct(F.lit(name).alias("class"), F.round(pr, digits).alias("precision"),
                        F.round(rc, digits).alias("recall"), F.round(f, digits).alias("f1_score"),
                        sup.cast("long").alias("support"))
    rows = [row(str(c), p[c], r[c], f1[c], F.col(f"sup{c}")) for c in (0, 1)]
    rows.append(row("accuracy", acc, acc, acc, n))
    rows.append(row("macro avg", (p[0] + p[1]) / 2, (r[0] + r[1]) / 2, (f1[0] + f1[1]) / 2, n))
    w = {c: F.col(f"sup{c}") / n for c in (0, 1)}
    rows.append(row("weighted avg", p[0] * w[0] + p[1] * w[1], r[0] * w[0] + r[1] * w[1],
                    f1[0] * w[0] + f1[1] * w[1], n))
    return conf.select(F.inline(F.array(*rows)))
