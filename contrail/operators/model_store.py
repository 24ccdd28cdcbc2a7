"""Fit once, score later: models stored with what they were fitted on.

A stored version holds the fitted pipelines and one row of facts: features, key columns, seed,
split and sample bounds, and a fingerprint of the model table. Whoever loads the models for a
table gets them only if the table is the one they were fitted on; scoring other rows is a
choice of its own (``check=False``). Versions are committed like any table
(``sources.versions``): a fit that breaks off leaves the old models in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators import forests as FO
from contrail.operators import models as M
from contrail.sources import versions as V


class ChangedInput(ValueError):
    """The table is not the one that the stored models were fitted on."""


def fingerprint(df: DataFrame) -> str:
    """Rows, sum and exclusive or of the rows' digests, and the columns with their types: the same for the same rows in any
    order and partitioning. One aggregation without a shuffle of rows."""
    cols = sorted(df.columns)
    # nulls change no hash, so which cells are null is hashed too
    row = F.xxhash64(*[F.col(f"`{c}`") for c in cols], *[F.col(f"`{c}`").isNull() for c in cols])
    r = df.select(row.alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x")).first()
    types = dict(df.dtypes)
    return json.dumps([r["n"], str(r["s"]), r["x"], [[c, types[c]] for c in cols]])


def save_models(trained: M.TrainedModels, table: DataFrame, path: str, key: Sequence[str] | None = None) -> int:
    """Store fitted models and the facts of their fit; returns the version."""
    spark = table.sparkSession
    base = V.current_version(spark, path)
    names, folders, tables = sorted(trained.models), {}, {}
    for name in names:
        folders[name] = f"models-{uuid.uuid4().hex}"
        model, folder = trained.models[name], f"{path.rstrip('/')}/{folders[name]}"
        if isinstance(model, FO.TreeTable):
            model.trees(spark).write.parquet(folder)
            tables[name] = {k: v for k, v in asdict(model).items() if k != "path"}
        else:
            model.write().save(folder)
    facts = {"folders": folders, "tables": tables, "features": trained.features, "key": list(key or table.columns), "n_fit": trained.n_fit,
             "seed": trained.seed, "fraction": trained.fraction, "test_fraction": trained.test_fraction, "input": fingerprint(table)}
    return V.write_version(spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1), path, base)


def load_models(spark: SparkSession, path: str, table: DataFrame, check: bool = True, version: int | None = None) -> M.TrainedModels:
    """The stored models with the split and sample of ``table``.

    ``check``: ChangedInput unless ``table`` holds the rows that they were fitted on.
    """
    facts = json.loads(V.read_version(spark, path, version).first()["facts"])
    if check and fingerprint(table) != facts["input"]:
        raise ChangedInput(f"{path}: the models were fitted on other rows; fit them again, or load them with check=False")
    at = lambda name: f"{path.rstrip('/')}/{facts['folders'][name]}"
    tables = facts.get("tables", {})  # a version of before there were any has none
    models = {name: FO.TreeTable(**tables[name], path=at(name)) if name in tables else PipelineModel.load(at(name)) for name in facts["folders"]}
    return M.trained(models, table, facts["key"], facts["features"], facts["fraction"], facts["test_fraction"], facts["seed"], facts["n_fit"])


def fit_or_load(table: DataFrame, path: str, key: Sequence[str] | None = None, **fit) -> M.TrainedModels:
    """The stored models of ``table``; fitted and stored where there are none or the table has changed."""
    spark = table.sparkSession
    try:
        return load_models(spark, path, table)
    except (FileNotFoundError, ChangedInput):
        save_models(M.train_models(table, key, **fit), table, path, key)
        return load_models(spark, path, table)
