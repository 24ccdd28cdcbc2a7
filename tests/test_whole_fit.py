"""The queries that read fitted models fit them on every row that is not held out: no sample, no bound."""

import random

import pytest

from contrail import schema as S
from contrail.operators import models as M
from contrail.plans import registry
from contrail.plans import registry_stats as R

NAMES = [
    "fitted_rows",
    "delay_score_keys",
    "delay_scores",
    "feature_importance",
    "model_classification_report",
    "model_comparison",
    "model_comparison_without_cause",
    "model_invariants",
    "model_recommendations",
    "model_risk_distribution",
    "model_top_risk_flights",
    "stored_model_scores",
]


class Fitted(Exception):
    pass


def model_rows(spark, n=600):
    rng = random.Random(4)
    rows = [(i // 4, i % 4, i % 50, i % 9, f"C{i % 5}", f"A{i % 7}", f"A{i % 6}", *[rng.randint(0, 20) for _ in S.MODEL_FEATURES], int(rng.random() < 0.4)) for i in range(n)]
    names = [*R._MODEL_IDS, *S.MODEL_FEATURES, S.MODEL_TARGET]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'string' if c in R._MODEL_IDS[4:] else 'int'}" for c in names))


@pytest.mark.parametrize("name", NAMES)
def test_query_fits_every_row(spark, monkeypatch, name):
    """Before: 30 % of the rows, and 4,000 at most."""
    rows = model_rows(spark).cache()
    fits, fit = [], M.train_models

    def seen(table, *a, **b):
        out = fit(table, *a, **b, names=["Decision Tree"])
        fits.append((out.n_fit, out.fraction))
        raise Fitted  # what the query does with its models is tested elsewhere
    monkeypatch.setattr(M, "train_models", seen)
    monkeypatch.setattr(M, "ORDERED_FIT_TABLE_ROWS", 0)  # the fit reads the written table, which is here the test's
    monkeypatch.setattr(R, "_model_rows", lambda spark, sf: rows)
    monkeypatch.setattr(R, "_TRAINED", {})
    monkeypatch.setattr(R, "_SCORED", {})
    with pytest.raises(Fitted):
        registry.QUERIES[name](spark, "rows of the test")
    assert fits == [(M.with_split(rows, cols=R.KEYS).where("NOT is_test").count(), 1.0)] and fits[0][0] > 400
