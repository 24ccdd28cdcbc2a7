import pandas as pd
import pytest

from contrail.operators import prescribe as P
from contrail.session import CHECKPOINT_CONF, ensure_checkpoint_dir, materialize


def test_existing_checkpoint_dir_is_used_and_stages_land_under_it(spark):
    current = spark.conf.get(CHECKPOINT_CONF)
    assert ensure_checkpoint_dir(spark) == current
    df = spark.range(10)
    out = materialize(df, "unit")
    files = out.inputFiles()
    assert files and all(current.rstrip("/") in f for f in files)
    assert out.count() == 10


@pytest.mark.parametrize("max_hot", [10_000, 1])
def test_historical_score_matches_pandas(spark, max_hot):
    rows = [("A", "B", 5, int(i % 3 == 0)) for i in range(60)] + \
           [("A", "C", 7, int(i % 2 == 0)) for i in range(10)] + [("A", "B", None, 1), ("D", "B", 9, 0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "id int, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, DEPARTURE_HOUR int, "
                               "IS_DELAYED_ARRIVAL int")
    keys = ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "DEPARTURE_HOUR"]
    got = {r.id: r.delay_probability for r in
           P.historical_delay_score(df, keys, max_hot_groups=max_hot, broadcast_max_rows=0).collect()}
    pdf = pd.DataFrame([(i, *r) for i, r in enumerate(rows)], columns=["id", *keys, "IS_DELAYED_ARRIVAL"])
    rate = pdf.dropna(subset=keys).groupby(keys)["IS_DELAYED_ARRIVAL"].mean()
    for _, r in pdf.iterrows():
        want = None if pd.isna(r.DEPARTURE_HOUR) else rate[(r.ORIGIN_AIRPORT, r.DESTINATION_AIRPORT, r.DEPARTURE_HOUR)]
        assert (got[r.id] is None) if want is None else got[r.id] == pytest.approx(want)
    tiers = {r.risk_level for r in P.add_risk(P.historical_delay_score(df, keys)).collect()}
    assert tiers <= {"High Risk", "Medium Risk", "Low Risk"}


def test_top_risk_tie_break(spark):
    df = spark.createDataFrame([(3, 0.9), (1, 0.9), (2, 0.95), (4, 0.1)], "k int, delay_probability double")
    assert [r.k for r in P.top_risk(df, 3, tie_break=["k"]).collect()] == [2, 1, 3]


def test_tables_are_written_by_compiled_stages(spark):
    from contrail import session
    before = spark.conf.get(session.METHOD_LIMIT_CONF)
    spark.conf.set(session.METHOD_LIMIT_CONF, "65535")
    try:
        with session.compiled_stages(spark):
            assert spark.conf.get(session.METHOD_LIMIT_CONF) == "8000"
        assert spark.conf.get(session.METHOD_LIMIT_CONF) == "65535"
    finally:
        spark.conf.set(session.METHOD_LIMIT_CONF, before)
