"""Registered statistics, model and prescription queries (L*, G7-G9, G14, M*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators import model_store as MS
from contrail.operators import models as M
from contrail.operators.features import CONGESTION, add_model_features
from contrail.operators import prescribe as P
from contrail.operators import stats as ST
from contrail.plans import oracle as O
from contrail.plans.pipeline import fixture_features, fixture_frames
from contrail.plans.registry import KEYS, register
from contrail.session import materialize, scratch_path, session_key

_K = ", ".join(KEYS)
SAMPLE_N = ST.SAMPLE_PER_GROUP
# A second sample that bites at the test scales.
SMALL_SAMPLE_N = 500
SAMPLE_SEED = 42
# Groups of the deterministic score used to exercise the prescriptive layer.
SCORE_KEYS = ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "DEPARTURE_HOUR"]

_BASE = """base AS (SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey,
  COALESCE(a.AIRLINE, f.AIRLINE) AS AIRLINE_NAME, CAST(f.IS_DELAYED_ARRIVAL AS INTEGER) AS IS_DELAYED_ARRIVAL,
  f.ARRIVAL_DELAY, f.ORIGIN_CONGESTION
  FROM feat f LEFT JOIN airlines a ON f.AIRLINE = a.IATA_CODE
  WHERE COALESCE(a.AIRLINE, f.AIRLINE) IS NOT NULL AND f.IS_DELAYED_ARRIVAL IS NOT NULL
    AND f.ARRIVAL_DELAY IS NOT NULL AND f.ORIGIN_CONGESTION IS NOT NULL)"""


def _base(spark, sf):
    fr = fixture_frames(spark, sf)
    return ST.stats_base(fixture_features(spark, sf, reads=[CONGESTION]), fr.airlines, KEYS)


# --- G7-G9, G14, H4/L5 ----------------------------------------------------

def _sample_sql(n: int) -> str:
    return (f"sample AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY AIRLINE_NAME "
            f"ORDER BY md5(concat_ws('|', '{SAMPLE_SEED}', {_K}))) AS rn FROM base) s WHERE rn <= {n})")


@register("stratified_sample", O.with_stages("SELECT * FROM sample", f"{_BASE},\n{_sample_sql(SAMPLE_N)}"))
def q_stratified_sample(spark, sf):
    return ST.stratified_sample(_base(spark, sf), ST.GROUP, SAMPLE_N, SAMPLE_SEED, KEYS)


@register("stratified_sample_small", O.with_stages("SELECT * FROM sample", f"{_BASE},\n{_sample_sql(SMALL_SAMPLE_N)}"))
def q_stratified_sample_small(spark, sf):
    return ST.stratified_sample(_base(spark, sf), ST.GROUP, SMALL_SAMPLE_N, SAMPLE_SEED, KEYS)


@register("sample_sizes", O.with_stages(
    "SELECT AIRLINE_NAME, COUNT(*) AS n FROM sample GROUP BY 1 ORDER BY n DESC, AIRLINE_NAME",
    f"{_BASE},\n{_sample_sql(SAMPLE_N)}"))
def q_sample_sizes(spark, sf):
    return ST.group_sizes(ST.stratified_sample(_base(spark, sf), ST.GROUP, SAMPLE_N, SAMPLE_SEED, KEYS))


@register("delay_rate_by_airline", O.with_stages(
    "SELECT AIRLINE_NAME, ROUND(AVG(CAST(IS_DELAYED_ARRIVAL AS DOUBLE)), 6) AS delay_rate FROM base GROUP BY 1",
    _BASE))
def q_delay_rate_by_airline(spark, sf):
    return ST.mean_by_group(_base(spark, sf), ST.FLAG, alias="delay_rate")


@register("mean_delay_by_airline", O.with_stages(
    "SELECT AIRLINE_NAME, ROUND(AVG(CAST(ARRIVAL_DELAY AS DOUBLE)), 6) AS mean_arrival_delay FROM base GROUP BY 1",
    _BASE))
def q_mean_delay_by_airline(spark, sf):
    return ST.mean_by_group(_base(spark, sf), ST.MINUTES, alias="mean_arrival_delay")


@register("contingency", O.with_stages(
    "SELECT AIRLINE_NAME, COUNT_IF(IS_DELAYED_ARRIVAL = 0) AS not_delayed, COUNT_IF(IS_DELAYED_ARRIVAL = 1) AS delayed "
    "FROM base GROUP BY 1", _BASE))
def q_contingency(spark, sf):
    return ST.contingency(_base(spark, sf))


# --- L1-L4, L6 ------------------------------------------------------------

_CHI = f"""{_BASE},
cells AS (SELECT AIRLINE_NAME, IS_DELAYED_ARRIVAL, COUNT(*) AS o FROM base GROUP BY 1, 2),
rt AS (SELECT AIRLINE_NAME, SUM(o) AS r FROM cells GROUP BY 1),
ct AS (SELECT IS_DELAYED_ARRIVAL, SUM(o) AS c FROM cells GROUP BY 1),
tt AS (SELECT SUM(o) AS n, (SELECT COUNT(*) FROM rt) AS nr, (SELECT COUNT(*) FROM ct) AS nc FROM cells),
grid AS (SELECT rt.AIRLINE_NAME, ct.IS_DELAYED_ARRIVAL, CAST(rt.r AS DOUBLE) * ct.c / tt.n AS e,
  CAST(COALESCE(cells.o, 0) AS DOUBLE) AS o, (tt.nr - 1) * (tt.nc - 1) AS dof
  FROM rt CROSS JOIN ct CROSS JOIN tt
  LEFT JOIN cells ON cells.AIRLINE_NAME = rt.AIRLINE_NAME AND cells.IS_DELAYED_ARRIVAL = ct.IS_DELAYED_ARRIVAL),
adj AS (SELECT e, dof, CASE WHEN dof = 1 THEN o + SIGN(e - o) * LEAST(0.5, ABS(e - o)) ELSE o END AS o FROM grid)"""


@register("chi_square", O.with_stages(
    "SELECT ROUND(SUM((o - e) * (o - e) / e), 6) AS statistic, CAST(MAX(dof) AS BIGINT) AS dof, "
    "CAST((SELECT n FROM tt) AS BIGINT) AS n_rows, CAST((SELECT nr FROM tt) AS BIGINT) AS n_groups FROM adj", _CHI))
def q_chi_square(spark, sf):
    return ST.chi_square(_base(spark, sf))


@register("chi_square_expected", O.with_stages(
    "SELECT AIRLINE_NAME, IS_DELAYED_ARRIVAL, CAST(o AS BIGINT) AS observed, ROUND(e, 6) AS expected FROM grid", _CHI))
def q_chi_square_expected(spark, sf):
    return ST.expected_counts(_base(spark, sf))


# With an even number of degrees of freedom the tail is a finite sum that SQL can evaluate.
@register("chi_square_test", O.with_stages(
    "SELECT ROUND(x, 6) AS statistic, CAST(dof AS BIGINT) AS dof, n_rows, n_groups, ROUND(p, 9) AS p_value, p < 0.05 AS reject_h0 "
    "FROM (SELECT x, dof, n_rows, n_groups, CASE WHEN dof % 2 = 0 THEN list_sum([exp(i * ln(x / 2) - x / 2 - "
    "lgamma(CAST(i + 1 AS DOUBLE))) for i in range(0, CAST(dof / 2 AS BIGINT))]) END AS p FROM (SELECT SUM((o - e) * (o - e) / e) AS x, MAX(dof) AS dof, "
    "CAST((SELECT n FROM tt) AS BIGINT) AS n_rows, CAST((SELECT nr FROM tt) AS BIGINT) AS n_groups FROM adj) s) t", _CHI))
def q_chi_square_test(spark, sf):
    return ST.chi_square_test(_base(spark, sf))


_ANOVA = f"""{_BASE},
g AS (SELECT AIRLINE_NAME, COUNT(ARRIVAL_DELAY) AS n, AVG(CAST(ARRIVAL_DELAY AS DOUBLE)) AS m,
  VAR_SAMP(CAST(ARRIVAL_DELAY AS DOUBLE)) AS s2 FROM base GROUP BY 1),
t AS (SELECT SUM(n) AS nn, COUNT(*) AS k, SUM(n * m * m) AS snm2, SUM(n * m) AS snm,
  SUM((n - 1) * COALESCE(s2, 0)) AS ssw FROM g WHERE n > 0)"""


@register("anova", O.with_stages(
    "SELECT ROUND(((snm2 - snm * snm / nn) / (k - 1)) / (ssw / (nn - k)), 6) AS f_statistic, "
    "CAST(k - 1 AS BIGINT) AS df_between, CAST(nn - k AS BIGINT) AS df_within, k AS n_groups, "
    "CAST(nn AS BIGINT) AS n_rows FROM t", _ANOVA))
def q_anova(spark, sf):
    return ST.anova(_base(spark, sf))


@register("anova_test")
def q_anova_test(spark, sf):
    return ST.anova_test(_base(spark, sf))


@register("correlation", O.with_stages(
    "SELECT ROUND(CORR(CAST(ORIGIN_CONGESTION AS DOUBLE), CAST(ARRIVAL_DELAY AS DOUBLE)), 6) AS pearson_r, "
    "COUNT(*) AS n_rows FROM base", _BASE))
def q_correlation(spark, sf):
    return ST.correlation(_base(spark, sf))


@register("delay_distribution", O.with_stages(
    "SELECT q.AIRLINE_NAME, q.n, ROUND(q.mean, 4) AS mean, ROUND(q.q1, 4) AS q1, ROUND(q.median, 4) AS median, "
    "ROUND(q.q3, 4) AS q3, ROUND(MIN(CASE WHEN b.v >= q.q1 - 1.5 * (q.q3 - q.q1) THEN b.v END), 4) AS whisker_low, "
    "ROUND(MAX(CASE WHEN b.v <= q.q3 + 1.5 * (q.q3 - q.q1) THEN b.v END), 4) AS whisker_high "
    "FROM q JOIN (SELECT AIRLINE_NAME, CAST(ARRIVAL_DELAY AS DOUBLE) AS v FROM base) b USING (AIRLINE_NAME) "
    "GROUP BY q.AIRLINE_NAME, q.n, q.mean, q.q1, q.median, q.q3",
    f"""{_BASE},
q AS (SELECT AIRLINE_NAME, COUNT(*) AS n, AVG(CAST(ARRIVAL_DELAY AS DOUBLE)) AS mean,
  quantile_cont(CAST(ARRIVAL_DELAY AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(ARRIVAL_DELAY AS DOUBLE), 0.5) AS median,
  quantile_cont(CAST(ARRIVAL_DELAY AS DOUBLE), 0.75) AS q3 FROM base GROUP BY 1)"""))
def q_delay_distribution(spark, sf):
    return ST.box_stats(_base(spark, sf))


# With an even first degree of freedom the tail of F is a finite sum:
# p = x^(w/2) * sum over j < b/2 of (w/2)(w/2 + 1)...(w/2 + j - 1) / j! * (1 - x)^j,  x = w / (w + b F)
_WEEKDAY = """wd AS (SELECT DAY_OF_WEEK, CAST(ARRIVAL_DELAY AS DOUBLE) AS v FROM feat WHERE ARRIVAL_DELAY IS NOT NULL AND DAY_OF_WEEK BETWEEN 1 AND 7),
g AS (SELECT DAY_OF_WEEK, COUNT(*) AS n, AVG(v) AS m, VAR_SAMP(v) AS s2 FROM wd GROUP BY 1),
t AS (SELECT SUM(n) AS nn, COUNT(*) AS k, SUM(n * m * m) AS snm2, SUM(n * m) AS snm, SUM((n - 1) * COALESCE(s2, 0)) AS ssw FROM g),
a AS (SELECT (snm2 - snm * snm / nn) / (k - 1) / (ssw / (nn - k)) AS f, CAST(k - 1 AS BIGINT) AS b, CAST(nn - k AS BIGINT) AS w, k, nn FROM t),
x AS (SELECT *, w / (w + b * f) AS x FROM a)"""


@register("anova_test_by_weekday", O.with_stages(
    "SELECT ROUND(f, 4) AS f_statistic, b AS df_between, w AS df_within, k AS n_groups, CAST(nn AS BIGINT) AS n_rows, "
    "ROUND(exp(w / 2.0 * ln(x)) * list_sum([exp(lgamma(w / 2.0 + j) - lgamma(w / 2.0) - lgamma(j + 1)) * pow(1 - x, j) FOR j IN range(b // 2)]), 6) AS p_value "
    "FROM x", _WEEKDAY))
def q_anova_test_by_weekday(spark, sf):
    """L2 + L6: arrival delay by day of the week; seven groups, so that SQL can sum the p-value."""
    rows = fixture_features(spark, sf, reads=[]).where(F.col("ARRIVAL_DELAY").isNotNull() & F.col("DAY_OF_WEEK").between(1, 7))
    return ST.anova_test(rows, "ARRIVAL_DELAY", "DAY_OF_WEEK", digits=4).withColumn("p_value", F.round("p_value", 6)).drop("reject_h0")


# --- M1-M13 ---------------------------------------------------------------

_MT_COLS = ("DISTANCE, DEPARTURE_HOUR, DAY_OF_WEEK, ORIGIN_CONGESTION, IS_LONG_DISTANCE, IS_EVENING, "
            "HAS_DELAY_CAUSE, FLIGHTS_PER_TAIL_NUMBER_DAY, FLIGHTS_PER_TAIL_NUMBER_WEEK")
_MF = """mf AS (SELECT *,
  CASE WHEN DISTANCE > 1500 THEN 1 ELSE 0 END AS IS_LONG_DISTANCE,
  CASE WHEN DEPARTURE_HOUR >= 18 THEN 1 ELSE 0 END AS IS_EVENING,
  CASE WHEN AIRLINE_DELAY > 0 OR WEATHER_DELAY > 0 OR AIR_SYSTEM_DELAY > 0 OR LATE_AIRCRAFT_DELAY > 0 THEN 1 ELSE 0
  END AS HAS_DELAY_CAUSE,
  FLIGHTS_PER_TAIL_NUMBER_PER_DAY AS FLIGHTS_PER_TAIL_NUMBER_DAY,
  FLIGHTS_PER_TAIL_NUMBER_PER_WEEK AS FLIGHTS_PER_TAIL_NUMBER_WEEK FROM feat)"""
_MT = (f"{_MF},\nmt AS (SELECT {_K}, {_MT_COLS}, CAST(IS_DELAYED_ARRIVAL AS INTEGER) AS IS_DELAYED_ARRIVAL "
       f"FROM mf WHERE " + " AND ".join(f"{c.strip()} IS NOT NULL" for c in _MT_COLS.split(","))
       + " AND IS_DELAYED_ARRIVAL IS NOT NULL)")


_MODEL_IDS = [*KEYS, "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]
_TABLES: dict = {}


def _model_rows(spark, sf):
    """The model table with the flights' codes, written once per session: tests and scores read it many times, and its
    counts come from joins of the whole feature table."""
    key = (session_key(spark), sf)
    if key not in _TABLES:
        _TABLES[key] = materialize(M.model_table(fixture_features(spark, sf), _MODEL_IDS), "model-table", keep=True)
    return _TABLES[key]


def _model_table(spark, sf):
    return _model_rows(spark, sf).select(*KEYS, *S.MODEL_FEATURES, S.MODEL_TARGET)


@register("model_features", O.with_stages(
    f"SELECT {_K}, IS_LONG_DISTANCE, IS_EVENING, HAS_DELAY_CAUSE FROM mf", _MF))
def q_model_features(spark, sf):
    return add_model_features(fixture_features(spark, sf, reads=[])).select(
        *KEYS, "IS_LONG_DISTANCE", "IS_EVENING", "HAS_DELAY_CAUSE")


@register("model_table", O.with_stages("SELECT * FROM mt", _MT))
def q_model_table(spark, sf):
    return _model_table(spark, sf)


@register("model_row_count", O.with_stages("SELECT COUNT(*) AS n_rows FROM mt", _MT))
def q_model_row_count(spark, sf):
    return _model_table(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))


@register("classification_report", O.with_stages(
    "SELECT * FROM (SELECT '0' AS class, ROUND(p0, 6) AS precision, ROUND(r0, 6) AS recall, ROUND(f0, 6) AS f1_score, "
    "sup0 AS support FROM m UNION ALL SELECT '1', ROUND(p1, 6), ROUND(r1, 6), ROUND(f1, 6), sup1 FROM m UNION ALL "
    "SELECT 'accuracy', ROUND(acc, 6), ROUND(acc, 6), ROUND(acc, 6), n FROM m UNION ALL "
    "SELECT 'macro avg', ROUND((p0 + p1) / 2, 6), ROUND((r0 + r1) / 2, 6), ROUND((f0 + f1) / 2, 6), n FROM m UNION ALL "
    "SELECT 'weighted avg', ROUND(p0 * sup0 / n + p1 * sup1 / n, 6), ROUND(r0 * sup0 / n + r1 * sup1 / n, 6), "
    "ROUND(f0 * sup0 / n + f1 * sup1 / n, 6), n FROM m) x",
    f"""{_MT},
cnt AS (SELECT COUNT(*) AS n, COUNT_IF(IS_DELAYED_ARRIVAL = 0 AND HAS_DELAY_CAUSE = 0) AS tp0,
  COUNT_IF(IS_DELAYED_ARRIVAL = 1 AND HAS_DELAY_CAUSE = 1) AS tp1, COUNT_IF(HAS_DELAY_CAUSE = 0) AS pp0,
  COUNT_IF(HAS_DELAY_CAUSE = 1) AS pp1, COUNT_IF(IS_DELAYED_ARRIVAL = 0) AS sup0,
  COUNT_IF(IS_DELAYED_ARRIVAL = 1) AS sup1 FROM mt),
pr AS (SELECT *, CASE WHEN pp0 = 0 THEN 0.0 ELSE tp0 / pp0 END AS p0, CASE WHEN pp1 = 0 THEN 0.0 ELSE tp1 / pp1 END AS p1,
  CASE WHEN sup0 = 0 THEN 0.0 ELSE tp0 / sup0 END AS r0, CASE WHEN sup1 = 0 THEN 0.0 ELSE tp1 / sup1 END AS r1,
  CAST(tp0 + tp1 AS DOUBLE) / n AS acc FROM cnt),
m AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
  CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1 FROM pr)"""))
def q_classification_report(spark, sf):
    return M.classification_report(_model_table(spark, sf), "IS_DELAYED_ARRIVAL", "HAS_DELAY_CAUSE")


_TRAINED: dict = {}
_WITHOUT_CAUSE = [c for c in S.MODEL_FEATURES if c != "HAS_DELAY_CAUSE"]


def _trained(spark, sf, features=tuple(S.MODEL_FEATURES)) -> M.TrainedModels:
    key = (session_key(spark), sf, tuple(features))
    if key not in _TRAINED:
        written = _model_table(spark, sf)
        if written.count() > M.ORDERED_FIT_TABLE_ROWS:
            # dealt anew, the fit's rows are the same from any table: the written one spares the joins, which are read twice
            t = M.train_models(written, KEYS, list(features), deal=True)
        else:  # a small table's rows are fitted in the order in which they lie
            t = M.train_models(M.model_table(fixture_features(spark, sf, persist=True), KEYS), KEYS, list(features))
        # tests read the written table
        _TRAINED[key] = M.trained(t.models, written, KEYS, t.features, t.fraction, t.test_fraction, t.seed, t.n_fit)
    return _TRAINED[key]


def _bucket_sql(seed: int) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {_K})), 1, 8) AS BIGINT) % 1000000"


@register("train_test_split", O.with_stages(
    f"SELECT {_bucket_sql(M.SEED + 1)} < {int(M.TEST_FRACTION * 1_000_000)} AS is_test, COUNT(*) AS n FROM mt GROUP BY 1", _MT))
def q_train_test_split(spark, sf):
    split = M.with_split(_model_table(spark, sf), M.TEST_FRACTION, M.SEED, KEYS)
    return split.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


@register("train_sample", O.with_stages(
    f"SELECT {_K} FROM mt WHERE {_bucket_sql(M.SEED)} < {int(M.TRAIN_SAMPLE_FRACTION * 1_000_000)}", _MT))
def q_train_sample(spark, sf):
    return M.hash_sample(_model_table(spark, sf), M.TRAIN_SAMPLE_FRACTION, M.SEED, KEYS).select(*KEYS)


@register("model_comparison")
def q_model_comparison(spark, sf):
    return M.model_comparison(_trained(spark, sf))


@register("model_comparison_without_cause")
def q_model_comparison_without_cause(spark, sf):
    """HAS_DELAY_CAUSE follows from the outcome; the same models without it."""
    return M.model_comparison(_trained(spark, sf, _WITHOUT_CAUSE))


@register("feature_importance")
def q_feature_importance(spark, sf):
    return M.feature_importance(_trained(spark, sf))


@register("model_classification_report")
def q_model_classification_report(spark, sf):
    return M.model_reports(_trained(spark, sf))


_SCORED: dict = {}


def _forest_scores(spark, sf):
    """Every row scored by the forest, written once per session: four reports read it."""
    key = (session_key(spark), sf)
    if key not in _SCORED:
        _SCORED[key] = materialize(M.delay_scores(_trained(spark, sf), _model_rows(spark, sf)), "delay-scores", keep=True)
    return _SCORED[key]


@register("delay_scores")
def q_delay_scores(spark, sf):
    return _forest_scores(spark, sf).select(*KEYS, "delay_probability", "is_train", "prediction")


_FITTED = f"{_bucket_sql(M.SEED + 1)} >= {int(M.TEST_FRACTION * 1_000_000)}"


@register("fitted_rows", O.with_stages(f"SELECT {_K} FROM mt WHERE {_FITTED}", _MT))
def q_fitted_rows(spark, sf):
    """M2: the rows that the models were fitted on: all that are not held out."""
    return _model_table(spark, sf).where(_trained(spark, sf).is_train()).select(*KEYS)


@register("delay_score_keys", O.with_stages(f"SELECT {_K}, {_FITTED} AS is_train, TRUE AS in_range FROM mt", _MT))
def q_delay_score_keys(spark, sf):
    """Every row of the model table scored once, by a probability, flagged as fitted by the digest predicate."""
    return _forest_scores(spark, sf).select(*KEYS, "is_train", F.col("delay_probability").between(0.0, 1.0).alias("in_range"))


@register("model_invariants", O.with_stages(
    f"SELECT COUNT(*) AS scored, COUNT_IF({_bucket_sql(M.SEED + 1)} < {int(M.TEST_FRACTION * 1_000_000)}) AS held_out, "
    "COUNT(*) AS in_tiers, TRUE AS tiers_follow_scores, 3::BIGINT AS models, 1::BIGINT AS best, 9::BIGINT AS importances, "
    "1.0::DOUBLE AS importance_sum FROM mt", _MT))
def q_model_invariants(spark, sf):
    """What holds whatever the forest says: rows scored, rows held out, tiers that follow the scores, one best of
    three models, nine importances that add up to one."""
    scores, t = P.add_risk(_forest_scores(spark, sf)), _trained(spark, sf)
    p, tier = F.col(P.PROB), F.col("risk_level")
    follows = (tier == F.when(p > 0.75, "High Risk").when(p > 0.5, "Medium Risk").otherwise("Low Risk"))
    rows = scores.agg(F.count(F.lit(1)).alias("scored"), F.count_if(tier.isin("High Risk", "Medium Risk", "Low Risk")).alias("in_tiers"),
                      F.coalesce(F.bool_and(follows), F.lit(True)).alias("tiers_follow_scores"))
    held_out = t.test.agg(F.count(F.lit(1)).alias("held_out"))
    compared = M.model_comparison(t).agg(F.count(F.lit(1)).alias("models"), F.count_if("is_best").alias("best"))
    weights = M.feature_importance(t).agg(F.count(F.lit(1)).alias("importances"), F.round(F.sum("importance"), 6).alias("importance_sum"))
    out = rows
    for one_row in (held_out, compared, weights):
        out = out.join(F.broadcast(one_row))
    return out


@register("stored_model_scores", O.with_stages(f"SELECT {_K}, TRUE AS same_score, TRUE AS same_flag FROM mt", _MT))
def q_stored_model_scores(spark, sf):
    """Models stored, loaded again for the table they were fitted on, and every row scored by the loaded forest."""
    table = _model_table(spark, sf)
    path = scratch_path(spark, "model-store")
    MS.save_models(_trained(spark, sf), table, path, KEYS)
    # the loaded forest scores the rows that hold the first scores: no row has to find its own by keys that may repeat
    first = _forest_scores(spark, sf).select(*table.columns, F.col("delay_probability").alias("p"), F.col("is_train").alias("t"))
    again = M.delay_scores(MS.load_models(spark, path, table), first)
    return again.select(*KEYS, (F.col("p") == F.col("delay_probability")).alias("same_score"), (F.col("t") == F.col("is_train")).alias("same_flag"))


@register("model_risk_distribution")
def q_model_risk_distribution(spark, sf):
    return P.risk_distribution(P.add_risk(_forest_scores(spark, sf)))


def _forest_recommendations(spark, sf):
    return P.recommendation_table(_forest_scores(spark, sf), id_cols=KEYS)


@register("model_recommendations")
def q_model_recommendations(spark, sf):
    return _forest_recommendations(spark, sf)


@register("model_top_risk_flights")
def q_model_top_risk_flights(spark, sf):
    return P.top_risk(_forest_recommendations(spark, sf), 20, tie_break=KEYS)


# --- M14-M19 on a deterministic score -------------------------------------

_SC = f"""sc AS (SELECT f.*, r.delay_probability FROM feat f LEFT JOIN (
  SELECT ORIGIN_AIRPORT, DESTINATION_AIRPORT, DEPARTURE_HOUR,
    AVG(CAST(CAST(IS_DELAYED_ARRIVAL AS INTEGER) AS DOUBLE)) AS delay_probability FROM feat
  WHERE ORIGIN_AIRPORT IS NOT NULL AND DESTINATION_AIRPORT IS NOT NULL AND DEPARTURE_HOUR IS NOT NULL
  GROUP BY 1, 2, 3) r
  ON f.ORIGIN_AIRPORT = r.ORIGIN_AIRPORT AND f.DESTINATION_AIRPORT = r.DESTINATION_AIRPORT
  AND f.DEPARTURE_HOUR = r.DEPARTURE_HOUR),
rk AS (SELECT *, CASE WHEN delay_probability > 0.75 THEN 'High Risk' WHEN delay_probability > 0.5 THEN 'Medium Risk'
  ELSE 'Low Risk' END AS risk_level FROM sc),
ra AS (SELECT *, CASE risk_level WHEN 'High Risk' THEN 'Assign priority gate and backup crew'
  WHEN 'Medium Risk' THEN 'Monitor operations and prepare support' ELSE 'Normal operation' END AS recommended_action
  FROM rk)"""


def _scored(spark, sf):
    return P.historical_delay_score(fixture_features(spark, sf, reads=[]), SCORE_KEYS)


@register("risk_tiers", O.with_stages(
    f"SELECT {_K}, delay_probability, risk_level, recommended_action FROM ra", _SC))
def q_risk_tiers(spark, sf):
    return P.add_risk(_scored(spark, sf)).select(*KEYS, P.PROB, "risk_level", "recommended_action")


_BIZ = "AIRLINE, ORIGIN_AIRPORT, DESTINATION_AIRPORT, DEPARTURE_HOUR, DISTANCE"


@register("recommendations", O.with_stages(
    f"SELECT {_K}, {_BIZ}, delay_probability, risk_level, recommended_action FROM ra", _SC))
def q_recommendations(spark, sf):
    return P.recommendation_table(_scored(spark, sf), id_cols=KEYS)


@register("risk_distribution", O.with_stages("SELECT risk_level, COUNT(*) AS n FROM ra GROUP BY 1", _SC))
def q_risk_distribution(spark, sf):
    return P.risk_distribution(P.add_risk(_scored(spark, sf)))


@register("top_risk_flights", O.with_stages(
    f"SELECT {_K}, {_BIZ}, delay_probability, risk_level, recommended_action FROM ra "
    f"ORDER BY delay_probability DESC, {_K} LIMIT 20", _SC))
def q_top_risk_flights(spark, sf):
    table = P.recommendation_table(_scored(spark, sf), id_cols=KEYS)
    return P.top_risk(table, 20, tie_break=KEYS)
