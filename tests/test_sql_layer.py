from contrail.operators import reports as R
from contrail.plans import sql_layer as SQ


def test_query_layer_sums_flags_in_sql(spark):
    df = spark.createDataFrame([("AA", True, 0, 20.0), ("AA", False, 1, None), ("UA", False, 0, 5.0)],
                               "AIRLINE string, IS_DELAYED_ARRIVAL boolean, CANCELLED int, ARRIVAL_DELAY double")
    assert dict(SQ.query_layer(df).dtypes)["IS_DELAYED_ARRIVAL"] == "int"
    name = SQ.register_table(df.withColumn("IS_DELAYED_DEPARTURE", df.IS_DELAYED_ARRIVAL), "t_sql_layer")
    out = {r.AIRLINE: r for r in R.airline_performance(spark.table(name)).collect()}
    assert out["AA"].arrival_delay_rate == 0.5 and out["AA"].cancel_rate == 0.5 and out["AA"].avg_arrival_delay == 20.0
    assert out["UA"].arrival_delay_rate == 0.0
    assert spark.sql("SELECT SUM(IS_DELAYED_ARRIVAL) AS s FROM t_sql_layer").first().s == 1
