from pyspark.sql import functions as F

from contrail.operators import quality as Q
from contrail.plans import registry


def test_duplicates_treat_null_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (2, "x"), (3, "y")], "a int, b string")
    r = Q.duplicate_report(df).first()
    assert (r.total_rows, r.duplicate_rows, r.unique_rows) == (6, 3, 3)
    for members in (Q.duplicate_rows(df), Q.duplicate_rows(df, ["a"], max_hot_groups=1, broadcast_max_rows=0)):
        assert sorted((m.a, m.copies) for m in members.collect()) == [(1, 2), (1, 2), (2, 3), (2, 3), (2, 3)]


def test_duplicates_with_clashing_digests(spark):
    """Digests of two values only: groups are still those of the rows' values."""
    df = spark.range(0, 400, 1, 4).selectExpr("IF(id % 7 = 0, NULL, id % 90) AS a", "IF(id % 5 = 0, NULL, concat('t', id % 11)) AS b", "id % 2 AS c")
    weak = lambda cols: [F.pmod(F.xxhash64(*cols), F.lit(2)).alias("__d1"), F.lit(0).alias("__d2")]
    for subset in (None, ["a", "b"]):
        for digest in (weak, Q.row_digests):
            sizes = df.groupBy(*(subset or df.columns)).count()
            want = sizes.agg(F.sum("count").alias("n"), F.count("*").alias("u")).first()
            r = Q.duplicate_report(df, subset, digest=digest).first()
            assert (r.total_rows, r.unique_rows, r.duplicate_rows) == (want.n, want.u, want.n - want.u)
            got = Q.duplicate_rows(df, subset, digest=digest)
            back = sizes.where("count > 1").select(*[F.col(c).alias(f"k_{c}") for c in (subset or df.columns)], F.col("count").alias("copies"))
            members = df.join(back, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in (subset or df.columns)]).select(*df.columns, "copies")
            assert sorted(map(str, got.collect())) == sorted(map(str, members.collect()))
    assert Q.duplicate_report(df.limit(0)).first().total_rows == 0 and Q.duplicate_rows(df.limit(0)).count() == 0


def test_unique_rows_are_not_shuffled_whole(spark, monkeypatch):
    """Wide rows move only where a digest is repeated: the plan's exchanges carry digests or the few repeated rows."""
    wide = spark.range(0, 3000, 1, 4).selectExpr("id % 2990 AS id", "repeat('x', 200) AS t")
    _, rows = Q._repeated(wide, wide.columns, Q.row_digests)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and rows.count() == 20
    monkeypatch.setattr(Q, "fits_broadcast", lambda *_: False)
    _, again = Q._repeated(wide, wide.columns, Q.row_digests)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))


def test_junk_text(spark):
    nbsp = "Augusta Regional Airport at (Bush Field)"
    df = spark.createDataFrame([("A\x01B", nbsp, "123"), ("ok", "#$%^&*()", "AB")],
                               "TAIL_NUMBER string, ORIGIN_AIRPORT_NAME string, AIRLINE string")
    r = {x.column_name: x for x in Q.junk_text_report(df).collect()}
    assert r["TAIL_NUMBER"].non_printable == 1
    assert r["ORIGIN_AIRPORT_NAME"].excessive_special == 1  # the no-break space is white space, "#$%^&*()" is not
    assert r["AIRLINE"].pure_numeric == 1 and r["TAIL_NUMBER"].pure_numeric == 0
    vals = {(x.column_name, x.value) for x in Q.junk_values(df).collect()}
    assert ("AIRLINE", "123") in vals and ("ORIGIN_AIRPORT_NAME", "#$%^&*()") in vals


def test_hhmm_histogram_lists_empty_bins(spark):
    df = spark.createDataFrame([(0,), (599,), (600,), (2359,), (None,)], "DEPARTURE_TIME int")
    r = {x.bin: x.n for x in Q.hhmm_histogram(df, ["DEPARTURE_TIME"]).collect()}
    assert r == {"[0, 600)": 2, "[600, 1200)": 1, "[1200, 1800)": 0, "[1800, 2400)": 1}


def test_time_format_report_and_verdict(spark):
    df = spark.createDataFrame([(5, "0005"), (2360, "2360"), (None, None)], "ARRIVAL_TIME int, ARRIVAL_TIME_STR string")
    r = Q.time_format_report(df, ["ARRIVAL_TIME"]).first()
    assert (r.above_2359, r.valid_hhmm, r.invalid_hhmm, r.passed) == (1, 1, 1, False)
    assert Q.verdict(Q.time_format_report(df, ["ARRIVAL_TIME"])).first().all_passed is False


def test_code_checks(spark):
    airports = spark.createDataFrame([("AAA",), ("BBB",)], "IATA_CODE string")
    df = spark.createDataFrame([("AAA", "BBB"), ("ZZZ", "AAA"), ("AAA", "YYY"), ("ZZZ", "YYY"), (None, "AAA")],
                               "ORIGIN_AIRPORT string, DESTINATION_AIRPORT string")
    b = Q.code_breakdown(df, airports).first()
    assert (b.total_rows, b.both_valid, b.origin_only_invalid, b.destination_only_invalid, b.both_invalid) == \
        (5, 1, 2, 1, 1)
    s = Q.code_summary(df, airports, ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]).first()
    assert (s.distinct_codes, s.matched, s.invalid) == (4, 2, 2)
    inv = {(r.side, r.code): r.n for r in Q.invalid_codes(df, airports, ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]).collect()}
    assert inv[("ALL", "ZZZ")] == 2 and inv[("ALL", "YYY")] == 2
    assert sorted(r.code for r in Q.code_set_difference(df, airports, ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]).collect()) == ["YYY", "ZZZ"]


def test_range_and_null_profile(spark):
    df = spark.createDataFrame([(2015, 1, " "), (2014, 13, None), (None, 12, "x")], "YEAR int, MONTH int, s string")
    r = {x.column_name: x for x in Q.range_report(df).collect()}
    assert (r["YEAR"].invalid, r["YEAR"].missing, r["YEAR"].unexpected_values) == (1, 1, 1)
    assert r["MONTH"].invalid == 1 and r["MONTH"].unexpected_values is None
    n = {x.column_name: x for x in Q.null_profile(df).collect()}
    assert (n["s"].missing, n["s"].blank) == (1, 1)
    top = Q.invalid_values_topk(df).collect()
    assert sorted((t.column_name, t.value) for t in top) == [("MONTH", 13), ("YEAR", 2014)]


def test_numeric_summary_and_row_accounting(spark):
    df = spark.createDataFrame([(x, None) for x in (1, 2, 3, 4, 10)] + [(None, None)], "a int, b double")
    r = {x.column_name: x for x in Q.numeric_summary(df, ["a", "b"]).collect()}
    assert (r["a"]["count"], r["a"]["mean"], r["a"].q25, r["a"].q50, r["a"].q75, r["a"]["max"]) == (5, 4.0, 2.0, 3.0, 4.0, 10.0)
    assert r["b"]["count"] == 0 and r["b"].q50 is None
    approx = {x.column_name: x for x in Q.numeric_summary(df, ["a"], relative_error=0.001).collect()}
    assert approx["a"].q50 == 3.0
    flagged = spark.createDataFrame([("A", "B", True), ("A", "A", True), ("C", None, False), ("A", None, None)],
                                    "ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, keep boolean")
    x = Q.row_accounting(flagged).first()
    assert (x.rows_before, x.rows_after, x.distinct_codes_left, x.rows_removed, x.removed_pct) == (4, 2, 2, 2, 50.0)


def test_time_text_examples_lengths_and_clean_gate(spark):
    df = spark.createDataFrame([(5, "0005"), (2460, "2460"), (2460, "2460"), (12345, "12345"), (None, None)],
                               "ARRIVAL_TIME int, ARRIVAL_TIME_STR string").selectExpr("*", "CAST(100 AS INT) AS WHEELS_ON")
    bad = {(r.value, r.n) for r in Q.bad_hhmm_examples(df, ["ARRIVAL_TIME"]).collect()}
    assert bad == {("2460", 2), ("12345", 1)}
    assert {(r.length, r.n) for r in Q.time_text_lengths(df, ["ARRIVAL_TIME"]).collect()} == {(4, 3), (5, 1)}
    gated = Q.hhmm_histogram(df, ["ARRIVAL_TIME", "WHEELS_ON"], clean_only=True)
    assert {r.column_name for r in gated.collect()} == {"WHEELS_ON"}
    lookup = spark.createDataFrame([("A",)], "IATA_CODE string")
    codes = spark.createDataFrame([("C", "B"), ("A", "D")], "o string, d string")
    assert [r.code for r in Q.code_set_difference(codes, lookup, ["o", "d"], first=2).collect()] == ["B", "C"]


def test_schema_report_is_a_helper_and_no_query(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert [tuple(r) for r in Q.schema_report(df).orderBy("position").collect()] == [(0, "a", "int"), (1, "b", "string")]
    assert "schema_report" not in registry.queries() and "schema_report" not in registry.oracle_sql()
