"""Statistical validation (L1-L6, G7-G9, G14, H4) on the whole table.

The analysed notebook moved a per-carrier sample to one machine because of
memory; here every test runs distributed on all rows, so sampling is only an
option (``stratified_sample``). Each test reduces the data with one grouped
aggregation to a table with one row per group (or per group and flag), then
finishes with arithmetic on that small table. Only the p-value, one number,
goes through Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.special import chi2_pvalue, f_pvalue
from contrail.operators.enrich import label_with_fallback
from contrail.operators.joins import broadcast_if_small, join_group_values
from contrail.session import materialize

# ---------------------------------------------------------------------------
# Significance level, box-plot whisker reach, per-group sample size
# ---------------------------------------------------------------------------
ALPHA = 0.05
WHISKER_IQR = 1.5
SAMPLE_PER_GROUP = 20_000
DIGITS = 6

GROUP = "AIRLINE_NAME"
FLAG = "IS_DELAYED_ARRIVAL"
MINUTES = "ARRIVAL_DELAY"
CONGESTION = "ORIGIN_CONGESTION"


def stats_base(features: DataFrame, labels: DataFrame, extra_cols: Sequence[str] = ()) -> DataFrame:
    """F4 + C4 + C7: carrier display name (falling back to the code), the delay
    flag as int 0/1, minutes and congestion; rows with any of them null dropped."""
    lk = labels.select(F.col("IATA_CODE").alias("AIRLINE"), F.col("AIRLINE").alias(GROUP))
    named = label_with_fallback(features, lk, "AIRLINE", GROUP)
    out = named.select(*extra_cols, GROUP, F.col(FLAG).cast("int").alias(FLAG), MINUTES, CONGESTION)
    return out.dropna(subset=[GROUP, FLAG, MINUTES, CONGESTION])


def sample_order_key(seed: int, cols: Sequence[str]) -> Column:
    """Deterministic pseudo-random order: md5 of the seed and the row's key text.
    Unlike ``rand(seed)`` it does not depend on partitioning, so reruns and
    retried tasks pick the same rows."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def stratified_sample(df: DataFrame, group: str, n: int = SAMPLE_PER_GROUP, seed: int = 42,
                      order_cols: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """Up to ``n`` rows per group in pseudo-random order, exactly.

    Rows are counted per (group, first ``digits`` hex digits of the order key), a
    map-side combined count; the running count tells in which key range each group's
    n-th row lies. Rows in earlier ranges are all in, and only the rows of that one
    range (about 1/16^digits of the group) are ranked, so no group is sorted whole.
    """
    keyed = df.withColumn("__k", sample_order_key(seed, list(order_cols or df.columns)))
    keyed = keyed.withColumn("__p", F.substring("__k", 1, digits))
    ranges = keyed.groupBy(group, "__p").agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(group).orderBy("__p"))
    cuts = (ranges.withColumn("__upto", upto).groupBy(group).agg(
        F.sum("__n").alias("__rows"), F.min(F.when(F.col("__upto") >= n, F.struct("__p", (F.col("__upto") - F.col("__n")).alias("before")))).alias("__cut")))
    cuts = cuts.select(group, "__rows", F.col("__cut.__p").alias("__last"), F.col("__cut.before").alias("__before"))
    marked = join_group_values(keyed, [group], cuts, "__rows", ["__last", "__before"], null_safe=True)
    whole = marked.where(F.col("__last").isNull() | (F.col("__p") < F.col("__last")))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("__k"))
    partial = marked.where(F.col("__p") == F.col("__last")).withColumn("__r", rank)
    partial = partial.where(F.col("__before") + F.col("__r") <= n)
    return whole.select(*df.columns).unionByName(partial.select(*df.columns))


def group_sizes(df: DataFrame, group: str = GROUP) -> DataFrame:
    """Rows per group, largest first."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(group))


def mean_by_group(df: DataFrame, value: str, group: str = GROUP, alias: str | None = None,
                  digits: int = DIGITS) -> DataFrame:
    """Mean of a 0/1 flag (a rate) or of minutes per group, highest first."""
    name = alias or f"mean_{value.lower()}"
    return (df.groupBy(group).agg(F.round(F.avg(F.col(value).cast("double")), digits).alias(name))
            .orderBy(F.desc(name), F.asc(group)))


def contingency(df: DataFrame, group: str = GROUP, flag: str = FLAG) -> DataFrame:
    """Group x flag counts as columns ``not_delayed`` / ``delayed`` (0 when absent)."""
    out = df.groupBy(group).pivot(flag, [0, 1]).agg(F.count(F.lit(1)))
    return out.select(group, F.coalesce(F.col("0"), F.lit(0)).alias("not_delayed"),
                      F.coalesce(F.col("1"), F.lit(0)).alias("delayed"))


def _grid(df: DataFrame, group: str, flag: str, correction: bool) -> DataFrame:
    """One row per (group, observed flag value): observed ``o`` (0 where absent), expected ``e``,
    ``o_used`` (continuity-corrected with one degree of freedom), ``dof``, ``n``, ``groups``.

    One grouped count reads the rows; the margins are windows over its few result rows.
    """
    per_group = df.where(F.col(flag).isin(0, 1)).groupBy(group).agg(
        F.count_if(F.col(flag) == 0).alias("o0"), F.count_if(F.col(flag) == 1).alias("o1"))
    every = Window.partitionBy(F.lit(1))
    c0, c1 = F.sum("o0").over(every), F.sum("o1").over(every)
    wide = per_group.select(group, "o0", "o1", c0.alias("c0"), c1.alias("c1"), F.count(F.lit(1)).over(every).alias("groups"))
    n = F.col("c0") + F.col("c1")
    kinds = (F.col("c0") > 0).cast("long") + (F.col("c1") > 0).cast("long")
    cell = lambda v: F.struct(F.lit(v).alias(flag), F.col(f"o{v}").cast("double").alias("o"), F.col(f"c{v}").alias("c"))
    cells = wide.select(group, (F.col("o0") + F.col("o1")).alias("r"), n.alias("n"), "groups", ((F.col("groups") - 1) * (kinds - 1)).alias("dof"),
                        F.inline(F.array(cell(0), cell(1)))).where("c > 0")
    e = F.col("r").cast("double") * F.col("c") / F.col("n")
    diff = e - F.col("o")
    moved = F.col("o") + F.signum(diff) * F.least(F.lit(0.5), F.abs(diff))
    return cells.withColumn("e", e).withColumn("o_used", F.when(F.lit(correction) & (F.col("dof") == 1), moved).otherwise(F.col("o")))


def expected_counts(df: DataFrame, group: str = GROUP, flag: str = FLAG, digits: int = DIGITS) -> DataFrame:
    """L1: observed and expected count of every cell."""
    return _grid(df, group, flag, False).select(group, flag, F.col("o").cast("long").alias("observed"), F.round("e", digits).alias("expected"))


def _chi_square(df: DataFrame, group: str, flag: str, correction: bool) -> DataFrame:
    d = F.col("o_used") - F.col("e")
    return _grid(df, group, flag, correction).agg(
        F.sum(d * d / F.col("e")).alias("statistic"), F.max("dof").alias("dof"), F.max("n").alias("n_rows"), F.max("groups").alias("n_groups"))


def chi_square(df: DataFrame, group: str = GROUP, flag: str = FLAG, correction: bool = True,
               digits: int = DIGITS) -> DataFrame:
    """L1: chi-square test of independence of ``group`` and a 0/1 ``flag``.

    With one degree of freedom each observed count moves 0.5 towards its expectation
    (continuity correction), as usual for 2 x 2 tables.
    """
    return _chi_square(df, group, flag, correction).withColumn("statistic", F.round("statistic", digits))


def chi_square_test(df: DataFrame, group: str = GROUP, flag: str = FLAG, correction: bool = True,
                    alpha: float = ALPHA, digits: int = DIGITS) -> DataFrame:
    """L1 + L6: with the p-value (of the unrounded statistic) and ``reject_h0`` (p < alpha)."""
    test = _chi_square(df, group, flag, correction)
    p = test.withColumn("p_value", chi2_pvalue(F.col("statistic"), F.col("dof")))
    return p.select(F.round("statistic", digits).alias("statistic"), "dof", "n_rows", "n_groups", F.round("p_value", 9).alias("p_value"),
                    (F.col("p_value") < alpha).alias("reject_h0"))


def _anova(df: DataFrame, value: str, group: str) -> DataFrame:
    """One-way ANOVA with the unrounded F statistic.

    Per group: n, mean, sample variance (one aggregation). Then
    SSB = sum n_i m_i^2 - (sum n_i m_i)^2 / N and SSW = sum (n_i - 1) s_i^2 on
    the small per-group table.
    """
    v = F.col(value).cast("double")
    g = df.groupBy(group).agg(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_samp(v).alias("s2"))
    g = g.where(F.col("n") > 0)
    t = g.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"),
              F.sum(F.col("n") * F.col("m") * F.col("m")).alias("snm2"),
              F.sum(F.col("n") * F.col("m")).alias("snm"),
              F.sum((F.col("n") - 1) * F.coalesce(F.col("s2"), F.lit(0.0))).alias("ssw"))
    ssb = F.col("snm2") - F.col("snm") * F.col("snm") / F.col("N")
    df_b = F.col("k") - 1
    df_w = F.col("N") - F.col("k")
    f = (ssb / df_b) / (F.col("ssw") / df_w)
    return t.select(f.alias("f_statistic"), df_b.cast("long").alias("df_between"),
                    df_w.cast("long").alias("df_within"), F.col("k").alias("n_groups"), F.col("N").alias("n_rows"))


def anova(df: DataFrame, value: str = MINUTES, group: str = GROUP, digits: int = DIGITS) -> DataFrame:
    """L2: one-way ANOVA F statistic of ``value`` across ``group``."""
    return _anova(df, value, group).withColumn("f_statistic", F.round("f_statistic", digits))


def anova_test(df: DataFrame, value: str = MINUTES, group: str = GROUP, alpha: float = ALPHA, digits: int = DIGITS) -> DataFrame:
    """L2 + L6: with the p-value (of the unrounded statistic) and ``reject_h0``."""
    p = f_pvalue(F.col("f_statistic"), F.col("df_between"), F.col("df_within"))
    return _anova(df, value, group).withColumn("p_value", p).withColumn("reject_h0", F.col("p_value") < alpha).withColumn(
        "f_statistic", F.round("f_statistic", digits))


def correlation(df: DataFrame, x: str = CONGESTION, y: str = MINUTES, digits: int = DIGITS) -> DataFrame:
    """L3: Pearson correlation of two columns over the rows where both are set."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.agg(F.round(F.corr(F.col(x).cast("double"), F.col(y).cast("double")), digits).alias("pearson_r"),
                    F.count(F.lit(1)).alias("n_rows"))


def running_counts(counts: DataFrame, group: str, value: str, count: str, ranges: int | None = None) -> DataFrame:
    """``counts`` (group, value, count; one row per group and value) with ``upto``: how many rows of the group
    have this value or a smaller one.

    The rows are dealt to ranges of (group, value) of about equal size. Each range is summed,
    the sums of earlier ranges are added up (one row per group and range), and running counts
    are taken inside a range only: no task holds a whole group, however many values it has.
    """
    spark = counts.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartitionByRange(n, group, value).withColumn("__range", F.spark_partition_id())
    dealt = materialize(dealt, "value-ranges")  # written, so that the ranges stay as they are
    sums = dealt.groupBy(group, "__range").agg(F.sum(count).alias("__s"))
    earlier = F.sum("__s").over(Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col(group).alias("__g"), F.col("__range").alias("__r"), F.coalesce(earlier, F.lit(0)).alias("__before"))
    # one row per range, and one more for each further group in it
    met = dealt.join(broadcast_if_small(materialize(sums, "range-sums")), F.col(group).eqNullSafe(F.col("__g")) & (F.col("__range") == F.col("__r")))
    inside = F.sum(count).over(Window.partitionBy("__range", group).orderBy(value))
    return met.withColumn("upto", F.col("__before") + inside).select(*counts.columns, "upto")


def quartiles(counts: DataFrame, group: str, value: str, count: str, ranges: int | None = None) -> DataFrame:
    """Per group of ``counts`` (group, value, count): n and the exact quartiles (linear interpolation) q1, median, q3.

    A quartile lies between the values at two ranks; each is the smallest value with that many
    rows up to it, an aggregation over ``running_counts``.
    """
    totals = counts.groupBy(F.col(group).alias("__g")).agg(F.sum(count).alias("n"))
    upto = running_counts(counts, group, value, count, ranges)
    ranked = upto.join(broadcast_if_small(materialize(totals, "group-totals")), F.col(group).eqNullSafe(F.col("__g")))
    points = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    place = {name: F.lit(p) * (F.col("n") - 1) for name, p in points}
    at = lambda k: F.min(F.when(F.col("upto") > k, F.col(value)))
    ends = ranked.groupBy(group, "n").agg(*[at(f(place[name])).alias(f"{name}_{end}") for name, _ in points for end, f in (("low", F.floor), ("high", F.ceil))])
    between = lambda name: (F.col(f"{name}_low") + (place[name] - F.floor(place[name])) * (F.col(f"{name}_high") - F.col(f"{name}_low")))
    return ends.select(group, "n", *[between(name).alias(name) for name, _ in points])


def box_stats(df: DataFrame, value: str = MINUTES, group: str = GROUP, whis: float = WHISKER_IQR, digits: int = 4) -> DataFrame:
    """L4: per group n, mean, quartiles and box-plot whiskers: the most extreme values
    within ``whis`` IQR of the box.

    The rows are read once, into counts per (group, value); the rest works on those, range by range.
    """
    v = F.col(value).cast("double")
    counts = materialize(df.where(v.isNotNull()).groupBy(group, v.alias("__v")).agg(F.count(F.lit(1)).alias("__c")), "value-counts")
    box = quartiles(counts, group, "__v", "__c").withColumnRenamed(group, "__box")
    q = counts.join(broadcast_if_small(materialize(box, "quartiles")), F.col(group).eqNullSafe(F.col("__box")))
    reach = whis * (F.col("q3") - F.col("q1"))
    out = q.groupBy(group, "n", "q1", "median", "q3").agg(
        (F.sum(F.col("__v") * F.col("__c")) / F.col("n")).alias("mean"),
        F.min(F.when(F.col("__v") >= F.col("q1") - reach, F.col("__v"))).alias("whisker_low"),
        F.max(F.when(F.col("__v") <= F.col("q3") + reach, F.col("__v"))).alias("whisker_high"))
    return out.select(group, "n", *[F.round(F.col(c), digits).alias(c) for c in
                                    ("mean", "q1", "median", "q3", "whisker_low", "whisker_high")])
