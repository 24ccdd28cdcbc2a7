import collections
import random

import pytest
from pyspark.sql import functions as F

from contrail.operators import heavy_hitters as H


def want(rows, k):
    count = collections.Counter(r for r in rows if r[1] is not None)
    out = []
    for name in {c for c, _ in count}:
        ranked = sorted(((n, v) for (c, v), n in count.items() if c == name), key=lambda x: (-x[0], x[1]))
        out += [(name, v, n, i + 1) for i, (n, v) in enumerate(ranked[:k])]
    return sorted(out)


@pytest.mark.parametrize("counters", [8, 60, 1000])
def test_top_values_are_exact_on_skewed_and_flat_columns(spark, counters):
    rng = random.Random(4)
    rows = [("skewed", f"v{int(rng.paretovariate(0.9))}") for _ in range(6000)] + [("flat", f"f{i % 900}") for i in range(5000)]
    rows += [("one", "x")] * 700 + [("null", None)] * 50 + [("few", v) for v in "aab"] + [("ties", f"t{i % 5}") for i in range(100)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "column_name string, value string").repartition(5)
    got = H.top_values(df, 5, counters).collect()
    assert sorted(tuple(r) for r in got) == want(rows, 5)


def test_few_values_are_counted_where_the_summary_proves_them(spark):
    rng = random.Random(6)
    rows = [("c", "hot" if rng.random() < 0.3 else "warm" if rng.random() < 0.3 else f"x{rng.randint(0, 10**6)}") for _ in range(20_000)]
    df = spark.createDataFrame(rows, "column_name string, value string").repartition(4)
    counted = H.frequent_values(df, 2, 50).collect()
    assert len(counted) < 10 and {"hot", "warm"} <= {r.value for r in counted}
    assert H.top_values(df.limit(0), 3).count() == 0


def test_summary_bounds():
    rng = random.Random(7)
    for counters in (1, 5, 40):
        counts, error, true = {}, 0, collections.Counter()
        for _ in range(5000):
            v = int(rng.paretovariate(0.7))
            true[v] += 1
            counts[v] = counts.get(v, 0) + 1
            if len(counts) > 2 * counters:
                error += H.shrink(counts, counters)
        error += H.shrink(counts, counters)
        assert len(counts) <= counters and error <= 5000 / (counters + 1)
        assert all(counts.get(v, 0) <= n <= counts.get(v, 0) + error for v, n in true.items())


def test_cells(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, y int")
    got = df.select(F.inline(H.cells({"x": F.col("x"), "y": F.col("y")}))).collect()
    assert sorted(tuple(r) for r in got) == [("x", "a"), ("y", "1"), ("y", "2")]
