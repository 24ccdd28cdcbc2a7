"""Write docs/PLANS.md: the physical plans of the pipeline stages and of a few
reports (operator tree plus the scan details that show pruning and pushdown)."""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from contrail.operators import features as FT  # noqa: E402
from contrail.operators import reports as R  # noqa: E402
from contrail.operators import stats as ST  # noqa: E402
from contrail.plans import registry  # noqa: E402
from contrail.plans.pipeline import fixture_enriched, fixture_features, fixture_frames  # noqa: E402
from contrail.session import local_session  # noqa: E402
from contrail.sources.fixtures import FIXTURE_COORDINATE_PATCHES  # noqa: E402

KEEP = ("PushedFilters", "ReadSchema", "PartitionFilters", "Join type", "Arguments: hashpartitioning",
        "Keys", "Functions")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    lines = buf.getvalue().splitlines()
    tree, details, in_tree = [], [], True
    for ln in lines:
        if in_tree and ln.startswith("("):
            in_tree = False
        if in_tree:
            if ln.strip():
                tree.append(ln)
        elif ln.startswith("(") or ln.startswith(KEEP):
            details.append(ln[:220])
    return "\n".join(tree + [""] + details)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    fr = fixture_frames(spark, sf)
    s1 = fixture_enriched(spark, sf, persist=True)
    feats = fixture_features(spark, sf)
    sections = [
        ("Stage 1: clean + enrich + scalar features (raw scan, broadcast semi/left joins, no shuffle)",
         FT.add_scalar_features(fr.enriched(FIXTURE_COORDINATE_PATCHES))),
        ("Stage 2: group counts joined back (group tables proven small -> broadcast, fact not shuffled)",
         FT.add_origin_congestion(FT.add_tail_counts(s1))),
        ("Stage 2 as at 100 TB (group table too big to broadcast; auto-broadcast off): hot groups broadcast, "
         "the rest a salted sort-merge join", lambda: FT.add_origin_congestion(s1, broadcast_max_rows=0)),
        ("G2 airline_performance on the persisted feature table (column-pruned scan, partial + final agg)",
         R.airline_performance(feats)),
        ("G3 airport_congestion (HAVING + top 20 -> TakeOrderedAndProject)",
         R.airport_congestion(feats, min_flights=3000)),
        ("G4 monthly_trend with a month filter pushed to the scan",
         R.monthly_trend(feats.where(F.col("MONTH").between(6, 8)))),
        ("B4 null_profile: 33 columns in one aggregation, unpivoted with inline",
         registry.QUERIES["null_profile"](spark, sf)),
        ("H4 stratified_sample: two-phase salted top-n", registry.QUERIES["stratified_sample"](spark, sf)),
        ("L1 chi_square: one grouped count, margins on the small table", registry.QUERIES["chi_square"](spark, sf)),
        ("L4 delay_distribution: exact quartiles, skew-safe join back for whiskers",
         ST.box_stats(ST.stats_base(feats, fr.airlines))),
    ]
    out = ["# Physical plans", "", f"Generated by `scripts/explain_plans.py` at `{sf}` (local[8], AQE on; the",
           "initial plan is shown -- AQE may still turn shuffle joins into broadcasts at run time).", ""]
    for title, df in sections:
        if callable(df):  # built and explained with automatic broadcasts disabled
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
            text = plan_text(df())
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            text = plan_text(df)
        out += [f"## {title}", "", "```", text, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
