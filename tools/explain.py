"""Print formatted physical plans of headline jobs (after the stores exist).

usage: python tools/explain.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from paylabel import queries as Q  # noqa: E402
from paylabel.plans import context, training  # noqa: E402
from paylabel.session import get_spark  # noqa: E402
from paylabel.sources import io  # noqa: E402


def show(title: str, df) -> None:
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(f"===== {title}: exchanges={plan.count('Exchange')} broadcasts={plan.count('BroadcastExchange')}")
    df.explain("formatted")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    show("sender_state", Q.sender_states(spark, sf))
    show("interaction_edges", Q.graph.interaction_edges(Q.txn(spark, sf), 10))
    sroot, sspec = Q.built_sender_store(spark, sf, "explain")
    rroot, rspec = Q.built_recipient_store(spark, sf, "explain")
    t = Q.txn(spark, sf)
    ctx = context.build_ctx(t, context.fit_ctx(t), mode="train")
    ts = training.training_set(spark, ctx, sroot, rroot, io.scan_label_map(spark), sspec.dim, rspec.dim, 1)
    show("training_set", ts.where("is_valid").select("txn_id", "features", "label_idx"))
    show("snapshot scan (one date)", io.scan_snapshots(spark, sroot, spark.range(1).select(F.lit("2024-01-05").alias("d"))))
    show("cascade", Q._cascade(spark, sf))


if __name__ == "__main__":
    main()
