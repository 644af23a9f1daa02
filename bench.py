"""Headline jobs timed at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Jobs: sender store build, recipient store build, training-set assembly (from
the two stores), decision cascade, plus the exact-quantile binning and the
per-sender next-event examples.  Every job is forced with a ``noop`` write, so
the whole plan runs without shipping rows to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from paylabel import queries as Q  # noqa: E402
from paylabel.plans import context, stores, training  # noqa: E402
from paylabel.session import get_spark, shared_path  # noqa: E402
from paylabel.sources import fixtures, io  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_spark()
    times: dict[str, float] = {}
    t = fixtures.transactions(spark, sf)

    t0 = time.time()
    sspec = Q.sender_spec(spark, sf)
    sroot = shared_path(spark, "bench", "x_snd", unique=True)
    stores.build_sender_store(spark, t, sroot, sspec)
    times["sender_store"] = time.time() - t0

    t0 = time.time()
    rroot = shared_path(spark, "bench", "x_rcv", unique=True)
    rspec = stores.RecipientStoreSpec()
    stores.build_recipient_store(
        spark, t, fixtures.recipient_entity(spark, sf), fixtures.merchant_profile(spark, sf), fixtures.person_profile(spark, sf), rroot, rspec
    )
    times["recipient_store"] = time.time() - t0

    t0 = time.time()
    art = context.fit_ctx(t, text_dim=16)
    ctx = context.build_ctx(t, art, mode="train")
    ts = training.training_set(spark, ctx, sroot, rroot, io.scan_label_map(spark), sspec.dim, rspec.dim, lookback_days=1)
    # the split reads the assembled set several times (cut, then rows): materialise it once
    ts = ts.where("is_valid").select("txn_id", "txn_date", "features", "label_idx").checkpoint(eager=True)
    run(training.temporal_split(ts, 0.2).select("txn_id", "split", "features", "label_idx"))
    times["training_set"] = time.time() - t0

    t0 = time.time()
    run(Q._cascade(spark, sf))
    times["cascade"] = time.time() - t0

    t0 = time.time()
    run(Q.q_next_event_examples(spark, sf))
    times["next_event_examples"] = time.time() - t0

    t0 = time.time()
    run(Q.q_bin_amount(spark, sf))
    times["bin_amount"] = time.time() - t0

    t0 = time.time()
    run(Q.q_metric_auc_ovr(spark, sf).select(F.col("auc_ovr")))
    times["metric_auc_ovr"] = time.time() - t0

    total = sum(times.values())
    print(
        json.dumps(
            {
                "metric": "total_job_seconds",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
            }
        )
    )


if __name__ == "__main__":
    main()
