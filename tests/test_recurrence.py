"""Gated states against a sequential fold, with nearly all rows in one sender."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylabel.operators import recurrence

SCHEMA = "sender_id string, txn_id string, txn_time_utc timestamp_ntz, amount_log double, hour_sin double, hour_cos double"


def events(spark, n=1500):
    rnd = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        sender = "HOT" if i % 100 else f"s{i % 7}"
        when = start + dt.timedelta(minutes=rnd.randrange(0, 20 * 1440), seconds=rnd.choice([0, 0, 30]))
        rows.append((sender, f"t{i}", when, rnd.uniform(0, 8), rnd.uniform(-1, 1), rnd.uniform(-1, 1)))
    rows += [(None, "x", start, 1.0, 0.0, 0.0), ("s1", "y", None, 1.0, 0.0, 0.0)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("txn_date", F.to_date("txn_time_utc")), rows


@pytest.mark.parametrize("chunk, fan_in", [(2048, 64), (3, 2)])
def test_states_equal_a_sequential_fold(spark, chunk, fan_in):
    df, rows = events(spark)
    got = {(r.sender_id, r.snapshot_date): (r.n_window_txns, list(r.state)) for r in recurrence.gated_sender_state(df, chunk=chunk, fan_in=fan_in).collect()}
    live = sorted((r for r in rows if r[0] and r[2]), key=lambda r: (r[2], r[1]))
    days = {(r[0], r[2].date()) for r in live}
    assert got.keys() == days and sum(r[0] == "HOT" for r in live) > 0.98 * len(live)
    w, b, v = (np.array(x) for x in (recurrence.GATE_WEIGHTS, recurrence.GATE_BIASES, recurrence.VALUE_WEIGHTS))
    for sender, day in days:
        h, n = np.zeros(4), 0
        for r in live:
            if r[0] == sender and day - dt.timedelta(days=10) <= r[2].date() <= day:
                x = np.array(r[3:])
                z = 1 / (1 + np.exp(-(w @ x + b)))
                h, n = (1 - z) * h + z * (v @ x), n + 1
        assert got[sender, day][0] == n and np.allclose(got[sender, day][1], h, atol=1e-9)


def test_no_events(spark):
    df, _ = events(spark, 0)
    assert recurrence.gated_sender_state(df).count() == 0
