"""Snapshot operators against brute-force Python on the small fixture."""

import math
from collections import defaultdict
from datetime import timedelta

import numpy as np
from pyspark.sql import functions as F

from paylabel.operators import snapshots
from paylabel.sources import fixtures

SF = "/root/testdata/sf0.001"


def _events(spark):
    t = fixtures.transactions(spark, SF)
    tt = snapshots.fit_category_vocab(t, "tranx_type")
    ch = snapshots.fit_category_vocab(t, "channel")
    return snapshots.event_features(t, tt, ch), tt, ch


def test_sender_state_brute_force(spark):
    ev, tt, ch = _events(spark)
    rows = ev.collect()
    states = {(r.sender_id, r.snapshot_date): (r.n_window_txns, r.state) for r in snapshots.sender_state(ev, tt, ch, 10, 2.0).collect()}
    by_sender = defaultdict(list)
    for r in rows:
        by_sender[r.sender_id].append(r)
    active = {(r.sender_id, r.txn_date) for r in rows}
    assert set(states) == active
    k = math.log(2.0) / 2.0
    for (s, d), (n, state) in states.items():
        win = [r for r in by_sender[s] if d - timedelta(days=10) <= r.txn_date <= d]
        h = np.zeros(4 + len(tt) + len(ch))
        for r in win:
            age = (d - r.txn_date).days + (86400 - r.sod) / 86400.0
            x = np.zeros_like(h)
            x[:4] = [1.0, r.amount_log, r.hour_sin, r.hour_cos]
            x[3 + r.tt_idx] = 1.0
            x[3 + len(tt) + r.ch_idx] = 1.0
            h += math.exp(-k * age) * x
        h = h / max(np.linalg.norm(h), 1e-9)
        assert n == len(win)
        assert np.allclose(state, h, atol=1e-12)
        assert abs(np.linalg.norm(state) - 1.0) < 1e-9
        assert all(r.txn_date <= d for r in win)  # no snapshot uses a later row


def test_next_event_examples_chunked_matches_unchunked(spark):
    ev, _, _ = _events(spark)
    hist = snapshots.sender_history(ev)
    feats = ["amount_log", "tt_idx"]
    small = snapshots.next_event_examples(hist, feats, ["tt_idx"], maxlen=5, chunk=7)
    rows = hist.select("sender_id", "seq_no", "txn_id", "amount_log").collect()
    seqs = defaultdict(dict)
    for r in rows:
        seqs[r.sender_id][r.seq_no] = r
    got = {(r.sender_id, r.seq_no): r for r in small.collect()}
    want_keys = {(s, n) for s, m in seqs.items() for n in m if n >= 2}
    assert set(got) == want_keys
    for (s, n), r in got.items():
        exp = [seqs[s][i].amount_log for i in range(max(1, n - 5), n)]
        assert [h["amount_log"] for h in r.hist] == exp
        assert r.hist_len == len(exp)


def test_pad_sequences(spark):
    df = spark.createDataFrame([([{"seq_no": 1, "amount_log": 2.0}, {"seq_no": 2, "amount_log": 3.0}],)], "hist array<struct<seq_no:int,amount_log:double>>")
    got = df.select(snapshots.pad_sequences(F.col("hist"), "amount_log", 5)).first()[0]
    assert got == [2.0, 3.0, 0.0, 0.0, 0.0]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-03"), ("b", "2024-01-02")], "k string, d string").withColumn(
        "snapshot_date", F.to_date("d")
    )
    last = {r.k: str(r.snapshot_date) for r in snapshots.latest_per_key(df, "k").collect()}
    first = {r.k: str(r.snapshot_date) for r in snapshots.latest_per_key(df, "k", keep="first").collect()}
    assert last == {"a": "2024-01-03", "b": "2024-01-02"}
    assert first == {"a": "2024-01-01", "b": "2024-01-02"}


def test_day_rows_are_expanded_where_they_are_summed(spark):
    from paylabel.operators import snapshots as sn
    from paylabel.sources import fixtures as fixed

    ev = sn.event_features(fixed.transactions(spark, "/root/testdata/sf0.001"), ["a"], ["b"])
    executed = sn.sender_state(ev, ["a"], ["b"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in executed[: executed.index("Generate explode(sequence")]
