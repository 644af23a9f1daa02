"""The factorisation of all dates against a dense one, on tiny, large, hot and rank-deficient dates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylabel.operators import graph
from paylabel.operators.factorise import factorise, svd_rank
from paylabel.sources import fixtures


def dense(edges, svd_dim):
    """date -> (ids, vectors, singular values) by numpy."""
    by_date = {}
    for r in edges.collect():
        by_date.setdefault(r.snapshot_date, []).append((r.sender_id, r.recipient_canon_id, r.weight))
    out = {}
    for date, rows in by_date.items():
        senders, ids = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
        a = np.zeros((len(senders), len(ids)))
        for s, r, w in rows:
            a[senders.index(s), ids.index(r)] = w
        _, s, vt = np.linalg.svd(a, full_matrices=False)
        k = min(svd_rank(*a.shape, svd_dim), len(s))
        out[date] = ids, vt[:k].T * np.sqrt(s[:k]), s
    return out


def compared(spark, edges, svd_dim, **how):
    f = factorise(edges, svd_dim, **how)
    got = {}
    for r in f.vectors.collect():
        got.setdefault(r.snapshot_date, {})[r.recipient_canon_id] = np.array(r.svd_vec)
    values = {}
    for r in f.values.orderBy("rank").collect():
        values.setdefault(r.snapshot_date, []).append(r.singular_value)
    return got, values, dense(edges, svd_dim)


def edge_table(spark, rows):
    e = spark.createDataFrame(rows, "d string, sender_id string, recipient_canon_id string, weight double")
    return e.withColumn("snapshot_date", F.to_date("d")).drop("d")


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(5)
    rows = [("2024-01-01", f"s{i}", f"r{j}", float(1 + i + 2 * j)) for i in range(5) for j in range(4) if (i + j) % 3]
    rows += [("2024-01-02", "s0", "r0", 2.0)]  # one edge
    rows += [("2024-01-03", f"s{i}", f"r{j}", float((i + 1) * (j + 1))) for i in range(12) for j in range(9)]  # rank one
    rows += [("2024-01-04", "s0", "r0", 0.0), ("2024-01-04", "s1", "r1", -3.0), ("2024-01-04", "s1", "r0", 1.0)]  # zero and negative weights
    for i, j in {(int(a), int(b)) for a, b in rng.integers(0, (90, 70), (1500, 2))}:
        rows.append(("2024-01-05", f"s{i}", f"r{j}", float(rng.uniform(0.5, 6))))
    rows += [("2024-01-05", f"hot{i}", "r0", 1.5) for i in range(700)]  # one recipient with a third of the edges
    return edge_table(spark, rows)


def test_full_rank_equals_dense(spark, mixed):
    got, values, want = compared(spark, mixed, 96)
    assert got.keys() == want.keys()
    for date, (ids, vectors, s) in want.items():
        assert sorted(got[date]) == ids
        mine = np.vstack([got[date][i] for i in ids])
        assert mine.shape == (len(ids), 96)
        assert np.allclose(mine @ mine.T, vectors @ vectors.T, atol=1e-6), date
        assert np.allclose(values[date], s[: len(values[date])], atol=1e-5) and np.all(np.diff(values[date]) <= 1e-9)
        for column in mine.T:  # the largest entry of every component is positive
            assert column[np.argmax(np.abs(column))] >= 0


def test_truncated_separates_the_leading_part(spark, mixed):
    got, values, want = compared(spark, mixed, 8)
    for date, (ids, vectors, s) in want.items():
        k = min(len(s), len(values[date]))
        assert np.allclose(values[date][:k], s[:k], rtol=5e-3, atol=1e-6)
        assert sum(x * x for x in values[date]) <= (s * s).sum() + 1e-6
    ids, vectors, s = want[max(want)]
    mine = np.vstack([got[max(want)][i] for i in ids])
    assert abs(mine[:, 0] @ vectors[:, 0]) / s[0] > 1 - 1e-5  # the leading vector itself
    assert sum(x * x for x in values[max(want)]) > 0.995 * (s[:8] ** 2).sum()  # nearly the best eight directions' energy
    got, values, _ = compared(spark, mixed.where("snapshot_date = '2024-01-05'"), 8, rounds=10)  # more rounds, closer
    assert np.allclose(values[max(want)], s[:8], rtol=1e-4)
    assert abs(np.array([got[max(want)][i][0] for i in ids]) @ vectors[:, 0]) / s[0] > 1 - 1e-10


def test_results_repeat_and_do_not_depend_on_partitions(spark, mixed):
    one = {(r.snapshot_date, r.recipient_canon_id): np.array(r.svd_vec) for r in factorise(mixed, 6).vectors.collect()}
    two = {(r.snapshot_date, r.recipient_canon_id): np.array(r.svd_vec) for r in factorise(mixed.repartition(7), 6).vectors.collect()}
    assert one.keys() == two.keys()
    for key in one:
        assert np.allclose(np.abs(one[key][:2]), np.abs(two[key][:2]), atol=1e-6)


def test_nothing_and_only_zero_weights(spark):
    empty = edge_table(spark, [("2024-01-01", "s", "r", 1.0)]).where("false")
    f = factorise(empty, 4)
    assert f.vectors.count() == 0 == f.values.count()
    zero = factorise(edge_table(spark, [("2024-01-01", "s", "r", 0.0), (None, "s", "r", 1.0), ("2024-01-01", None, "q", 1.0)]), 4)
    assert [(r.recipient_canon_id, list(r.svd_vec)) for r in zero.vectors.collect()] == [("r", [0.0] * 4)] and zero.values.count() == 0


def test_window_energy(spark):
    e = graph.interaction_edges(fixtures.transactions(spark, "/root/testdata/sf0.001"), 10)
    energy = {r[0]: r[1] for r in graph.singular_values(e, 40).groupBy("snapshot_date").agg(F.sum(F.col("singular_value") ** 2)).collect()}
    weights = {r[0]: r[1] for r in e.groupBy("snapshot_date").agg(F.sum(F.col("weight") ** 2)).collect()}
    assert energy.keys() == weights.keys() and all(np.isclose(energy[d], weights[d], rtol=1e-9) for d in energy)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])  # recipients > senders, then senders > recipients
def test_one_real_window_equals_dense(spark, sf):
    e = graph.interaction_edges(fixtures.transactions(spark, sf), 10)
    one = e.where(F.col("snapshot_date") == F.lit(e.agg(F.max("snapshot_date")).first()[0])).checkpoint(eager=True)
    got, values, want = compared(spark, one, 8, oversample=192)
    for date, (ids, vectors, s) in want.items():
        mine = np.vstack([got[date][i] for i in ids])
        # the same singular subspace scaled by the root of s: compare Gram matrices (sign and rotation free)
        assert np.allclose(mine @ mine.T, vectors @ vectors.T, atol=1e-6) and np.allclose(values[date], s[:8], atol=1e-6)


def test_tiny_and_larger_dates_share_one_job(spark):
    rows = [("2024-01-0%d" % d, f"s{i}", f"r{(i * 7 + j) % 11}", float(i + j + d)) for d, n in ((1, 4), (2, 30)) for i in range(n) for j in range(3)]
    e = edge_table(spark, rows).groupBy("snapshot_date", "sender_id", "recipient_canon_id").agg(F.sum("weight").alias("weight"))
    want = dense(e, 64)
    values = {(r.snapshot_date, r["rank"]): r.singular_value for r in graph.singular_values(e).collect()}
    assert {d for d, _ in values} == set(want)
    for date, (_, _, s) in want.items():
        assert all(abs(values[date, k + 1] - x) < 1e-5 for k, x in enumerate(s))


@pytest.mark.parametrize("block_edges", [1, 40, 10_000])
def test_blocks_of_any_size_give_the_same(spark, mixed, block_edges):
    got, values, want = compared(spark, mixed.unionByName(edge_table(spark, [("2024-01-02", "s0", "r0", 1.0)])).groupBy("snapshot_date", "sender_id", "recipient_canon_id").agg(F.sum("weight").alias("weight")), 96, block_edges=block_edges)
    for date, (ids, vectors, s) in want.items():
        mine = np.vstack([got[date][i] for i in ids])
        assert np.allclose(mine @ mine.T, vectors @ vectors.T, atol=1e-6) and np.allclose(values[date], s[: len(values[date])], atol=1e-5)


def test_window_edges_are_expanded_where_they_are_summed(spark):
    t = fixtures.transactions(spark, "/root/testdata/sf0.001")
    e = graph.interaction_edges(t, 10)
    executed = e._jdf.queryExecution().executedPlan().toString()
    above = executed[: executed.index("Generate explode(dates")]
    assert "Exchange" not in above and "Join" not in above
