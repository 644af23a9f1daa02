"""Gradients against finite differences, the distributed trainer against a local one, and what it learns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylabel.plans import context, encoders, networks, trainer, training
from paylabel.session import shared_path

RNG = np.random.default_rng(3)


def sequence_block(rows=6, steps=5):
    lens = RNG.integers(1, steps + 1, rows)
    lens[0] = steps
    return {
        "x": RNG.normal(size=(rows, steps, 3)), "tt": RNG.integers(1, 4, (rows, steps)), "ch": RNG.integers(1, 3, (rows, steps)), "n": lens,
        "y_type": RNG.integers(0, 4, rows), "y_amount": RNG.integers(0, 5, rows),
    }


CASES = [
    (networks.AutoEncoder(7, 3, 5), {"x": RNG.normal(size=(9, 7))}),
    (networks.Classifier(6, 4, (8, 5), (0.3, 0.2)), {"x": RNG.normal(size=(9, 6)), "y": RNG.integers(0, 4, 9)}),
    (networks.SequenceEncoder(4, 3, type_width=3, channel_width=2, hidden=6), sequence_block()),
]


@pytest.mark.parametrize("net, block", CASES, ids=lambda x: type(x).__name__)
@pytest.mark.parametrize("drop", [False, True])
def test_gradients_match_finite_differences(net, block, drop):
    flat = net.start(1) + 0.05 * RNG.normal(size=net.size)
    rng = lambda: np.random.default_rng(9) if drop else None
    _, rows, gradient = net.loss(flat, block, rng())
    assert rows == len(block["x"]) and gradient.shape == (net.size,)
    for i in RNG.choice(net.size, 60, replace=False):
        step = np.zeros(net.size)
        step[i] = 1e-6
        up, down = net.loss(flat + step, block, rng(), False)[0], net.loss(flat - step, block, rng(), False)[0]
        assert abs((up - down) / 2e-6 - gradient[i]) < 1e-4 * max(1, abs(gradient[i])), net.split(np.arange(net.size))


def test_padding_changes_nothing():
    net, block = CASES[2]
    flat = net.start(1)
    wide = {k: np.pad(v, [(0, 0), (0, 3)] + [(0, 0)] * (v.ndim - 2), constant_values=1) if k in ("x", "tt", "ch") else v for k, v in block.items()}
    assert np.allclose(net.outputs(flat, block), net.outputs(flat, wide)) and np.isclose(net.loss(flat, block)[0], net.loss(flat, wide)[0])


def labelled(spark, n=900, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(3, 6)) * 2
    labels = rng.integers(0, 3, n)
    x = centres[labels] + rng.normal(size=(n, 6))
    rows = [(f"t{i}", [float(v) for v in x[i]], int(labels[i])) for i in range(n)]
    return spark.createDataFrame(rows, "txn_id string, features array<double>, label_idx int"), x, labels


def test_summed_gradient_is_the_whole_table_s(spark):
    df, x, labels = labelled(spark)
    net = networks.Classifier(6, 3, (8,), (0.0,))
    flat = net.start(0)
    blocks = trainer.pack_blocks(df.repartition(5), shared_path(spark, "t", unique=True), trainer.vectors("features", "label_idx"), "txn_id", 3)
    loss, rows, gradient = trainer.summed(net, flat, blocks)
    want = net.loss(flat, {"x": x.astype(np.float32), "y": labels})
    assert rows == 900 and np.isclose(loss, want[0]) and np.allclose(gradient, want[2])
    assert [r["round"] for r in blocks.select("round").distinct().orderBy("round").collect()] == [0, 1, 2]


def test_training_goes_on_from_its_checkpoint(spark):
    df, _, _ = labelled(spark)
    net = networks.Classifier(6, 3, (8,), (0.2,))
    blocks = trainer.pack_blocks(df, shared_path(spark, "t", unique=True), trainer.vectors("features", "label_idx"), "txn_id", 2)
    whole = trainer.fit(net, blocks, blocks, 4, seed=1)
    path = shared_path(spark, "t", unique=True)
    trainer.fit(net, blocks, blocks, 2, seed=1, checkpoint=path)
    again = trainer.fit(net, blocks, blocks, 4, seed=1, checkpoint=path)
    assert np.allclose(again.params, whole.params) and [h["epoch"] for h in again.history] == [1, 2, 3, 4] and again.step == whole.step == 8


def test_classifier_matches_a_local_twin(spark):
    df, x, labels = labelled(spark)
    train, val = df.where("int(substring(txn_id, 2)) < 700"), df.where("int(substring(txn_id, 2)) >= 700")
    model, metrics = training.fit_classifier(train, val, 3, (16,), (0.1,), epochs=6, patience=2, lr=1e-2, batch_rows=128)
    history = model.extra["history"]
    assert [h["epoch"] for h in history] == list(range(1, len(history) + 1)) and training.training_history(spark, model).count() == len(history)
    m = metrics.first()
    best = min(history, key=lambda h: h["val_loss"])
    # the same network, trained here on shuffled batches
    net, rng = networks.Classifier(6, 3, (16,), (0.1,)), np.random.default_rng(0)
    state = trainer.State.new(net, 42)
    for _ in range(6):
        order = rng.permutation(700)
        for at in range(0, 700, 128):
            own = order[at : at + 128]
            _, n, g = net.loss(state.params, {"x": x[own], "y": labels[own]}, rng)
            state.adam(g / n, 1e-2)
    local = (net.outputs(state.params, {"x": x[700:]}).argmax(axis=1) == labels[700:]).mean()
    assert abs(m["accuracy"] - local) < 0.05 and m["accuracy"] > 0.8
    assert abs(best["accuracy"] - m["accuracy"]) < 1e-9
    path = shared_path(spark, "t", unique=True)
    model.save(spark, path)
    loaded = trainer.Fitted.load(spark, path)
    a, b = (training.score_batch(f, val).orderBy("txn_id").select("pred", "confidence").collect() for f in (model, loaded))
    assert a == b and all(0 < r.confidence <= 1 for r in a)


def test_autoencoder_beats_the_linear_one_on_a_curve(spark):
    """Points of a curve in six dimensions: one number tells them, which no line can."""
    rng = np.random.default_rng(2)
    t = rng.uniform(-1, 1, 1500)
    x = np.stack([t, t**2, np.sin(3 * t), np.cos(3 * t), t**3, np.abs(t)], axis=1)
    df = spark.createDataFrame([(f"t{i}", [float(v) for v in x[i]]) for i in range(len(x))], "txn_id string, ctx_vec array<double>")
    model = context.fit_ctx_autoencoder(df, code=2, hidden=32, epochs=16, lr=1.5e-2, patience=30, drop=0.0, batch_rows=250)
    _, mse = context.fit_ctx_embedding(df, 1)
    history = model.extra["history"]
    assert min(h["val_loss"] for h in history) < mse.first()["mse"] and history[-1]["train_loss"] < history[0]["train_loss"]
    emb = context.embed(df, model)
    assert emb.where(F.size("ctx_emb") != 2).count() == 0 and set(emb.columns) == {"txn_id", "ctx_vec", "ctx_emb"}


def test_sender_encoder_learns_order(spark):
    """The next type repeats the last event's: the recurrent encoder must beat chance and the averaged history."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(900):
        n = int(rng.integers(2, 9))
        tt = rng.integers(1, 4, n)
        hist = [(k + 1, float(rng.normal()), 0.0, 1.0, int(tt[k]), 1) for k in range(n)]
        rows.append((f"t{i}", hist, n, int(tt[-1]), int(rng.integers(0, 5))))
    schema = "txn_id string, hist array<struct<seq_no:long,amount_log:double,hour_sin:double,hour_cos:double,tt_idx:int,ch_idx:int>>, hist_len int, tt_idx int, amt_bin int"
    ex = spark.createDataFrame(rows, schema)
    model = encoders.fit_sender_encoder(ex, 3, 2, hidden=24, epochs=8, lr=3e-2, batch_rows=150)
    _, losses = encoders.fit_next_event_models(ex, 3)
    linear = {r["head"]: r.loss_last for r in losses.collect()}
    best = min(h["val_loss"] for h in model.extra["history"])
    assert best < linear["sum"] and best < np.log(5) + 0.5 * np.log(3)


def test_padding_is_not_computed():
    """What stands in the padding reaches neither loss nor gradient, not even as zero times something."""
    net, block = CASES[2]
    flat = net.start(1)
    padded = np.arange(block["tt"].shape[1]) >= block["n"][:, None]
    odd = {**block, "x": np.where(padded[:, :, None], np.nan, block["x"])}
    for rng in (lambda: None, lambda: np.random.default_rng(5)):
        (a, _, g), (b, _, h) = net.loss(flat, block, rng()), net.loss(flat, odd, rng())
        assert a == b and np.array_equal(g, h)


def test_blocks_are_planned_once_for_all_epochs(spark, monkeypatch):
    df, _, _ = labelled(spark, 300)
    net = networks.Classifier(6, 3, (8,), (0.2,))
    blocks = trainer.pack_blocks(df, shared_path(spark, "t", unique=True), trainer.vectors("features", "label_idx"), "txn_id", 2)
    planned, plan = [], trainer.block_parts
    monkeypatch.setattr(trainer, "block_parts", lambda x: planned.append(x) or plan(x))
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    state = trainer.fit(net, blocks, blocks, 3, seed=1)
    assert state.step == 6 and len(planned) == 3  # two parts and the validation blocks
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


def test_next_event_models_make_the_histories_once(spark):
    rng = np.random.default_rng(8)
    hists = [[(k + 1, *(float(v) for v in rng.normal(size=3)), int(rng.integers(0, 5)), 1) for k in range(n)] for n in [1, 7, 3, 7, 2] * 24]
    rows = [(f"t{i}", h, len(h), i % 3 + 1, i % 5) for i, h in enumerate(hists)]
    schema = "txn_id string, hist array<struct<seq_no:long,amount_log:double,hour_sin:double,hour_cos:double,tt_idx:int,ch_idx:int>>, hist_len int, tt_idx int, amt_bin int"
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ex = spark.createDataFrame(rows, schema)
    models, losses = encoders.fit_next_event_models(ex.mapInArrow(counted, ex.schema), 3)
    assert set(models) == {"y_type", "y_amount"} and losses.count() == 3 and seen.value == len(rows)
    got = ex.select("hist", "hist_len", "tt_idx", "amt_bin").mapInArrow(encoders.history_vectors(3), "x array<double>, y_type double, y_amount double").collect()
    for (_, hist, n, kind, amount), r in zip(rows, got, strict=True):
        want = np.zeros(7)
        for _, a, s, c, tt, _ in hist:
            want = want * (1.0 - 0.1) + np.array([a, s, c, *(float(tt == i) for i in range(1, 5))]) * 0.1
        assert r.x == [*want.tolist(), np.log1p(n)] and (r.y_type, r.y_amount) == (kind, amount)


def test_a_null_in_a_history_is_an_error():
    import pyarrow as pa

    event = {"amount_log": None, "hour_sin": 0.0, "hour_cos": 1.0, "tt_idx": 1}
    batch = pa.RecordBatch.from_pylist([{"hist": [event], "hist_len": 1, "tt_idx": 1, "amt_bin": 0}], pa.schema([
        ("hist", pa.list_(pa.struct([("amount_log", pa.float64()), ("hour_sin", pa.float64()), ("hour_cos", pa.float64()), ("tt_idx", pa.int32())]))),
        ("hist_len", pa.int32()), ("tt_idx", pa.int32()), ("amt_bin", pa.int32()),
    ]))
    with pytest.raises(ValueError, match="amount_log"):
        list(encoders.history_vectors(3)(iter([batch])))


def test_small_steps_are_one_job_an_epoch_and_the_same_steps(spark):
    df, _, _ = labelled(spark)
    blocks = trainer.pack_blocks(df.repartition(3), shared_path(spark, "t", unique=True), trainer.vectors("features", "label_idx"), "txn_id", 12)
    net, dealt = networks.Classifier(6, 3, (8,), (0.2,)), networks.Classifier(6, 3, (8,), (0.2,))
    dealt.solo_rows = 0
    spark.sparkContext.setJobGroup("solo", "small steps")
    one = trainer.fit(net, blocks, blocks, 2, seed=1)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("solo"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    many = trainer.fit(dealt, blocks, blocks, 2, seed=1)
    assert jobs < 12 and one.step == many.step == 24
    assert np.allclose(one.params, many.params) and np.allclose([h["val_loss"] for h in one.history], [h["val_loss"] for h in many.history])
    assert np.allclose([h["train_loss"] for h in one.history], [h["train_loss"] for h in many.history])


def test_sums_of_many_tasks_equal_those_of_few(spark, monkeypatch):
    df, _, _ = labelled(spark)
    net = networks.Classifier(6, 3, (8,), (0.0,))
    blocks = trainer.pack_blocks(df.repartition(5), shared_path(spark, "t", unique=True), trainer.vectors("features", "label_idx"), "txn_id", 1)
    few = trainer.summed(net, net.start(0), blocks)
    monkeypatch.setattr(trainer, "DIRECT_TASKS", 0)
    monkeypatch.setattr(trainer, "SEGMENT", 7)
    many = trainer.summed(net, net.start(0), blocks)
    assert few[1] == many[1] == 900 and np.isclose(few[0], many[0]) and np.allclose(few[2], many[2])


def test_executors_hold_few_rows_and_blocks_at_once(spark):
    class Counting(networks.Network):
        """Tells every row how many came with it."""

        shapes: list = []

        def outputs(self, flat, block):
            return np.full((len(block["x"]), 1), len(block["x"]), np.float64)

    rows = 40 * trainer.BLOCK_ROWS
    df = spark.range(0, rows, 1, 1).select(F.col("id").cast("string").alias("txn_id"), F.array(F.col("id").cast("double")).alias("features"))
    seen = trainer.Fitted(Counting(), np.zeros(0)).apply(df, trainer.vectors("features"), ["features"], "n").select("txn_id", F.col("n")[0].alias("n"))
    assert seen.count() == rows and seen.agg(F.max("n")).first()[0] <= trainer.BLOCK_ROWS
    blocks = trainer.pack_blocks(df, shared_path(spark, "t", unique=True), trainer.vectors("features"), "txn_id", 1)
    files = blocks.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("blocks"), F.sum("n").alias("n")).collect()
    assert max(f.blocks for f in files) <= 32 and sum(f.n for f in files) == rows
