"""Order-indexed recurrent state of senders as a composition of gated linear maps.

An event with gate z and value v (vectors, z between 0 and 1) takes the state h to
(1 - z) h + z v: what a gated recurrent unit does whose gates look at the event alone.  Two such
steps in a row are again a map h -> a h + b, so maps form a monoid and a history needs no
sequential pass: events are folded in chunks of bounded size, chunks are composed in a tree of bounded
fan-in, and a day's map stands for all its events.  A snapshot composes the maps of the days in its window.
A sender with most of all rows is many chunks; no task holds its history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylabel.functions import features as fx
from paylabel.operators.ranking import bucketed_rank
from paylabel.operators.snapshots import expand_to_snapshots

#: Events of one chunk, and chunks that are composed at once.
CHUNK, FAN_IN = 2048, 64


def _times(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def gates(inputs: list[Column], weights: list[list[float]], biases: list[float]) -> Column:
    """One sigmoid per row of weights, over the inputs."""
    lines = [sum((F.lit(w) * x for w, x in zip(row, inputs)), F.lit(b)) for row, b in zip(weights, biases)]
    return F.array(*[F.lit(1.0) / (F.lit(1.0) + F.exp(-line)) for line in lines])


def compose(maps: Column, width: int) -> Column:
    """One map for an ordered array of maps (struct of a and b), the first one applied first."""
    start = F.struct(F.array_repeat(F.lit(1.0), width).alias("a"), F.array_repeat(F.lit(0.0), width).alias("b"))
    return F.aggregate(
        maps, start, lambda acc, m: F.struct(_times(acc["a"], m["a"]).alias("a"), _plus(_times(acc["b"], m["a"]), m["b"]).alias("b"))
    )


def _folded(rows: DataFrame, keys: list[str], order: str, width: int) -> DataFrame:
    """One map per group of rows (keys, order, a, b); a group is at most a chunk."""
    listed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, "a", "b"))).alias("maps"), F.count(F.lit(1)).alias("_n"))
    return listed.withColumn("map", compose(F.col("maps"), width)).select(*keys, "map.a", "map.b")


def daily_maps(events: DataFrame, gate: Column, value: Column, width: int, key: str = "sender_id", chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """``key, txn_date, a, b``: the map of each day's events in their order (time, txn_id), and ``n``, their number.

    Events without a key or a time have no place in an order and are left out.
    """
    rows = events.where(F.col(key).isNotNull() & F.col("txn_date").isNotNull())
    day = [key, "txn_date"]
    ranked = bucketed_rank(rows, day, F.date_trunc("minute", F.col("txn_time_utc")), [F.col("txn_time_utc"), F.col("txn_id")], out="_pos")
    steps = ranked.select(
        *day, "_pos", F.floor((F.col("_pos") - 1) / chunk).alias("_chunk"), F.transform(gate, lambda z: 1 - z).alias("a"), _times(gate, value).alias("b")
    )
    folded = _folded(steps, [*day, "_chunk"], "_pos", width).checkpoint(eager=True)
    while (folded.agg(F.max("_chunk")).first()[0] or 0) > 0:
        parts = folded.withColumnRenamed("_chunk", "_part").withColumn("_chunk", F.floor(F.col("_part") / fan_in))
        folded = _folded(parts, [*day, "_chunk"], "_part", width).checkpoint(eager=True)
    counts = rows.groupBy(*day).agg(F.count(F.lit(1)).alias("n"))
    return folded.drop("_chunk").join(counts, day)


def windowed_states(days: DataFrame, width: int, lookback_days: int = 10, key: str = "sender_id") -> DataFrame:
    """``key, snapshot_date, n_window_txns, state``: for every day with events, the state after its window's events.

    A window holds at most ``lookback_days`` + 1 maps of a key.
    """
    spread = expand_to_snapshots(days, lookback_days)
    step = F.struct("txn_date", "a", "b")
    windows = spread.groupBy(key, "snapshot_date").agg(
        F.sort_array(F.collect_list(step)).alias("maps"), F.sum("n").alias("n_window_txns"), F.max(F.col("txn_date") == F.col("snapshot_date")).alias("_on_day")
    )
    # a state starts from zero, so the composed map's b is the state itself
    return windows.where("_on_day").select(key, "snapshot_date", "n_window_txns", compose(F.col("maps"), width)["b"].alias("state"))


#: Gates and values of the default state: rows of weights over (amount_log, hour_sin, hour_cos), biases.
GATE_WEIGHTS = [[0.3, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0], [-0.2, 0.5, 0.5]]
GATE_BIASES = [-1.5, -1.0, -1.0, 0.5]
VALUE_WEIGHTS = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0], [0.1, 0.5, -0.5]]


def gated_sender_state(
    events: DataFrame,
    lookback_days: int = 10,
    gate_weights: list[list[float]] = GATE_WEIGHTS,
    gate_biases: list[float] = GATE_BIASES,
    value_weights: list[list[float]] = VALUE_WEIGHTS,
    chunk: int = CHUNK,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Snapshots of the gated state over amount and hour of each event, in the order of the events."""
    inputs = [F.col(c).cast("double") for c in ("amount_log", "hour_sin", "hour_cos")]
    value = F.array(*[sum((F.lit(w) * x for w, x in zip(row, inputs)), F.lit(0.0)) for row in value_weights])
    rows = events.withColumn("_z", gates(inputs, gate_weights, gate_biases)).withColumn("_v", value)
    days = daily_maps(rows, F.col("_z"), F.col("_v"), len(gate_weights), chunk=chunk, fan_in=fan_in)
    return windowed_states(days, len(gate_weights), lookback_days)
