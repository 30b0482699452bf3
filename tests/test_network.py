"""The ReLU network: gradients against finite differences, training against a plain loop."""

import copy
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrella.functions.numeric import drawn_bits
from terrella.learning import network
from terrella.operators.metrics import epoch_loss
from terrella.sources import generators

LAYERS = (3, 5, 4, 3)


@pytest.fixture(scope="module")
def rows(spark):
    x = [generators.normal(F.col("id"), 31, i) for i in range(3)]
    label = F.when(x[0] > 0.4, 0).when(x[1] * x[2] > 0, 1).otherwise(2)
    return spark.range(203).select("id", F.array(*x).alias("f"), label.alias("y")).repartition(5).persist()


def loss_of(net, x, y, weight):
    logits = net.forward(x)[-1]
    return float((weight * (np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(len(y)), y])).sum())


@pytest.mark.parametrize("layers", [(3, 3), (3, 5, 3), (3, 6, 5, 4, 3)])
def test_gradients_equal_finite_differences(layers):
    rng = np.random.default_rng(3)
    net = network.Network.drawn(layers, seed=5)
    net.weights += rng.normal(0, 0.1, len(net.weights))  # no unit stands exactly at its kink
    x, y, weight = rng.normal(size=(40, 3)), rng.integers(0, 3, 40), rng.random(40)
    gradient, loss, right = net.backward(x, y, weight)
    assert loss == pytest.approx(loss_of(net, x, y, np.ones(40)))
    assert right == (net.forward(x)[-1].argmax(axis=1) == y).sum()
    for i in range(len(net.weights)):
        moved = []
        for step in (1e-6, -1e-6):
            weights = net.weights.copy()
            weights[i] += step
            moved.append(loss_of(network.Network(net.layers, weights), x, y, weight))
        assert gradient[i] == pytest.approx((moved[0] - moved[1]) / 2e-6, abs=1e-5)


def plain(rows, start, epochs, batch_rows, shards, drop_last):
    """The same training as a loop over lists."""
    data = {r["id"]: (np.array(r["f"]), r["y"]) for r in rows.collect()}
    net, optimiser = start.network, copy.deepcopy(start.optimiser)
    told = []
    for epoch in range(epochs):
        drawn = rows.select("id", drawn_bits(15, F.col("id"), epoch).alias("d")).collect()
        order = [r["id"] for r in sorted(drawn, key=lambda r: (r["d"], r["id"]))]
        slots = math.ceil(len(order) / shards)
        order += order[: slots * shards - len(order)]
        local = batch_rows // shards
        loss = 0.0
        for first in range(0, slots - local + 1 if drop_last else slots, local):
            parts = []
            for shard in range(shards):
                mine = [order[s * shards + shard] for s in range(first, min(first + local, slots))]
                x, y = np.stack([data[i][0] for i in mine]), np.array([data[i][1] for i in mine])
                gradient, part_loss, _ = net.backward(x, y, np.full(len(mine), 1 / len(mine)))
                parts.append(gradient)
                loss += part_loss
            net = network.Network(net.layers, optimiser.move(net.weights, sum(parts) / shards))
        told.append(loss)
    return net, told


@pytest.mark.parametrize(
    "optimiser, batch_rows, shards, drop_last",
    [(network.Descent(0.3, 0.5), 64, 4, False), (network.Adam(0.02), 60, 3, True), (network.Descent(0.2), 1000, 2, False)],
)
def test_training_matches_a_plain_loop(spark, rows, optimiser, batch_rows, shards, drop_last):
    start = network.Training(network.Network.drawn(LAYERS), optimiser)
    want, told = plain(rows, start, 2, batch_rows, shards, drop_last)
    got = network.train(rows, "f", "y", "id", start, 2, batch_rows, shards, drop_last)
    assert np.allclose(got.network.weights, want.weights, atol=1e-10)
    assert [r["loss"] for r in got.losses(spark).orderBy("epoch").collect()] == pytest.approx(told)
    if not drop_last:  # two times one epoch, over another layout, are two epochs
        once = network.train(rows.repartition(2), "f", "y", "id", start, 1, batch_rows, shards)
        twice = network.train(rows.coalesce(1), "f", "y", "id", once, 1, batch_rows, shards)
        assert np.allclose(twice.network.weights, want.weights, atol=1e-10) and len(twice.history) == 2


def test_training_learns_and_the_loss_agrees_with_the_aggregate(spark, rows):
    start = network.Training(network.Network.drawn((3, 16, 3)), network.Adam(0.05))
    done = network.train(rows, "f", "y", "id", start, 8, batch_rows=64, shards=2)
    losses = [h[1] for h in done.history]
    assert losses[-1] < 0.6 * losses[0] and done.history[-1][3] / done.history[-1][2] > 0.8
    # A step that does not move leaves the loss of the whole table.
    still = network.train(rows, "f", "y", "id", network.Training(done.network, network.Descent(0.0)), 1, batch_rows=64, shards=1)
    logits = rows.withColumn("z", done.network.logits(F.col("f")))
    assert epoch_loss(logits, F.lit(0), "z", "y").first()["loss"] == pytest.approx(still.history[0][1])


@pytest.mark.parametrize("fan_in", [2, 3, 32])
def test_gradients_are_summed_in_a_tree(spark, fan_in):
    sums = [(i, np.array([i, 2.0 * i, -1.0]).tobytes(), float(i), i, 1) for i in range(23) if i != 5]
    frame = spark.createDataFrame(sums, "part int, gradient binary, loss double, rows long, right long").repartition(4)
    gradient, loss, rows, right = network.tree_sum(frame, 23, fan_in)
    assert gradient.tolist() == [248.0, 496.0, -22.0] and (loss, rows, right) == (248.0, 248, 22)
    assert network.tree_sum(frame.limit(0), 23, fan_in) is None


def test_rows_that_do_not_fit_are_left_out(spark):
    odd = [(1, [1.0, 2.0], 0), (2, None, 1), (3, [1.0], 1), (4, [1.0, None], 1), (5, [0.0, 1.0], 7), (6, [0.0, 1.0], None), (7, [3.0, 1.0], 1)]
    frame = spark.createDataFrame(odd, "id long, f array<double>, y int")
    done = network.train(frame, "f", "y", "id", network.Training(network.Network.drawn((2, 2)), network.Descent(0.1)), 1, 10)
    assert done.history[0][2] == 2
    logits = {r["id"]: r["z"] for r in frame.withColumn("z", done.network.logits(F.col("f"))).collect()}
    assert logits[2] is None and logits[3] is None and len(logits[1]) == 2
    nothing = network.train(frame.limit(0), "f", "y", "id", network.Training(done.network, network.Descent(0.1)), 1, 10)
    assert nothing.history == [(0, 0.0, 0, 0)] and (nothing.network.weights == done.network.weights).all()
