"""A feed-forward classifier with ReLU units, trained in bulk-synchronous steps.

Every epoch deals the rows to shards in a new order and cuts the shards into
batches. A step reads one batch: each task runs forward and backward over its
Arrow batches and adds up one gradient; gradients are summed in a tree, and the
optimiser moves the weights on the driver, whose size is that of the layers
alone. A row weighs one over the rows of its shard in the batch and the number
of shards, which is the mean of the shards' mean gradients.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.operators.reduction import FAN_IN, reduce_in_tree
from terrella.operators.windows import epoch_shards
from terrella.session import scratch_path

#: Rows of a batch in one file, and so in one task.
FILE_ROWS = 100_000


@dataclass
class Network:
    """Weights of all layers in one vector: per layer the matrix row by row, then the biases."""

    layers: tuple[int, ...]
    weights: np.ndarray

    @staticmethod
    def drawn(layers: Sequence[int], seed: int = 7) -> Network:
        """Normal weights of variance 2 over the layer's inputs; no biases."""
        rng = np.random.default_rng(seed)
        parts = []
        for wide, out in zip(layers, layers[1:]):
            parts += [rng.normal(0, np.sqrt(2 / wide), wide * out), np.zeros(out)]
        return Network(tuple(layers), np.concatenate(parts))

    def parts(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Matrix and biases of each layer, as views."""
        found, at = [], 0
        for wide, out in zip(self.layers, self.layers[1:]):
            end = at + wide * out
            found.append((self.weights[at:end].reshape(wide, out), self.weights[end : end + out]))
            at = end + out
        return found

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        """What goes into each layer, and the logits."""
        seen, parts = [x], self.parts()
        for i, (matrix, bias) in enumerate(parts):
            x = x @ matrix + bias
            if i < len(parts) - 1:
                x = np.maximum(x, 0.0)
            seen.append(x)
        return seen

    def backward(self, x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float, int]:
        """Gradient of the weighted cross-entropy, the plain sum of it, and how many rows are predicted right."""
        seen = self.forward(x)
        logits = seen[-1] - seen[-1].max(axis=1, keepdims=True)
        scale = np.log(np.exp(logits).sum(axis=1, keepdims=True))
        rows = np.arange(len(label))
        loss = float((scale[:, 0] - logits[rows, label]).sum())
        right = int((logits.argmax(axis=1) == label).sum())
        error = np.exp(logits - scale)
        error[rows, label] -= 1.0
        error *= weight[:, None]
        gradients = []
        for (matrix, _), inputs in zip(reversed(self.parts()), reversed(seen[:-1])):
            gradients = [(inputs.T @ error).ravel(), error.sum(axis=0), *gradients]
            error = (error @ matrix.T) * (inputs > 0)
        return np.concatenate(gradients), loss, right

    def logits(self, features: Column) -> Column:
        """Logits of an array of features; null where there are not as many as inputs."""
        network = self

        @F.pandas_udf("array<double>")
        def score(rows: pd.Series) -> pd.Series:
            fits = [i for i, r in enumerate(rows) if r is not None and len(r) == network.layers[0]]
            out = [None] * len(rows)
            if fits:
                for i, logits in zip(fits, network.forward(np.stack(rows.iloc[fits].to_list()))[-1]):
                    out[i] = logits
            return pd.Series(out, dtype=object)

        return score(features.cast("array<double>"))


@dataclass
class Descent:
    """Steps down the gradient, with momentum."""

    rate: float
    momentum: float = 0.0
    speed: np.ndarray | None = None

    def move(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.speed = gradient if self.speed is None else self.momentum * self.speed + gradient
        return weights - self.rate * self.speed


@dataclass
class Adam:
    """Steps scaled by running means of the gradient and of its square."""

    rate: float = 1e-3
    keep_mean: float = 0.9
    keep_square: float = 0.999
    steps: int = 0
    mean: np.ndarray | None = None
    square: np.ndarray | None = None

    def move(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        if self.mean is None:
            self.mean, self.square = np.zeros_like(weights), np.zeros_like(weights)
        self.steps += 1
        self.mean = self.keep_mean * self.mean + (1 - self.keep_mean) * gradient
        self.square = self.keep_square * self.square + (1 - self.keep_square) * gradient**2
        mean = self.mean / (1 - self.keep_mean**self.steps)
        square = self.square / (1 - self.keep_square**self.steps)
        return weights - self.rate * mean / (np.sqrt(square) + 1e-8)


@dataclass
class Training:
    """All that a training needs to go on: the network, the optimiser and (epoch, loss, rows, right) of past epochs."""

    network: Network
    optimiser: Descent | Adam
    history: list[tuple[int, float, int, int]] = field(default_factory=list)

    def losses(self, spark: SparkSession) -> DataFrame:
        """Total cross-entropy and share of right predictions of each epoch, as its steps met the rows."""
        rows = [(e, loss, n, right / n if n else None) for e, loss, n, right in self.history]
        return spark.createDataFrame(rows, "epoch int, loss double, rows long, accuracy double")


def tree_sum(sums: DataFrame, tasks: int, fan_in: int = FAN_IN) -> tuple[np.ndarray, float, int, int] | None:
    """Sum of rows (part, gradient, loss, rows, right), ``fan_in`` at a time; parts count up to ``tasks``.

    Rows are added in the order of their parts. What comes to the driver are ``fan_in`` rows at most.
    """

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b, np.float64) for b in table["gradient"].to_pylist()], axis=0)
        cells = [0, total.tobytes(), *(sum(table[c].to_pylist()) for c in ("loss", "rows", "right"))]
        return pa.Table.from_arrays([pa.array([c], f.type) for c, f in zip(cells, table.schema)], schema=table.schema)

    found = reduce_in_tree(sums.select("part", "gradient", "loss", "rows", "right"), tasks, add, fan_in)
    if found is None:
        return None
    gradient, loss, rows, right = (found[c][0].as_py() for c in ("gradient", "loss", "rows", "right"))
    return np.frombuffer(gradient, np.float64), loss, rows, right


def batch_gradient(rows: DataFrame, network: Network) -> tuple[np.ndarray, float, int, int] | None:
    """Gradient, loss, rows and right predictions over rows (features, label, weight)."""
    kinds = "part int, gradient binary, loss double, rows long, right long"

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            gradient, loss, right = network.backward(x, batch.column("label").to_numpy(), batch.column("weight").to_numpy())
            new = gradient, loss, batch.num_rows, right
            total = new if total is None else tuple(a + b for a, b in zip(total, new))
        if total is not None:
            cells = ([part], [total[0].tobytes()], *([x] for x in total[1:]))
            types = (pa.int32(), pa.binary(), pa.float64(), pa.int64(), pa.int64())
            names = ["part", "gradient", "loss", "rows", "right"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names)

    numbered = rows.select("features", "label", "weight", F.spark_partition_id().alias("part"))
    return tree_sum(numbered.mapInArrow(over, kinds), rows.rdd.getNumPartitions())


def _dealt(rows: DataFrame, id_column: str, epoch: int, shards: int, batch_rows: int, drop_last: bool) -> tuple[str, list[int]]:
    """Write an epoch's batches, a folder each; returns the path and the numbers of the batches."""
    spark = rows.sparkSession
    dealt = epoch_shards(rows, id_column, epoch, shards)
    # Shards are equally long, so all have the same share of a batch.
    slots = -(-rows.count() // shards)
    local = max(batch_rows // shards, 1)
    count = slots // local if drop_last else -(-slots // local)
    batch = F.floor(F.col("slot") / local).cast("int")
    size = F.least(F.lit(local), slots - batch * local)
    files = -(-local * shards // FILE_ROWS)
    path = scratch_path(spark, "epoch")
    cut = dealt.filter(batch < count).select("features", "label", (1.0 / (size * shards)).alias("weight"), batch.alias("batch"), "slot")
    spread = cut.repartition("batch", F.pmod(F.col("slot"), F.lit(files)))
    spread.drop("slot").write.partitionBy("batch").parquet(path)
    return path, list(range(count))


def train(
    df: DataFrame,
    features: str,
    label: str,
    id_column: str,
    start: Training,
    epochs: int,
    batch_rows: int = 1024,
    shards: int = 1,
    drop_last: bool = False,
) -> Training:
    """``start`` trained for some more epochs.

    ``features`` is an array as long as the first layer is wide, ``label`` a
    class from 0; other rows are left out. ``batch_rows`` counts a batch over
    all shards. Epochs are numbered on from those ``start`` has seen, and their order depends on the number and the ids
    only: training twice for two epochs is training once for four. To make the
    last batches as long as the others, shards repeat rows from the start of
    the order until they are equally long; ``drop_last`` leaves a short last
    batch out.
    """
    network, optimiser, history = start.network, copy.deepcopy(start.optimiser), list(start.history)
    rows = df.select(F.col(id_column), F.col(features).cast("array<double>").alias("features"), F.col(label).cast("long").alias("label"))
    inputs, classes = network.layers[0], network.layers[-1]
    usable = (F.size("features") == inputs) & F.col("label").between(0, classes - 1) & ~F.exists("features", lambda x: x.isNull())
    rows = rows.filter(usable).persist()
    spark = df.sparkSession
    schema = "features array<double>, label long, weight double"
    for epoch in range(len(history), len(history) + epochs):
        path, batches = _dealt(rows, id_column, epoch, shards, batch_rows, drop_last)
        loss, seen, right = 0.0, 0, 0
        for batch in batches:
            found = batch_gradient(spark.read.schema(schema).parquet(f"{path}/batch={batch}"), network)
            network = Network(network.layers, optimiser.move(network.weights, found[0]))
            loss, seen, right = loss + found[1], seen + found[2], right + found[3]
        history.append((epoch, loss, seen, right))
    rows.unpersist()
    return Training(network, optimiser, history)
