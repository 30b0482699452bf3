"""Boosted trees grown from gradients and hessians of any objective.

The objective and the measure are functions of the user on arrays of margins
and labels. Features are cut into bins once, at borders from one mergeable
sketch per feature. A round grows one tree, a level a pass: each task adds up
gradients, hessians and rows per (node, feature, bin) of its batches, one
aggregate adds up the tasks, and windows along the bins find the best split of
each node, so that only splits come to the driver. The first pass of a round
also measures the model so far, which is when the stop rule is asked.

Margins travel with the rows. Trees since the last checkpoint are added on the
fly; every few rounds the margins are written to the shared folder, so that a
lost executor costs a few rounds at most and no round is ever trained again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.operators.partitions import keep

#: (margins, labels) to (gradients, hessians), and to a loss per row.
Objective = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
Measure = Callable[[np.ndarray, np.ndarray], np.ndarray]

#: Features sketched in one pass, and the sketch's accuracy (ranks are off by rows / accuracy at most).
SKETCHED, ACCURACY = 256, 10_000
_STATE = "bins binary, label double, margin double, held_out boolean"
_SUMS = "node int, feature int, bin int, g double, h double, n long"


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-loss of labels 0 and 1; the margin is the log-odds."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return p - label, p * (1.0 - p)


def squared(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half the squared error."""
    return margin - label, np.ones_like(margin)


def wrong_label(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    """1 for a wrong label, 0 for a right one; a margin of 0 says 0."""
    return np.where(margin > 0, 1.0 - label, label)


def bin_borders(df: DataFrame, features: str, width: int, bins: int) -> list[np.ndarray]:
    """Distinct quantiles of each feature, nulls and NaN left aside; ``bins - 1`` at most."""
    shares = [i / bins for i in range(1, bins)]
    borders = []
    for first in range(0, width, SKETCHED):
        some = range(first, min(first + SKETCHED, width))
        values = [F.get(features, j).cast("double") for j in some]
        sketches = [F.percentile_approx(F.nanvl(v, F.lit(None).cast("double")), shares, ACCURACY) for v in values]
        row = df.agg(*[s.alias(f"f{j}") for j, s in zip(some, sketches)]).first()
        borders += [np.unique(np.array(row[f"f{j}"] or [], np.float64)) for j in some]
    return borders


def _codes(values: np.ndarray, borders: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value: 0 for a missing one, else 1 plus the borders below it."""
    codes = np.empty(values.shape, np.uint16)
    for j, cuts in enumerate(borders):
        column = values[:, j]
        codes[:, j] = np.where(np.isnan(column), 0, 1 + np.searchsorted(cuts, column, side="left"))
    return codes


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of an array column; what a row lacks is missing, and so are nulls."""
    starts = column.offsets.to_numpy()
    flat = np.append(column.values.to_numpy(zero_copy_only=False).astype(np.float64), np.nan)
    places = starts[:-1, None] + np.arange(width)
    held = places < starts[1:, None]
    if column.null_count:
        held &= ~np.asarray(column.is_null())[:, None]
    return np.where(held, flat[np.minimum(places, len(flat) - 1)], np.nan)


@dataclass
class Tree:
    """A tree as arrays over heap places: children of i are 2i + 1 (bin of the feature at most ``bin``) and 2i + 2."""

    depth: int
    feature: np.ndarray = field(default=None)
    bin: np.ndarray = field(default=None)
    value: np.ndarray = field(default=None)
    gain: np.ndarray = field(default=None)
    rows: np.ndarray = field(default=None)

    def __post_init__(self):
        places = (2 << self.depth) - 1
        for name, kind, empty in (
            ("feature", np.int32, -1), ("bin", np.int32, 0), ("value", np.float64, 0), ("gain", np.float64, 0), ("rows", np.int64, 0),
        ):
            if getattr(self, name) is None:
                setattr(self, name, np.full(places, empty, kind))

    def place(self, codes: np.ndarray, levels: int | None = None) -> np.ndarray:
        """Where rows stand after some levels; leaves keep theirs."""
        at = np.zeros(len(codes), np.int64)
        every = np.arange(len(codes))
        for _ in range(self.depth if levels is None else levels):
            split = self.feature[at]
            right = codes[every, np.maximum(split, 0)] > self.bin[at]
            at = np.where(split >= 0, 2 * at + 1 + right, at)
        return at


def _add_trees(margin: np.ndarray, codes: np.ndarray, trees: Sequence[Tree], rate: float) -> np.ndarray:
    for tree in trees:
        margin = margin + rate * tree.value[tree.place(codes)]
    return margin


@dataclass
class BoostedTrees:
    """A trained model: borders of the bins, trees, learning rate and the margin it starts from."""

    borders: list[np.ndarray]
    trees: list[Tree]
    rate: float
    base: float = 0.0

    def first_rounds(self, rounds: int) -> BoostedTrees:
        return BoostedTrees(self.borders, self.trees[:rounds], self.rate, self.base)

    def margin(self, features: Column) -> Column:
        """Margin of an array of features; nulls, NaN and absent ones are missing values."""
        borders, trees, rate, base = self.borders, self.trees, self.rate, self.base

        @F.pandas_udf("double")
        def score(rows: pd.Series) -> pd.Series:
            values = _matrix(pa.array(rows, pa.list_(pa.float64())), len(borders))
            return pd.Series(_add_trees(np.full(len(values), base), _codes(values, borders), trees, rate))

        return score(features.cast("array<double>"))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """All nodes: (tree, node, feature, bin, border, gain, value, rows); leaves have no feature, bin and border.

        Bin 0 has no border: only missing values go left.
        """
        found = []
        for number, tree in enumerate(self.trees):
            for i in np.flatnonzero(tree.rows):
                f, b = int(tree.feature[i]), int(tree.bin[i])
                border = float(self.borders[f][b - 1]) if f >= 0 and b > 0 else None
                split = (f, b, border) if f >= 0 else (None, None, None)
                found.append((number, int(i), *split, float(tree.gain[i]), float(tree.value[i]), int(tree.rows[i])))
        kinds = "tree int, node int, feature int, bin int, border double, gain double, value double, rows long"
        return spark.createDataFrame(found, kinds)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write nodes and borders as tables."""
        depth = max((t.depth for t in self.trees), default=0)
        facts = [(float(self.rate), float(self.base), depth, len(self.trees), [b.tolist() for b in self.borders])]
        kinds = "rate double, base double, depth int, trees int, borders array<array<double>>"
        self.nodes(spark).coalesce(1).write.parquet(f"{path}/nodes")
        spark.createDataFrame(facts, kinds).coalesce(1).write.parquet(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        facts = spark.read.parquet(f"{path}/model").first()
        trees = [Tree(facts["depth"]) for _ in range(facts["trees"])]
        for row in spark.read.parquet(f"{path}/nodes").collect():
            tree, i = trees[row["tree"]], row["node"]
            tree.gain[i], tree.value[i], tree.rows[i] = row["gain"], row["value"], row["rows"]
            if row["feature"] is not None:
                tree.feature[i], tree.bin[i] = row["feature"], row["bin"]
        return BoostedTrees([np.array(b, np.float64) for b in facts["borders"]], trees, facts["rate"], facts["base"])


def _read(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    raw = batch.column("bins")
    start = raw.offset * width * 2
    codes = np.frombuffer(raw.buffers()[2], np.uint16, batch.num_rows * width, start).reshape(-1, width)
    return codes, *(batch.column(n).to_numpy(zero_copy_only=False) for n in ("label", "margin", "held_out"))


def _binned(df: DataFrame, features: str, borders: list[np.ndarray]) -> DataFrame:
    """Training state: the bins of a row's features as bytes, label, margin and whether the row is held out."""
    width = len(borders)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _codes(_matrix(batch.column("features"), width), borders)
            bins = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([bins, *(batch.column(i) for i in (1, 2, 3))], ["bins", "label", "margin", "held_out"])

    return df.mapInArrow(over, _STATE)


def _advanced(state: DataFrame, trees: Sequence[Tree], rate: float, width: int) -> DataFrame:
    """The state with trees added to its margins."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes, _, margin, _ = _read(batch, width)
                moved = pa.array(_add_trees(margin, codes, trees, rate))
                yield batch.set_column(2, "margin", moved)

    return state.mapInArrow(over, _STATE)


def _sums(
    state: DataFrame, tree: Tree, level: int, pending: Sequence[Tree], rate: float, objective: Objective,
    measure: Measure | None, width: int, bins: int,
) -> DataFrame:
    """Sums per (node, feature, bin) of one level, a row per task and sum.

    Node -1 holds the measure: bin 1 of rows held out, bin 0 of the others.
    """
    first, nodes = (1 << level) - 1, 1 << level

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (width, nodes * bins)
        g, h, n = np.zeros(shape), np.zeros(shape), np.zeros(shape, np.int64)
        loss, seen = np.zeros(2), np.zeros(2, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, label, margin, held = _read(batch, width)
            margin = _add_trees(margin, codes, pending, rate)
            if measure is not None:
                losses, group = np.asarray(measure(margin, label), np.float64), held.astype(np.int64)
                loss += np.bincount(group, losses, 2)
                seen += np.bincount(group, minlength=2)
            place = tree.place(codes, level) - first
            grown = ~held.astype(bool) & (place >= 0)
            codes, place = codes[grown], place[grown]
            gradient, hessian = objective(margin[grown], label[grown])
            for j in range(width):
                slot = place * bins + codes[:, j]
                g[j] += np.bincount(slot, gradient, nodes * bins)
                h[j] += np.bincount(slot, hessian, nodes * bins)
                n[j] += np.bincount(slot, minlength=nodes * bins)
        feature, slot = np.nonzero(n)
        told = np.flatnonzero(seen)
        columns = (
            np.r_[slot // bins + first, np.full(len(told), -1)], np.r_[feature, np.zeros(len(told), np.int64)],
            np.r_[slot % bins, told], np.r_[g[feature, slot], loss[told]], np.r_[h[feature, slot], np.zeros(len(told))],
            np.r_[n[feature, slot], seen[told]],
        )
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)], ["node", "feature", "bin", "g", "h", "n"])

    return state.mapInArrow(over, _SUMS)


# As text, since building it anew for every pass call by call takes longer than running it. All features have the
# same totals but for rounding: those of the first one count.
_BEST = """
WITH added AS (SELECT node, feature, bin, sum(g) AS g, sum(h) AS h, sum(n) AS n FROM {sums} GROUP BY node, feature, bin),
  sided AS (SELECT *, sum(g) OVER w AS left_g, sum(h) OVER w AS left_h, sum(n) OVER w AS left_n,
      sum(g) OVER a AS all_g, sum(h) OVER a AS all_h, sum(n) OVER a AS all_n
    FROM added WINDOW w AS (PARTITION BY node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY node, feature)),
  scored AS (SELECT *, node >= 0 AND left_n < all_n AND least(left_h, all_h - left_h) >= :least AS allowed,
      (coalesce(try_divide(left_g * left_g, left_h + :penalty), 0D)
       + coalesce(try_divide((all_g - left_g) * (all_g - left_g), all_h - left_h + :penalty), 0D)
       - coalesce(try_divide(all_g * all_g, all_h + :penalty), 0D)) / 2D AS gain FROM sided)
SELECT node, min(struct(feature, all_g)).all_g AS g, min(struct(feature, all_h)).all_h AS h, min(struct(feature, all_n)).all_n AS n,
  max(CASE WHEN allowed THEN struct(gain, -feature AS feature, -bin AS bin, left_g, left_h, left_n) END) AS best,
  sum(CASE WHEN bin = 0 THEN g END) AS loss_0, sum(CASE WHEN bin = 0 THEN n END) AS seen_0,
  sum(CASE WHEN bin = 1 THEN g END) AS loss_1, sum(CASE WHEN bin = 1 THEN n END) AS seen_1
FROM scored GROUP BY node
"""


def best_splits(sums: DataFrame, penalty: float, least_hessian: float) -> DataFrame:
    """Best split of each node from sums per (node, feature, bin).

    (node, g, h, n, best, and loss and seen of the rows held out and of the
    others in node -1). ``best`` has the gain, the feature, the bin, and g, h
    and n of the left side; it is null if no split has rows on both sides and a
    hessian of ``least_hessian``. Of equal gains the first feature and bin win.
    """
    return sums.sparkSession.sql(
        _BEST, args={"penalty": float(penalty), "least": float(least_hessian)}, sums=sums.repartition("node", "feature")
    )


def _grow(tree: Tree, level: int, found: dict, penalty: float, least_gain: float) -> bool:
    """Put the splits of one level into a tree, and values into what can be leaves; whether any node was split."""
    value = lambda g, h: -g / (h + penalty) if h + penalty > 0 else 0.0
    split = False
    for node, row in found.items():
        tree.rows[node], tree.value[node] = row["n"], value(row["g"], row["h"])
        best = row["best"]
        if best is None or not best["gain"] > least_gain:
            continue
        split = True
        tree.feature[node], tree.bin[node], tree.gain[node] = -best["feature"], -best["bin"], best["gain"]
        sides = (best["left_g"], best["left_h"], best["left_n"]), (
            row["g"] - best["left_g"], row["h"] - best["left_h"], row["n"] - best["left_n"],
        )
        for child, (g, h, n) in zip((2 * node + 1, 2 * node + 2), sides):
            tree.value[child], tree.rows[child] = value(g, h), n
    return split


def fit_trees(
    df: DataFrame,
    features: str,
    label: str,
    objective: Objective = logistic,
    measure: Measure = wrong_label,
    held_out: Column | None = None,
    margin: str | None = None,
    start: BoostedTrees | None = None,
    rounds: int = 2000,
    patience: int = 10,
    depth: int = 3,
    rate: float = 0.3,
    penalty: float = 1.0,
    least_gain: float = 0.0,
    least_hessian: float = 0.0,
    bins: int = 64,
    checkpoint_every: int = 10,
) -> tuple[BoostedTrees, list[float]]:
    """Boosted trees, cut after the best round, and the measure after each round.

    Rows for which ``held_out`` holds train nothing: the mean measure over them
    is taken after every round, and training ends once ``patience`` rounds have
    passed since the lowest. Without them the measure is that of the training
    rows and training ends after ``rounds``, or when nothing is left to split.

    ``margin`` names a column that the margins start from. ``start`` is a model
    that goes on: its trees stay, and its bins are used. Rows without label or margin are left
    out. Features are an array; nulls, NaN and absent ones are missing, and
    missing values stand below all others. At most ``2^depth`` splits a level and a
    sum per node, feature and bin are held by a task.
    """
    rows = df.select(
        F.col(features).cast("array<double>").alias("features"),
        F.col(label).cast("double").alias("label"),
        (F.col(margin).cast("double") if margin else F.lit(0.0)).alias("margin"),
        F.coalesce(held_out if held_out is not None else F.lit(False), F.lit(False)).alias("held_out"),
    ).filter("label IS NOT NULL AND margin IS NOT NULL")
    if start is not None:
        borders, trees = start.borders, list(start.trees)
        rate = start.rate
    else:
        train = rows.filter(~F.col("held_out"))
        width = train.agg(F.max(F.size("features"))).first()[0]
        if not width or width < 0:
            raise ValueError("no rows to train on")
        borders, trees = bin_borders(train, "features", width, bins), []
    width, codes = len(borders), max(map(len, borders), default=0) + 2
    state = keep(_binned(rows, "features", borders), "boosting")
    if start is not None:
        state = keep(_advanced(state, trees, rate, width), "boosting")
    kept, pending, history, best = len(trees), [], [], 0

    def measured(row: dict) -> float:
        if held_out is None:
            return row["loss_0"] / row["seen_0"]
        if not row["seen_1"]:
            raise ValueError("no rows are held out")
        return row["loss_1"] / row["seen_1"]

    def level_of(tree: Tree, level: int, measuring: bool) -> dict:
        sums = _sums(state, tree, level, pending, rate, objective, measure if measuring else None, width, codes)
        return {r["node"]: r.asDict(recursive=True) for r in best_splits(sums, penalty, least_hessian).collect()}

    for done in range(rounds + 1):
        tree = Tree(depth)
        for level in range(depth):
            found = level_of(tree, level, measuring=level == 0)
            if level == 0:
                now = measured(found.pop(-1))
                if done:
                    history.append(now)
                    best = best if best and history[best - 1] <= now else done
                if done == rounds or held_out is not None and done - best >= patience:
                    break
            if not _grow(tree, level, found, penalty, least_gain):
                break
        if done == rounds or held_out is not None and done - best >= patience:
            break
        if held_out is None and tree.feature[0] < 0 and done:
            break
        trees.append(tree)
        pending.append(tree)
        if len(pending) == checkpoint_every:
            state, pending = keep(_advanced(state, pending, rate, width), "boosting"), []
    rounds_kept = best if held_out is not None else len(trees) - kept
    return BoostedTrees(borders, trees[: kept + rounds_kept], rate), history
