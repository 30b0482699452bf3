"""Boosting from gradients and hessians, against a plain version of the same rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrella.learning import boosting
from terrella.learning.early_stop import early_stop_round
from terrella.sources import generators


@pytest.fixture(scope="module")
def table(spark):
    x = [generators.normal(F.col("id"), 21, i) for i in range(3)]
    rows = spark.range(600).select(
        "id",
        F.array(
            F.round(x[0], 1), F.when(F.col("id") % 7 == 0, None).otherwise(F.round(x[1] * 3)), F.when(F.col("id") % 11 == 0, float("nan")).otherwise(x[2])
        ).alias("f"),
        (x[0] + x[1] * x[1] + 0.7 * generators.normal(F.col("id"), 22) > 0.8).cast("int").alias("y"),
        (F.col("id") % 3 == 0).alias("test"),
        (x[2] / 4).alias("m"),
    )
    return rows.repartition(5).persist()


def plain(values, label, margin, objective, rounds, depth=3, rate=0.3, penalty=1.0, bins=64, ranks=None):
    """All margins after training on the rows ``ranks`` holds: every split is tried by brute force."""
    train = np.ones(len(label), bool) if ranks is None else ranks
    codes = np.zeros(values.shape, int)
    for j in range(values.shape[1]):
        known = np.sort(values[train & ~np.isnan(values[:, j]), j])
        cuts = {known[int(np.ceil(i / bins * len(known))) - 1] for i in range(1, bins)}
        codes[:, j] = [0 if np.isnan(v) else 1 + sum(c < v for c in cuts) for v in values[:, j]]
    score = lambda g, h: g.sum() ** 2 / (h.sum() + penalty)
    for _ in range(rounds):
        g, h = objective(margin, label)
        moved = margin.copy()

        def grow(rows, all_rows, level):
            own = rows & train
            best = (0.0, None)
            for j in range(values.shape[1]) if level < depth else ():
                for cut in sorted(set(codes[own, j]))[:-1]:
                    left = own & (codes[:, j] <= cut)
                    gain = score(g[left], h[left]) + score(g[own & ~left], h[own & ~left]) - score(g[own], h[own])
                    if gain > best[0] + 1e-9:
                        best = (gain, (j, cut))
            if best[1] is None:
                moved[all_rows] += rate * -g[own].sum() / (h[own].sum() + penalty)
                return
            j, cut = best[1]
            grow(rows & (codes[:, j] <= cut), all_rows & (codes[:, j] <= cut), level + 1)
            grow(rows & (codes[:, j] > cut), all_rows & (codes[:, j] > cut), level + 1)

        everything = np.ones(len(label), bool)
        grow(everything, everything, 0)
        margin = moved
    return margin


def columns(table, model=None, *extra):
    rows = table if model is None else table.withColumn("p", model.margin(F.col("f")))
    found = rows.orderBy("id").collect()
    values = np.array([[np.nan if v is None else v for v in r["f"]] for r in found], float)
    return values, np.array([r["y"] for r in found], float), *(np.array([r[c] for r in found], float) for c in extra)


@pytest.mark.parametrize("objective, depth", [(boosting.logistic, 3), (boosting.logistic, 1), (boosting.squared, 2)])
def test_trees_match_brute_force(table, objective, depth):
    model, history = boosting.fit_trees(table, "f", "y", objective, rounds=5, depth=depth, bins=16, checkpoint_every=2)
    values, label, got = columns(table, model, "p")
    want = plain(values, label, np.zeros(len(label)), objective, 5, depth, bins=16)
    assert np.allclose(got, want, atol=1e-9)
    assert history[-1] == pytest.approx(np.mean(boosting.wrong_label(want, label)))


def test_a_custom_objective_trains_on_held_in_rows_from_given_margins(table):
    def pull(margin, label):
        gradient, hessian = boosting.logistic(margin, label)
        return gradient * (1 + 2 * label), hessian * (1 + 2 * label)

    model, history = boosting.fit_trees(
        table, "f", "y", pull, lambda m, y: (m - y) ** 2, held_out=F.col("test"), margin="m", rounds=4, bins=16, patience=4
    )
    values, label, start, test, got = columns(table, model, "m", "test", "p")
    for i, measured in enumerate(history):
        want = plain(values, label, start, pull, i + 1, bins=16, ranks=test == 0)
        assert measured == pytest.approx(np.mean((want - label)[test == 1] ** 2))
    best = plain(values, label, start, pull, len(model.trees), bins=16, ranks=test == 0)
    assert np.allclose(start + got, best, atol=1e-9)


def test_one_training_stops_at_the_best_prefix(table, monkeypatch):
    passes = []
    sums = boosting._sums
    monkeypatch.setattr(boosting, "_sums", lambda *a: passes.append(a[2]) or sums(*a))
    model, history = boosting.fit_trees(table, "f", "y", held_out=F.col("test"), patience=3, rounds=50, depth=2)
    assert len(passes) <= 2 * len(history) + 1
    curve = [(0, i + 1, e) for i, e in enumerate(history)]
    chosen = early_stop_round(table.sparkSession.createDataFrame(curve, "run int, round int, metric double"), ["run"], 3).first()
    assert len(model.trees) == chosen["best_round"] and len(history) == chosen["last_round"]
    alone, _ = boosting.fit_trees(table.filter("not test"), "f", "y", rounds=len(model.trees), depth=2)
    assert np.allclose(columns(table, model, "p")[2], columns(table, alone, "p")[2], atol=1e-12)


def test_training_goes_on_from_a_model_and_from_disk(table, tmp_path):
    spark = table.sparkSession
    whole, _ = boosting.fit_trees(table, "f", "y", rounds=4, depth=2)
    half, _ = boosting.fit_trees(table, "f", "y", rounds=2, depth=2)
    half.save(spark, f"{tmp_path}/model")
    read = boosting.BoostedTrees.load(spark, f"{tmp_path}/model")
    assert (columns(table, read, "p")[2] == columns(table, half, "p")[2]).all()
    rest, _ = boosting.fit_trees(table, "f", "y", rounds=2, depth=2, start=read)
    assert len(rest.trees) == 4
    assert np.allclose(columns(table, rest, "p")[2], columns(table, whole, "p")[2], atol=1e-9)
    nodes = whole.nodes(spark)
    assert nodes.filter("node = 0").agg(F.min("rows"), F.max("rows")).first()[:] == (600, 600)
    inner = nodes.filter("feature is not null").alias("a").join(
        nodes.alias("b"), F.expr("a.tree = b.tree and b.node in (2 * a.node + 1, 2 * a.node + 2)")
    )
    assert inner.groupBy("a.tree", "a.node").agg((F.max("a.rows") - F.sum("b.rows")).alias("d")).filter("d != 0").count() == 0


def test_odd_rows(spark):
    rows = [(None, 1.0), ([], 0.0), ([1.0], 1.0), ([1.0, None, 5.0], 0.0), ([float("nan"), 2.0, 3.0], None), ([2.0, float("inf"), -1.0], 1.0)]
    frame = spark.createDataFrame(rows * 5, "f array<double>, y double")
    model, history = boosting.fit_trees(frame, "f", "y", rounds=3, depth=2)
    got = [r["p"] for r in frame.withColumn("p", model.margin(F.col("f"))).collect()]
    assert len(history) == 3 and all(np.isfinite(got)) and got[0] == got[1]
    same, _ = boosting.fit_trees(frame.select(F.col("f"), F.lit(1.0).alias("y")), "f", "y", rounds=5, depth=2)
    assert (same.nodes(spark).select("feature").distinct().collect()) == [(None,)]
    for bad in (frame.limit(0), frame.filter("y is null")):
        with pytest.raises(ValueError):
            boosting.fit_trees(bad, "f", "y", rounds=1)
    with pytest.raises(ValueError):
        boosting.fit_trees(frame, "f", "y", rounds=1, held_out=F.lit(False))


def test_many_features_are_sketched_in_parts(spark):
    rows = spark.range(200).select(
        F.transform(F.sequence(F.lit(0), F.lit(599)), lambda j: F.pmod(F.hash("id", j), F.lit(7)).cast("double")).alias("f"),
        (F.pmod(F.hash("id", F.lit(580)), F.lit(7)) > 3).cast("double").alias("y"),
    )
    model, _ = boosting.fit_trees(rows, "f", "y", rounds=1, depth=1)
    assert model.nodes(spark).filter("node = 0").first()["feature"] == 580
