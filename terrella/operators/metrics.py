"""Quality measures of predictions, all as distributed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrella.functions.numeric import sigmoid
from terrella.functions.vectors import cross_entropy, squared_distance
from terrella.operators.positions import CHUNK, quantile_chunks, running_offsets

#: Bytes of centers that reach every row as one value.
CENTER_BYTES = 8 << 20


def regression_error(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Mean squared error and its root."""
    gap = F.col(predicted) - F.col(actual)
    mse = F.avg(gap * gap)
    return df.agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"))


def accuracy(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    return df.agg(F.avg((predicted == actual).cast("int")).alias("accuracy"))


def confusion_matrix(
    df: DataFrame, predicted: Column, actual: Column, labels: Sequence[int] = (0, 1)
) -> DataFrame:
    """Rows (actual, predicted, n) for every pair of labels, empty cells included.

    Labels are the given ones and all that occur on either side. Rows without a
    label or prediction have cells of their own, if there are any.
    """
    seen = df.groupBy(actual.alias("actual"), predicted.alias("predicted")).agg(
        F.count("*").alias("n")
    )
    found = F.array_union(F.collect_set("actual"), F.collect_set("predicted"))
    every = seen.agg(F.array_union(F.array(*[F.lit(x) for x in labels]), found).alias("labels"))
    grid = every.select("labels", F.explode("labels").alias("actual"))
    grid = grid.select("actual", F.explode("labels").alias("predicted"))
    filled = grid.join(seen, ["actual", "predicted"], "left")
    blank = seen.filter(F.col("actual").isNull() | F.col("predicted").isNull())
    return filled.select("actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")).unionByName(blank)


def _share_or_zero(part: Column, whole: Column) -> Column:
    return F.when(part == 0, F.lit(0.0)).otherwise(part / whole)


def sensitivity_specificity(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """TP / (TP + FN) and TN / (TN + FP) to five decimals, 0.0 without any hit."""
    hit = df.agg(
        F.count_if((actual == 1) & (predicted == 1)).alias("tp"),
        F.count_if((actual == 1) & (predicted == 0)).alias("fn"),
        F.count_if((actual == 0) & (predicted == 0)).alias("tn"),
        F.count_if((actual == 0) & (predicted == 1)).alias("fp"),
    )
    tp, fn, tn, fp = (F.col(c) for c in ("tp", "fn", "tn", "fp"))
    return hit.select(
        F.round(_share_or_zero(tp, tp + fn), 5).alias("sensitivity"),
        F.round(_share_or_zero(tn, tn + fp), 5).alias("specificity"),
    )


def classification_report(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and both averages.

    The accuracy row carries the accuracy in all three measures.
    """
    cells = df.groupBy(actual.alias("a"), predicted.alias("p")).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("long")
    right = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("a").alias("c"), right.alias("tp"), zero.alias("np"), F.col("n").alias("ns")),
        F.struct(F.col("p").alias("c"), zero.alias("tp"), F.col("n").alias("np"), zero.alias("ns")),
    )
    per_class = (
        cells.select(F.inline(sides))
        .groupBy("c")
        .agg(*[F.sum(x).alias(x) for x in ("tp", "np", "ns")])
        .withColumn("precision", _share_or_zero(F.col("tp"), F.col("np")))
        .withColumn("recall", _share_or_zero(F.col("tp"), F.col("ns")))
        .withColumn("f1", _share_or_zero(F.col("tp") * 2.0, F.col("np") + F.col("ns")))
    )
    measures = ("precision", "recall", "f1")
    support = F.sum("ns")
    hits = F.sum("tp") / support
    summary = per_class.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("label"), *[hits.alias(m) for m in measures], support.alias("support")),
            F.struct(F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in measures], support.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *[(F.sum(F.col(m) * F.col("ns")) / support).alias(m) for m in measures],
                support.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    classes = per_class.select(F.col("c").cast("string").alias("label"), *measures, F.col("ns").alias("support"))
    return classes.unionByName(summary)


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve; equal scores count half.

    Scores are first reduced to one row per distinct value. The negatives below
    each score are a running sum, taken over quantile ranges of the score.
    """
    ranged = quantile_chunks(df.select(F.col(score).alias("s"), F.col(label).alias("y")), "s")
    per_score = ranged.groupBy(CHUNK, "s").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    offsets = running_offsets(per_score.groupBy(CHUNK).agg(F.sum("neg").alias("neg")), "neg")
    earlier = Window.partitionBy(CHUNK).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(earlier), F.lit(0)) + F.col("_before")
    ranked = per_score.join(F.broadcast(offsets), CHUNK).withColumn("below", below)
    won = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(won, pairs).alias("auc"))


def margin_error(df: DataFrame, margin: str, label: str) -> DataFrame:
    """Share of rows whose margin falls on the wrong side of probability one half."""
    positive = sigmoid(F.col(margin)) > 0.5
    wrong = F.when(positive, 1 - F.col(label)).otherwise(F.col(label))
    return df.agg(F.avg(wrong).alias("error"))


def logistic_derivatives(df: DataFrame, margin: str, label: str) -> DataFrame:
    """Add gradient and second derivative of the logistic loss at each margin."""
    p = sigmoid(F.col(margin))
    return df.withColumns({"grad": p - F.col(label), "hess": p * (1.0 - p)})


def class_means(df: DataFrame, vector: str, label: str, width: int) -> DataFrame:
    """Mean vector of each class."""
    means = ", ".join(f"avg(cast({vector}[{j}] as double))" for j in range(width))
    return df.groupBy(label).agg(F.expr(f"array({means})").alias("center"))


def nearest_center(
    df: DataFrame, vector: str, centers: DataFrame, center: str = "center", max_bytes: int = CENTER_BYTES
) -> DataFrame:
    """Add ``distance2``, the squared distance to the nearest center.

    Centers of at most ``max_bytes``, which is measured, reach the rows as one
    array value. More of them come in blocks of that size, each a function over Arrow
    batches; all blocks meet the rows in one scan.
    """
    known = centers.filter(F.col(center).isNotNull())
    count, width = known.agg(F.count("*"), F.coalesce(F.max(F.size(center)), F.lit(0))).first()
    blocks = max(1, -(-count * width * 8 // max_bytes))
    if blocks == 1:
        all_centers = known.agg(F.array_sort(F.collect_list(center)).alias("centers"))
        with_centers = df.withColumn("_centers", all_centers.scalar())
        gaps = F.transform("_centers", lambda c: squared_distance(F.col(vector), c))
        return with_centers.withColumn("distance2", F.array_min(gaps)).drop("_centers")
    found = []
    dealt = known.withColumn("_block", F.pmod(F.xxhash64(center), F.lit(blocks)))
    for block in range(blocks):
        some = [r[0] for r in dealt.filter(F.col("_block") == block).select(center).collect()]
        if some:
            found.append(_gap_to(np.array(some, np.float64))(F.col(vector)))
    return df.withColumn("distance2", F.least(*found) if len(found) > 1 else found[0])


def _gap_to(block: np.ndarray):
    """A function of vectors: the squared distance to the nearest of a block of centers."""
    norms = (block * block).sum(axis=1)

    @F.pandas_udf("double")
    def gap(rows: pd.Series) -> pd.Series:
        held = [i for i, r in enumerate(rows) if r is not None]
        out = np.full(len(rows), np.nan)
        for first in range(0, len(held), 1024):
            some = held[first : first + 1024]
            x = np.stack(rows.iloc[some].to_list()).astype(np.float64)
            nearest = (norms - 2.0 * x @ block.T).argmin(axis=1)
            out[some] = ((x - block[nearest]) ** 2).sum(axis=1)
        return pd.Series(out).where(~np.isnan(out), None)

    return gap


def inertia(df: DataFrame, vector: str, centers: DataFrame, center: str = "center") -> DataFrame:
    """Sum of squared distances to the nearest center."""
    return nearest_center(df, vector, centers, center).agg(F.sum("distance2").alias("inertia"))


def epoch_loss(df: DataFrame, epoch: Column, logits: str, label: str) -> DataFrame:
    """Total cross-entropy per epoch."""
    loss = cross_entropy(F.col(logits), F.col(label))
    return df.groupBy(epoch.alias("epoch")).agg(F.sum(loss).alias("loss"))
