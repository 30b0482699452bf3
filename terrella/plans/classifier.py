"""Training and judging a boosted-tree classifier on labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.learning.models import fit_boosted, labelled_features, predict_margin
from terrella.learning.splits import split_seeded
from terrella.operators.metrics import (
    accuracy,
    classification_report,
    confusion_matrix,
    roc_auc,
    sensitivity_specificity,
)
from terrella.operators.partitions import keep, pin


def scored_validation(
    rows: DataFrame,
    label: str,
    keys: Sequence[str],
    test_share: float = 0.33,
    seed: int = 42,
    **training,
) -> DataFrame:
    """Fit on the training part and score the validation part; the scores are kept, the parts released."""
    train, valid = split_seeded(rows, keys, test_share, seed)
    train = pin(labelled_features(train.drop(*keys), label))
    valid = pin(labelled_features(valid.drop(*keys), label))
    model, _ = fit_boosted(train, valid, label, **training)
    scored = keep(predict_margin(model, valid).select(label, "margin", "probability_1", "label_1"), "scored")
    train.unpersist()
    valid.unpersist()
    return scored


def quality_table(scored: DataFrame, label: str) -> DataFrame:
    """Accuracy, sensitivity, specificity and AUC as rows (metric, value)."""
    predicted, actual = F.col("label_1"), F.col(label)
    parts = [
        accuracy(scored, predicted, actual),
        sensitivity_specificity(scored, predicted, actual),
        roc_auc(scored, "probability_1", label).withColumnRenamed("auc", "roc_auc"),
    ]
    tables = [
        part.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in part.columns]))
        )
        for part in parts
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def full_report(scored: DataFrame, label: str) -> dict[str, DataFrame]:
    predicted, actual = F.col("label_1"), F.col(label)
    return {
        "quality": quality_table(scored, label),
        "confusion": confusion_matrix(scored, predicted, actual),
        "classes": classification_report(scored, predicted, actual),
    }
