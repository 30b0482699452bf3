"""Queries for quality measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrella.catalog.registry import query
from terrella.operators import metrics as ops
from terrella.plans.views import with_views

_SCORED = with_views("scored")
_LABELLED = _SCORED + ", l AS (SELECT y, CASE WHEN score > 5e-1 THEN 1 ELSE 0 END AS p FROM scored) "


def _predicted():
    return (F.col("score") > 0.5).cast("int")


@query(
    "metric_rmse",
    _SCORED + " SELECT round(avg(power(score - y, 2)), 6) AS mse, round(sqrt(avg(power(score - y, 2))), 6) AS rmse FROM scored",
)
def metric_rmse(t):
    error = ops.regression_error(t.scored, "score", "y")
    return error.select(F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"))


@query("metric_accuracy", _LABELLED + "SELECT round(avg(CASE WHEN p = y THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM l")
def metric_accuracy(t):
    return ops.accuracy(t.scored, _predicted(), F.col("y")).select(F.round("accuracy", 6).alias("accuracy"))


@query(
    "metric_confusion",
    _LABELLED
    + """, g AS (SELECT a.y AS actual, b.y AS predicted FROM (VALUES (0), (1)) a(y), (VALUES (0), (1)) b(y))
      SELECT actual, predicted, count(l.y) AS n FROM g LEFT JOIN l ON l.y = actual AND l.p = predicted GROUP BY 1, 2""",
)
def metric_confusion(t):
    return ops.confusion_matrix(t.scored, _predicted(), F.col("y"))


@query(
    "metric_sens_spec",
    _LABELLED
    + """, c AS (SELECT count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 1) AS pos,
        count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0) AS neg FROM l)
      SELECT CASE WHEN tp = 0 THEN 0e0 ELSE round(tp / pos, 5) END AS sensitivity,
             CASE WHEN tn = 0 THEN 0e0 ELSE round(tn / neg, 5) END AS specificity FROM c""",
)
def metric_sens_spec(t):
    return ops.sensitivity_specificity(t.scored, _predicted(), F.col("y"))


@query(
    "metric_class_report",
    _LABELLED
    + """, k AS (SELECT c AS label, (SELECT count(*) FROM l WHERE y = c AND p = c) AS tp,
          (SELECT count(*) FROM l WHERE p = c) AS np, (SELECT count(*) FROM l WHERE y = c) AS ns
        FROM (VALUES (0), (1)) v(c)),
      m AS (SELECT CAST(label AS VARCHAR) AS label, CASE WHEN tp = 0 THEN 0e0 ELSE tp / np END AS precision,
          CASE WHEN tp = 0 THEN 0e0 ELSE tp / ns END AS recall,
          CASE WHEN tp = 0 THEN 0e0 ELSE 2e0 * tp / (np + ns) END AS f1, ns AS support, tp FROM k),
      a AS (SELECT label, precision, recall, f1, support FROM m
        UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM m
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
          sum(f1 * support) / sum(support), sum(support) FROM m)
      SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        CAST(support AS BIGINT) AS support FROM a""",
)
def metric_class_report(t):
    report = ops.classification_report(t.scored, _predicted(), F.col("y"))
    return report.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "metric_roc_auc",
    _SCORED
    + """, r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS place FROM scored),
      s AS (SELECT sum(CASE WHEN y = 1 THEN place END) AS places, sum(y) AS pos, count(*) - sum(y) AS neg FROM r)
      SELECT round((places - pos * (pos + 1e0) / 2) / (CAST(pos AS DOUBLE) * neg), 6) AS auc FROM s""",
)
def metric_roc_auc(t):
    return ops.roc_auc(t.scored, "score", "y").select(F.round("auc", 6).alias("auc"))


@query(
    "metric_custom_error",
    _SCORED
    + """ SELECT round(avg(CASE WHEN 1e0 / (1e0 + exp(-margin)) > 5e-1 THEN 1e0 - y ELSE y END), 6) AS error FROM scored""",
)
def metric_custom_error(t):
    return ops.margin_error(t.scored, "margin", "y").select(F.round("error", 6).alias("error"))


@query(
    "logit_grad_hess",
    _SCORED + " SELECT event_id, round(score - y, 9) AS grad, round(score * (1e0 - score), 9) AS hess FROM scored",
)
def logit_grad_hess(t):
    rows = ops.logistic_derivatives(t.scored, "margin", "y")
    return rows.select("event_id", F.round("grad", 9).alias("grad"), F.round("hess", 9).alias("hess"))


@query(
    "metric_inertia",
    """WITH m AS (SELECT label, pos, avg(x) AS x FROM (
           SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) u
         GROUP BY 1, 2),
       c AS (SELECT label AS cluster, list(x ORDER BY pos) AS v FROM m GROUP BY 1),
       d AS (SELECT vec_id, min(power(list_distance(embedding::DOUBLE[], v), 2)) AS d2 FROM embeddings, c GROUP BY 1)
       SELECT round(sum(d2), 6) AS inertia FROM d""",
)
def metric_inertia(t):
    centers = ops.class_means(t.embeddings, "embedding", "label", 64)
    return ops.inertia(t.embeddings, "embedding", centers).select(F.round("inertia", 6).alias("inertia"))


@query(
    "metric_cross_entropy",
    """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS z FROM embeddings),
       u AS (SELECT vec_id, label, z, unnest(z) AS x FROM e),
       s AS (SELECT vec_id, any_value(z[label + 1]) AS own, sum(exp(x)) AS total FROM u GROUP BY 1)
       SELECT CAST(vec_id % 3 AS INT) AS epoch, round(sum(ln(total) - own), 6) AS loss FROM s GROUP BY 1""",
)
def metric_cross_entropy(t):
    epoch = (F.col("vec_id") % 3).cast("int")
    return ops.epoch_loss(t.embeddings, epoch, "embedding", "label").withColumn("loss", F.round("loss", 6))
