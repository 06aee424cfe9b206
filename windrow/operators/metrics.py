"""Holdout metrics of regressors and classifiers."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions import columns as fn


def regression_metrics(
    scored: DataFrame, label: str, prediction: str = "prediction"
) -> DataFrame:
    """Mean squared error, its root and R squared, in one pass and one row."""
    error = F.avg(F.pow(F.col(label) - F.col(prediction), 2))
    return scored.agg(
        error.alias("mse"),
        F.sqrt(error).alias("rmse"),
        (1 - fn.ratio(error, F.var_pop(label))).alias("r2"),
    )


def accuracy(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Share of rows whose predicted class is the label."""
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return scored.agg(F.avg(hit).alias("accuracy"))


def roc_auc(scored: DataFrame, label: str, score: str) -> float:
    """Area under the ROC curve, ties counted half.

    MLlib combines equal scores on the map side and sorts the rest by range over all tasks;
    ``numBins=0`` keeps every threshold, so the area is exact.
    """
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=0
    )
    rows = scored.select(F.col(label).cast("double").alias(label), F.col(score).cast("double"))
    return evaluator.evaluate(rows)
