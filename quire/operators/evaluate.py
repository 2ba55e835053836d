"""Multi-class evaluation as aggregations over (label, prediction) pairs.

The confusion table has at most classes^2 rows, so everything after the first
(partial, map-side) aggregate works on a tiny table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_matrix(pred: DataFrame, label_col: str = "label",
                     pred_col: str = "prediction") -> DataFrame:
    """(label, prediction, n)."""
    return pred.groupBy(F.col(label_col).alias("label"),
                        F.col(pred_col).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(cm: DataFrame) -> DataFrame:
    """(cls, support, tp, predicted, precision, recall, f1) per class."""
    # each confusion cell counts once for its true class and once for its
    # predicted class: one pass over the table, no self-joins
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    roles = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("tp")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")))
    m = (cm.select(F.inline(roles))
           .groupBy("cls").agg(F.sum("support").alias("support"),
                               F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    return (m.withColumn("precision", p).withColumn("recall", r)
             .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(0.0)))


def summary_metrics(cm: DataFrame) -> DataFrame:
    """One row: weighted F1 (the evaluator's default), accuracy, weighted
    precision and recall, all weighted by true-class support."""
    m = class_metrics(cm)
    total = F.sum("support")
    return m.agg(
        (F.sum(F.col("f1") * F.col("support")) / total).alias("weighted_f1"),
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("weighted_recall"),
        total.alias("n"))
