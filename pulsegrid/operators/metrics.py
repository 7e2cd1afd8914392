"""Confusion counts, and the three quality measures from one pass over them."""

from pyspark.sql import functions as F


def confusion_matrix(predictions, label, prediction="prediction"):
    return predictions.groupBy(F.col(label).cast("int").alias("label"),
                               F.col(prediction).cast("int").alias("prediction")
                               ).agg(F.count("*").alias("n"))


def quality(confusion):
    """(accuracy, weighted_precision, weighted_recall) as one row.

    Every confusion count is read once: as support of its label and as prediction count of its class.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    as_label = F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                        zero.alias("predicted"), hit.cast("bigint").alias("hits"))
    as_prediction = F.struct(F.col("prediction").alias("class"), zero.alias("support"),
                             F.col("n").alias("predicted"), zero.alias("hits"))
    per_class = (
        confusion.select(F.explode(F.array(as_label, as_prediction)).alias("c")).select("c.*")
        .groupBy("class").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                              F.sum("hits").alias("hits"))
    )
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hits"), F.col("support")), F.lit(0.0))
    total = F.sum("support")
    return per_class.agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(precision * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(recall * F.col("support")) / total).alias("weighted_recall"),
    )
