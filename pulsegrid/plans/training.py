"""Fit, evaluate and explain the risk model."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.labels import hash_split, label_indexer, with_label
from ..operators.metrics import confusion_matrix, quality
from ..schemas import ENCODED_LABEL, FEATURES, LABEL
from ..session import stored


def assembler(features=FEATURES):
    return VectorAssembler(inputCols=list(features), outputCol="features")


#: Rows of a part. The forest draws its samples part by part, so the number of parts belongs to the model like the seed.
PART_ROWS = 1 << 15
LEAST_PARTS = 32
WEIGHT, FIT_HASH = "fit_weight", "fit_hash"
#: Hashes that agree on their first 12 bits are a range.
RANGE_SHIFT = 52


def fit_sample(rows, label=LABEL, rows_per_class=None, seed=1234):
    """All training rows with their hash and a weight of one; with ``rows_per_class``, of each class only the rows with the smallest hashes.

    The hash is over all columns and the seed, so the sample follows from the rows alone. Counts by class and range of hashes tell
    the range that holds the last row of a class: rows behind it are left out before the shuffle, and rows are ranked inside
    their range, so that no task gets a class. ``fit_weight`` is the number of a class's rows that a row stands for, so class shares
    are kept.
    """
    hashed = rows.withColumn(FIT_HASH, F.xxhash64(F.lit(seed), *rows.columns))
    if rows_per_class is None:
        return hashed.withColumn(WEIGHT, F.lit(1.0))
    hashed = hashed.withColumn("fit_range", F.shiftright(FIT_HASH, RANGE_SHIFT))
    counts = hashed.groupBy(F.col(label).alias("fit_class"), "fit_range").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.sum("n").over(Window.partitionBy("fit_class").orderBy("fit_range")) - F.col("n"))
    reached = F.when(F.col("before") + F.col("n") >= rows_per_class, F.struct("fit_range", (F.lit(rows_per_class) - F.col("before")).alias("wanted")))
    last = F.min(reached)  # the first range that fills the class, and how many of its rows are wanted; NULL if all rows are
    limits = counts.groupBy("fit_class").agg(F.sum("n").alias("fit_n"), last["fit_range"].alias("fit_last"), last["wanted"].alias("fit_wanted"))
    near = hashed.join(F.broadcast(limits), F.col(label) == F.col("fit_class")).where("fit_last IS NULL OR fit_range <= fit_last")
    smallest = Window.partitionBy(label, "fit_range").orderBy(FIT_HASH, *rows.columns)
    ranked = near.withColumn("fit_rank", F.row_number().over(smallest)).where(F.col("fit_rank") <= rows_per_class)
    chosen = ranked.where("fit_last IS NULL OR fit_range < fit_last OR fit_rank <= fit_wanted")
    weight = F.greatest(F.lit(1.0), F.col("fit_n") / F.lit(rows_per_class))
    return chosen.withColumn(WEIGHT, weight).select(*rows.columns, FIT_HASH, WEIGHT)


def fit_risk_model(rows, features=FEATURES, label=LABEL, trees=100, seed=1234, rows_per_class=None):
    """Label index, feature vector and a forest of ``trees`` trees, with a fixed seed, over all rows.

    Rows without a label or with a missing input are left out: the one would become a class of its own, the
    other would stop the fit. The rows are stored, as the fit passes over them several times; their number decides that of the parts.
    A caller who wants a bounded sample gives ``rows_per_class``; see ``fit_sample``.
    """
    kept = stored(fit_sample(complete_rows(rows, features, label), label, rows_per_class, seed), "fit-rows")
    parts = max(LEAST_PARTS, -(-kept.count() // PART_ROWS))
    forest = RandomForestClassifier(featuresCol="features", labelCol=ENCODED_LABEL, weightCol=WEIGHT, numTrees=trees, seed=seed)
    pipeline = Pipeline(stages=[label_indexer(label, ENCODED_LABEL), assembler(features), forest])
    return pipeline.fit(spread(kept, parts))


def complete_rows(rows, features=FEATURES, label=LABEL):
    return with_label(rows, label).dropna(subset=list(features))


def spread(rows, parts):
    """Rows dealt by their hash, in a fixed order, so that neither the cluster nor the files decide the model."""
    return rows.repartition(parts, FIT_HASH).sortWithinPartitions(FIT_HASH, *[c for c in rows.columns if c != FIT_HASH])


def left_out(rows, features=FEATURES, label=LABEL):
    """(n_rows, n_unlabelled, n_incomplete): how many rows the fit does not see, and why."""
    incomplete = F.lit(False)
    for c in features:
        incomplete = incomplete | F.col(c).isNull()
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col(label).isNull()).alias("n_unlabelled"),
                    F.count_if(F.col(label).isNotNull() & incomplete).alias("n_incomplete"))


def labels_of(model):
    """Label texts by class index."""
    return list(model.stages[0].labels)


def train_and_test(rows, keys, features=FEATURES, label=LABEL, trees=100, seed=1234):
    """(model, predictions on the held-out rows).

    The rows are computed once and stored for all passes, before they are tested for gaps: a test on a computed
    input would compute it again.
    """
    rows = complete_rows(stored(rows, "training"), features, label)
    training, test = hash_split(rows, keys, seed=seed)
    model = fit_risk_model(training, features, label, trees, seed)
    return model, model.transform(unseen_labels(test, model, label, False))


def unseen_labels(test, model, label=LABEL, unseen=True):
    """The held-out rows whose label the training rows lack, so that no measure counts them; or the others."""
    known = F.col(label).isin(labels_of(model))
    return test.where(~known if unseen else known)


def unseen_counts(rows, model, keys, features=FEATURES, label=LABEL, seed=1234):
    """(label, n): held-out rows that the quality measures leave out because the model has no such class."""
    _, test = hash_split(complete_rows(rows, features, label), keys, seed=seed)
    return unseen_labels(test, model, label).groupBy(label).agg(F.count("*").alias("n"))


def evaluate(predictions, label=ENCODED_LABEL):
    """Accuracy, weighted precision and weighted recall from one pass over the predictions."""
    return quality(confusion_matrix(predictions, label))


def importances(spark, model, features=FEATURES):
    """(feature, importance), one row per model input."""
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(f, float(w)) for f, w in zip(features, weights)],
                                 "feature string, importance double")


def preview(predictions, columns, order, rows=10):
    """The first rows in a stated order, for a look at the result."""
    return predictions.select(*columns).orderBy(*order).limit(rows)
