"""Training labels and the split into training and test rows."""

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from ..schemas import ENCODED_LABEL, LABEL


def label_indexer(label=LABEL, encoded=ENCODED_LABEL):
    """Index by falling frequency; equal frequencies in text order."""
    return StringIndexer(inputCol=label, outputCol=encoded, handleInvalid="keep",
                         stringOrderType="frequencyDesc")


def index_labels(rows, label=LABEL, encoded=ENCODED_LABEL):
    return label_indexer(label, encoded).fit(rows.select(label)).transform(rows)


def with_label(rows, label=LABEL):
    """Rows that have a label; the rest would count as a class of their own."""
    return rows.where(F.col(label).isNotNull())


def split_share(keys, seed=1234):
    """A number in [0, 1) from the key's text and the seed: the same on every run and partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def hash_split(rows, keys, train_share=0.7, seed=1234):
    """(training rows, test rows)."""
    in_training = split_share(keys, seed) < F.lit(train_share)
    return rows.where(in_training), rows.where(~in_training)
