"""Prediction index to risk text."""

from pyspark.sql import functions as F

from ..schemas import HIGH_RISK, LOW_RISK, UNKNOWN_RISK


def risk_label(prediction, labels):
    """Text of class ``prediction`` in the label order of the fitted indexer; else "Unknown".

    The order follows label frequency in the training data, so the text is looked up, not assumed.
    """
    text = F.lit(UNKNOWN_RISK)
    for position, label in reversed(list(enumerate(labels))):
        text = F.when(prediction == position, F.lit(label)).otherwise(text)
    return text


def risk_label_by_position(prediction):
    """Class 1 is low risk, all else high risk: right only for a model whose class 1 is low risk."""
    return F.when(prediction == 1, F.lit(LOW_RISK)).otherwise(F.lit(HIGH_RISK))
