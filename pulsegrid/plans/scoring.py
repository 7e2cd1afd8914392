"""Risk scores for decoded rows; the same function serves a table and a stream."""

from pyspark.sql import functions as F

from ..functions import risk_label
from ..operators.enrich import enrich
from ..operators.quarantine import scorable
from ..schemas import SCORED_COLUMNS
from .training import labels_of


def score_enriched(enriched, model):
    """Scored documents for the rows that have all inputs; see ``quarantined`` for the others."""
    predicted = model.transform(scorable(enriched))
    text = risk_label(F.col("prediction"), labels_of(model))
    return predicted.withColumn("Risk Predicted", text).select(*SCORED_COLUMNS)


def score(decoded, model):
    return score_enriched(enrich(decoded), model)
