"""Rows the model cannot score are set aside with a reason instead of failing the job."""

from functools import reduce

from pyspark.sql import functions as F

from ..schemas import FEATURES
from .messages import CORRUPT


def _missing(c):
    return F.col(c).isNull() | F.isnan(F.col(c).cast("double"))


def can_be_scored(features=FEATURES):
    return ~reduce(lambda a, b: a | b, [_missing(c) for c in features])


def scorable(enriched, features=FEATURES):
    return enriched.where(can_be_scored(features))


def quarantined(enriched, features=FEATURES):
    """The other rows, with ``reason``: what could not be decoded, or which inputs are missing."""
    names = F.concat_ws(", ", *[F.when(_missing(c), F.lit(c)) for c in features])
    reason = F.concat(F.lit("missing: "), names)
    if CORRUPT in enriched.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("undecodable")).otherwise(reason)
    return enriched.where(~can_be_scored(features)).withColumn("reason", reason)
