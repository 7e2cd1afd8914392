"""Samples as JSON messages and back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MESSAGE_COLUMNS, MESSAGE_SCHEMA

CORRUPT = "_corrupt_record"


def encode(samples, tag="patient.vitals", columns=MESSAGE_COLUMNS):
    """(tag, key, value): one JSON object per sample, keyed by case."""
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return samples.select(
        F.lit(tag).alias("tag"), F.col("caseid").cast("binary").alias("key"),
        body.cast("binary").alias("value"), "timestamp")


def decode(envelope):
    """Message fields as text, plus the raw text of a message that is no JSON object.

    The fields come out of a generator, because later filters are not pushed below one. Below a plain projection
    each filter on a field would parse the message again.
    """
    schema = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col("value").cast("string"), schema, options)
    return envelope.select(F.inline(F.array(parsed)))
