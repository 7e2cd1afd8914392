"""The given tables in the shape of the pipeline's inputs.

``events`` plays the monitor: one reading per event, plus one oxygen reading from its ``props``. ``customer`` plays the
clinical table. The values are numbers, not physiology; the grid step is 6 hours because a case has a few events a day.
"""

import string

from pyspark.sql import functions as F

from ..functions import as_double
from ..schemas import HIGH_RISK, LABEL, LOW_RISK, TRAINING_SCHEMA

STEP_SECONDS = 6 * 3600
BASE = "2025-02-11 10:00:00.123987"

EVENT_TRACKS = {
    "view": "Solar8000/ART_DBP",
    "purchase": "Solar8000/ART_SBP",
    "click": "Solar8000/HR",
    "error": "Solar8000/BT",
    "signup": "Solar8000/VENT_RR",
}
TEXT_FEATURES = ["characters", "words", "newlines", "digits", "capitals", "punctuation",
                 "distinct_words", "white_space"]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_readings(events):
    track = F.lit(None).cast("string")
    for event_type, name in EVENT_TRACKS.items():
        track = F.when(F.col("event_type") == event_type, F.lit(name)).otherwise(track)
    oxygen = as_double(F.get_json_object("props", "$.k"))
    both = F.array(
        F.struct(track.alias("track"), F.col("value").alias("value")),
        F.struct(F.lit("Solar8000/PLETH_SPO2").alias("track"), oxygen.alias("value")),
    )
    return events.select(
        F.col("user_id").cast("string").alias("caseid"), F.col("ts").cast("timestamp").alias("t"),
        F.col("event_id").alias("seq"), F.explode(both).alias("r"),
    ).select("caseid", "r.track", "t", "seq", "r.value")


def customer_clinical(customer):
    key = F.col("c_custkey")
    weight = F.col("c_acctbal").cast("decimal(12,2)") * F.lit("0.001").cast("decimal(4,3)") + F.lit(60)
    return customer.select(
        key.cast("string").alias("caseid"), (F.lit(18) + key % 80).cast("string").alias("age"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "F").otherwise("M").alias("sex"),
        (F.lit(150) + key % 50).cast("string").alias("height"), weight.cast("string").alias("weight"),
    )


def training_rows(enriched):
    """Enriched samples as a training table; a pulse above the systolic pressure stands for high risk."""
    risk = F.when(F.col("Heart Rate") > F.col("Systolic Blood Pressure"), HIGH_RISK).otherwise(LOW_RISK)
    named = enriched.withColumns({"Patient ID": F.col("caseid"), LABEL: risk})
    return named.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in TRAINING_SCHEMA.fields])


def text_features(documents, *keep):
    """Eight counts over the whole text of a document, and the columns to keep."""
    text = F.col("text")
    words = F.split(F.trim(text), "[ \\t\\n\\r]+")

    def count_of(characters):
        return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("double")

    return documents.select(
        "doc_id", F.length(text).cast("double").alias("characters"),
        F.size(words).cast("double").alias("words"), count_of("\n").alias("newlines"),
        count_of(string.digits).alias("digits"), count_of(string.ascii_uppercase).alias("capitals"),
        count_of(string.punctuation).alias("punctuation"),
        F.size(F.array_distinct(words)).cast("double").alias("distinct_words"),
        count_of(" \t\n\r").alias("white_space"), *keep,
    )


def labelled_documents(documents, labels):
    """Text features with a label: quality 1 as low risk, 0 as high risk."""
    risk = F.when(F.col("quality") == 1, LOW_RISK).when(F.col("quality") == 0, HIGH_RISK)
    labelled = documents.join(labels.select("doc_id", risk.alias(LABEL)), "doc_id")
    return text_features(labelled, LABEL)


def rule_predictions(documents, labels):
    """A fixed rule in the place of a model: texts of at least 400 characters are class 0, others class 1."""
    predicted = F.when(F.col("n_chars") >= 400, 0.0).otherwise(1.0)
    risk = F.when(F.col("quality") == 1, LOW_RISK).when(F.col("quality") == 0, HIGH_RISK)
    return documents.select("doc_id", predicted.alias("prediction")).join(
        labels.select("doc_id", risk.alias(LABEL)), "doc_id")


