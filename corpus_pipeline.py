"""A corpus from raw documents: quality rules, near-duplicates, secrets, packing.

``STAGES`` are (name, function) in order; each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from pyspark.sql import functions as F

from pulsegrid.llm import packing, quality, secret_scan, simhash
from pulsegrid.llm.columns import columns, table
from pulsegrid.llm.queries import TOKENIZER
from pulsegrid.session import stored, use_utc


def good_documents(spark, docs, sf_dir):
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def one_of_each(spark, docs, sf_dir):
    """One document of each near-duplicate component, the one with the smallest id."""
    return simhash.one_of_each(docs)


def without_secrets(spark, docs, sf_dir):
    """All documents, with every span of a secret replaced by a mark; ``n_chars`` follows the text."""
    scanned = secret_scan.scan(docs)
    clean = secret_scan.redacted(F.col("text"), F.col("spans"))
    return scanned.withColumn("text", clean).withColumn(
        "n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*columns(docs.columns))


def sequences(spark, docs, sf_dir):
    """The documents' tokens in sequences of 2048, a row per piece."""
    return packing.packed(docs, TOKENIZER)


STAGES = [
    ("quality_rules", good_documents),
    ("simhash_near_dedup", one_of_each),
    ("secret_scan", without_secrets),
    ("packing", sequences),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(use_utc(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
