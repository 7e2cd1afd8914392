"""Clinical, reading and training tables from files."""

from pyspark.sql import functions as F

from ..functions import blank_nan
from ..schemas import READING_SCHEMA, TRACK_COLUMNS, TRAINING_SCHEMA


def require_rows(df, what):
    """An empty input ends the job with an error instead of an empty result."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df


def read_text_csv(spark, path):
    """A header CSV with all columns as text; Spark drops a leading byte-order mark itself.

    All files must have the same header; a file with another one, also in another order, is an error, not a misread.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def read_clinical(spark, path):
    return require_rows(read_text_csv(spark, path), path)


def read_training(spark, path):
    """Columns are matched by header name and cast value by value; an unreadable value is NULL."""
    rows = read_text_csv(spark, path)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                         for f in TRAINING_SCHEMA.fields])


def write_training(rows, path):
    rows.select(*TRAINING_SCHEMA.names).write.option("header", True).mode("overwrite").csv(path)


def known_tracks(readings, tracks=tuple(TRACK_COLUMNS)):
    """The wanted tracks; both filters reach a parquet scan."""
    return readings.where(F.col("track").isin(list(tracks)) & F.col("value").isNotNull())


def read_readings(spark, path, fmt="parquet", schema=None):
    """Long table of monitor readings, NaN as NULL. Without a ``seq`` column the time orders the readings."""
    reader = spark.read.schema(schema) if schema else spark.read
    rows = known_tracks(reader.format(fmt).load(path))
    if "seq" not in rows.columns:
        rows = rows.withColumn("seq", F.unix_micros("t"))
    rows = rows.withColumn("value", blank_nan(F.col("value")))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in READING_SCHEMA.fields])
