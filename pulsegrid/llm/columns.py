"""Column helpers of this package."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name):
    """A column name as it stands, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def columns(names):
    return [F.col(quoted(n)) for n in names]


def row_of(names):
    """A struct of these columns; ``row.*`` gives them back."""
    return F.struct(*(columns(names) or [F.lit(0)]))


def place_of(names, wanted):
    """Where Spark finds the column ``wanted`` among ``names``, which it compares without case; None if nowhere."""
    exact = [i for i, n in enumerate(names) if n == wanted]
    return next(iter(exact or [i for i, n in enumerate(names) if n.lower() == wanted.lower()]), None)


def with_made(df, source, name, kind, work):
    """``df`` with column ``name``, which ``work`` makes of the Arrow array of column ``source``; one of that name is replaced.

    Python workers get columns by place, under plain names, so that no name of ``df`` matters.
    """
    kept = [i for i, n in enumerate(df.columns) if n.lower() != name.lower()]
    sent = columns(df.columns[i] for i in kept)
    at = place_of([df.columns[i] for i in kept], source)
    if at is None:
        at, sent = len(sent), [*sent, F.col(source)]
    plain = df.select(*[c.alias(f"c{i}") for i, c in enumerate(sent)])
    schema = T.StructType([*plain.schema.fields[:len(kept)], T.StructField("made", kind)])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], work(batch.column(at))], names=schema.names)

    return in_small_batches(plain).mapInArrow(run, schema).toDF(*[df.columns[i] for i in kept], name)


#: Rows with whole texts that a Python worker gets at once.
TEXT_ROWS = 500


def in_small_batches(df, rows=TEXT_ROWS):
    """``df``; its session hands Python workers at most so many rows at once, so that long texts don't pile up."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def let(value, body):
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def total(array):
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


def running_totals(array, block=256):
    """Sums up to and including each element, over blocks, so that long arrays don't cost a square."""
    def blocks(a):
        return F.when(F.size(a) == 0, F.array().cast("array<array<bigint>>")).otherwise(
            F.transform(F.sequence(F.lit(0), ((F.size(a) - 1) / block).cast("int")),
                        lambda b: F.slice(a, b * block + 1, F.lit(block))))

    def inside(bs):
        sums = F.transform(bs, total)
        return let(sums, lambda ss: F.flatten(F.transform(bs, lambda b, i: let(
            total(F.slice(ss, F.lit(1), i)),
            lambda before: F.transform(b, lambda _, j: before + total(F.slice(b, F.lit(1), j + 1)))))))

    return let(array, lambda a: let(blocks(a), inside))
