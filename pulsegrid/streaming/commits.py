"""A file sink for micro-batches with a log of commits, which readers follow.

Batch numbers start again with each checkpoint, so a batch is named by its run as well: the id of the streaming query, which its
checkpoint keeps. Every attempt writes a folder of its own, ``run=<run>/batch=<n>/attempt=<id>``, and counts once its row stands in
the log, a small file that appears as a whole. A batch that is in the log is not written again. So no checkpoint, restart or
failed attempt replaces or doubles rows, as long as readers use ``read_committed``; what a failed attempt left is never read.
"""

import datetime as dt
import json
import threading
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "_commits"
LOG_SCHEMA = "run string, batch long, part string, attempt string, at timestamp, notes string"
PLACE = ["run", "batch", "attempt"]
_PLACE_FIELDS = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("attempt", T.StringType())]


def run_of(spark):
    """The id of the streaming query whose batch this is: the same after a restart, another one for a new checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _log_path(path):
    return f"{path.rstrip('/')}/{LOG}"


def _folder(spark, path):
    """(file system, path) of the log of ``path``, as the JVM knows them."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_log_path(path))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def commits(spark, path):
    """The log: a row per committed batch or part of one; of several rows for one, that with the smallest attempt counts."""
    store, folder = _folder(spark, path)
    if not store.exists(folder):
        return spark.createDataFrame([], LOG_SCHEMA)
    first = Window.partitionBy("run", "batch", "part").orderBy("attempt")
    rows = spark.read.schema(LOG_SCHEMA).json(_log_path(path))
    return rows.withColumn("rank", F.row_number().over(first)).where("rank = 1").drop("rank")


def compact_log(spark, path, least_files=1000):
    """Puts the log's small files, if there are so many, into one; how many there were.

    A writer may go on meanwhile: only files that were there at the start are removed, after their rows stand in the new one,
    and a row that stands in two files counts once.
    """
    store, folder = _folder(spark, path)
    old = [f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-")] if store.exists(folder) else []
    if len(old) < least_files:
        return 0
    rows = spark.read.schema(LOG_SCHEMA).json([f.toString() for f in old]).distinct()
    rows.coalesce(1).write.mode("append").json(_log_path(path))
    for f in old:
        store.delete(f, False)
    return len(old)


class Committed:
    """A batch writer, ``write(rows, batch_id, part="")``.

    ``part`` names a piece of a batch that is written for itself: ``depth-number``, the rows whose hash ends in ``depth`` bits that
    are ``number``; "" is the whole batch. A piece is refused if a smaller one inside it is committed, and is written already if a
    larger one around it is. Several threads may write pieces of a batch. With ``by_date`` rows
    lie by the date of their ``event_ts``, so that a reader of some dates opens no others. Without a streaming query ``run`` must be given.
    ``notes`` are kept in the log.
    """

    def __init__(self, path, run=None, by_date=False):
        self.path, self.run, self.by_date = path.rstrip("/"), run, by_date
        self.done, self.lock = None, threading.RLock()

    def committed(self, spark):
        """{(batch, part): notes} of this run; the log is read once."""
        run = "r-" + (self.run or run_of(spark))
        with self.lock:
            if self.done is None or self.done[0] != run:
                known = commits(spark, self.path).where(F.col("run") == run).select("batch", "part", "notes").collect()
                self.done, self.begun = (run, {}), set()
                for r in known:
                    self._know(r.batch, r.part, json.loads(r.notes))
            return self.done[1]

    def _know(self, batch_id, part, notes):
        self.done[1][batch_id, part] = notes
        for whole in wholes(part):
            if (batch_id, whole) in self.begun:
                break
            self.begun.add((batch_id, whole))

    def written(self, spark, batch_id, part):
        """Whether a batch, or a piece of it, is committed; an error if a smaller piece inside it is."""
        with self.lock:
            known = self.committed(spark)
            if any((batch_id, name) in known for name in (part, *wholes(part))):
                return True
            if (batch_id, part) in self.begun:
                raise ValueError(f"batch {batch_id} of {self.path} was begun in parts")
            return False

    def __call__(self, rows, batch_id, part="", notes=None):
        spark = rows.sparkSession
        if self.written(spark, batch_id, part):
            return
        attempt = new_attempt()
        writer = (rows.withColumn("event_date", F.to_date("event_ts")) if self.by_date else rows).write
        writer = writer.partitionBy("event_date") if self.by_date else writer
        writer.parquet(f"{self.path}/run={self.done[0]}/batch={batch_id}/attempt={attempt}")
        self.note(spark, batch_id, part, notes, attempt)

    def each(self, rows, batch_id, key, parts):
        """A commit for each of many pieces, all written in one pass: ``parts`` is {value of the column ``key``: part}.

        ``key`` itself is not kept. Not for tables by date.
        """
        spark = rows.sparkSession
        due = {value: (part, new_attempt()) for value, part in parts.items() if not self.written(spark, batch_id, part)}
        if not due:
            return
        kind = T.StructType([rows.schema[key], T.StructField("new_attempt", T.StringType())])
        places = spark.createDataFrame([(value, attempt) for value, (_, attempt) in due.items()], kind)
        placed = rows.join(F.broadcast(places), key).drop(key).withColumnRenamed("new_attempt", "attempt")
        placed.write.mode("append").partitionBy("attempt").parquet(f"{self.path}/run={self.done[0]}/batch={batch_id}")
        self.note_all(spark, [(batch_id, part, {}, attempt) for part, attempt in due.values()])

    def note(self, spark, batch_id, part="", notes=None, attempt=None):
        """A row of the log, for a batch that is written or has nothing to write."""
        self.note_all(spark, [(batch_id, part, notes or {}, attempt or new_attempt())])

    def note_all(self, spark, entries):
        """Rows (batch, part, notes, attempt) of the log, which appear together."""
        self.committed(spark)
        at = dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds").replace("+00:00", "Z")
        lines = [json.dumps({"run": self.done[0], "batch": batch, "part": part, "attempt": attempt, "at": at, "notes": json.dumps(notes)})
                 for batch, part, notes, attempt in entries]
        _put(spark, self.path, "".join(line + "\n" for line in lines))
        with self.lock:
            for batch, part, notes, _ in entries:
                self._know(batch, part, notes)


def new_attempt():
    return "t-" + uuid.uuid4().hex


def _put(spark, path, text):
    """A file of the log, under a name that readers pass over until it is whole. No Spark job is needed for it."""
    store, folder = _folder(spark, path)
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store.mkdirs(folder)
    name = uuid.uuid4().hex
    begun, whole = made(folder, f"_begun-{name}"), made(folder, f"part-{name}.json")
    out = store.create(begun, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not store.rename(begun, whole):
        raise OSError(f"{begun.toString()} cannot be renamed")


def wholes(part):
    """The pieces around ``part``, the smallest first, and the batch. Names of another form are pieces of the batch only."""
    if not part:
        return
    depth, number = map(int, part.split("-")) if part.replace("-", "").isdigit() else (0, 0)
    for less in range(depth - 1, 0, -1):
        yield f"{less}-{number % 2 ** less}"
    yield ""


def read_committed(spark, path, schema=None, log=None):
    """All committed rows with their place, ``run``, ``batch`` and ``attempt``. The log prunes the folders that are opened.

    ``schema`` is needed where no batch may have had a row; ``log``, a part of ``commits``, reads those batches only.
    """
    log = commits(spark, path) if log is None else log
    places = log.select(*PLACE).distinct()
    reader = spark.read
    if schema is not None:
        placed = [*PLACE, "event_date"]
        dated = [f for f in schema.fields if f.name == "event_date"]
        reader = reader.schema(T.StructType([f for f in schema.fields if f.name not in placed] + _PLACE_FIELDS + dated))
    rows = reader.parquet(path)
    return rows.withColumn("batch", F.col("batch").cast("long")).join(F.broadcast(places) if _few(places) else places, PLACE, "left_semi")


def _few(places, most=100_000):
    """Whether the log is short enough to be sent to all tasks; then only its folders are opened."""
    return places.limit(most + 1).count() <= most


def one_per_document(rows, log, key="document_id"):
    """Of the rows of one document that several runs have written, that of the latest commit."""
    placed = rows.join(log.select(*PLACE, "at").distinct(), PLACE)
    newest = Window.partitionBy(key).orderBy(F.desc("at"), F.desc("batch"), "run")
    return placed.withColumn("rank", F.row_number().over(newest)).where("rank = 1").drop("rank", "at")
