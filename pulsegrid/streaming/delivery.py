"""Sinks: plain append, and a writer with bounded retries that sets single records aside in a dead-letter table."""

import contextlib
import time
import uuid
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored_meanwhile
from .commits import Committed, commits, new_attempt, read_committed


def document_id(rows):
    """A name for each document, so that a store with keys replaces a repeated one; see ``UPSERT``."""
    return rows.withColumn("document_id", F.concat_ws("|", "caseid", "timestamp"))


# Search-index options that go with ``document_id``.
UPSERT = {"es.write.operation": "upsert", "es.mapping.id": "document_id", "es.mapping.exclude": "document_id"}


#: Parts of a stream's state on a small cluster.
LEAST_STATE_PARTS = 24


def state_parts(spark):
    """Into how many parts the state of a new stream is dealt: two per core, ``LEAST_STATE_PARTS`` at least, and never more than the
    session's shuffles have.

    Every micro-batch writes four small files per part, whether it changes the part or not. The rows that a part holds cost the same
    in any number of parts.
    """
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(given, max(LEAST_STATE_PARTS, 2 * spark.sparkContext.defaultParallelism))


@contextlib.contextmanager
def _shuffles(spark, parts):
    """A query started in the block takes a copy of the setting along; its checkpoint keeps it for restarts."""
    name = "spark.sql.shuffle.partitions"
    given = spark.conf.get(name)
    spark.conf.set(name, str(parts))
    try:
        yield
    finally:
        spark.conf.set(name, given)


def _start(rows, writer, path=None, stateful=False):
    if not stateful:
        return writer.start(path)
    spark = rows.sparkSession
    with _shuffles(spark, state_parts(spark)):
        return writer.start(path)


def start_append(rows, fmt, checkpoint, options=None, path=None, trigger=None, stateful=False):
    """Append query with a checkpoint of its own; ``fmt`` names a file format or a search-index connector.

    ``stateful`` says that ``rows`` keep state (repeats dropped, windows): see ``state_parts``.
    """
    writer = (rows.writeStream.outputMode("append").format(fmt).options(**(options or {}))
              .option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    return _start(rows, writer, path, stateful)


#: Failing writes after which what is left of a batch goes to the dead letters as it is. None: every failing record is found, whatever
#: their number.
MOST_FAILURES = None
#: Behind so many failing writes of pieces in a row, a write of no rows tells whether the sink fails or the records do.
PROBE_EVERY = 256
#: Rows of a piece whose codes the driver reads, and of a folder of a batch that is stored in pieces, about.
PIECE_ROWS = 1 << 12
MOST_FOLDER_BITS = 12
CODE, FOLDER = "delivery_code", "delivery_folder"


class SinkAway(RuntimeError):
    """A sink that takes not even a write of no rows. No record is set aside; the query fails and keeps its place."""


def attempt(write, tries, pause_seconds):
    """None if ``write()`` succeeds within ``tries`` attempts, else why the last one failed."""
    for number in range(tries):
        if number:
            time.sleep(pause_seconds)
        try:
            write()
            return None
        except Exception as failure:
            reason = f"{type(failure).__name__}: {failure}"
    return reason


def code_of(*columns):
    """The 64 bits of a hash as text, the last one first: a piece is what begins with some bits.

    As Spark compiles a filter with another number anew, but not one with another text, pieces share the code of their plans.
    """
    return F.reverse(F.lpad(F.bin(F.xxhash64(*columns)), 64, "0"))


def _text(code):
    return format(code, "064b")[::-1]


class Pieces:
    """A batch that is stored by its codes: reading a piece opens the folders that hold rows of it and no others."""

    def __init__(self, kept, columns, bits, n):
        self.kept, self.columns, self.bits, self.n = kept, columns, bits, n

    def coded(self, depth, number):
        """Rows whose hash ends in ``depth`` bits that are ``number``."""
        start = format(number, f"0{depth}b")[::-1] if depth else ""
        if depth < self.bits:
            return self.kept.where(F.col(FOLDER).startswith(start))
        rows = self.kept.where(F.col(FOLDER) == start[:self.bits]) if self.bits else self.kept
        return rows.where(F.col(CODE).startswith(start))

    def rows(self, depth, number):
        return self.coded(depth, number).select(*self.columns)

    def codes(self, depth, number):
        """The differing hashes of a piece, or None if there may be too many."""
        if self.n >> depth > PIECE_ROWS:
            return None
        return sorted(int(code[::-1], 2) for code in self.coded(depth, number).agg(F.collect_set(CODE)).first()[0])


@contextlib.contextmanager
def in_pieces(rows, code, columns=None):
    """``Pieces`` of ``rows``, stored for the block, so that a write of a piece does not compute or read the whole batch."""
    n = rows.count()
    bits = min(MOST_FOLDER_BITS, (n // PIECE_ROWS).bit_length())
    coded = rows.withColumn(CODE, code).withColumn(FOLDER, F.substring(CODE, 1, bits))
    tasks = min(2 ** bits, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    with stored_meanwhile(coded.repartition(tasks, FOLDER), "pieces", [FOLDER]) as kept:
        yield Pieces(kept, columns or rows.columns, bits, n)


class _Piece:
    """A piece of a batch that cannot be written as it is: ``codes`` if they are known, ``reason`` if it was tried."""

    def __init__(self, depth, number, codes, reason):
        self.depth, self.number, self.codes, self.reason = depth, number, codes, reason
        self.name = f"{depth}-{number}"

    def halves(self):
        """The two pieces inside with one bit more; bits that are the same in all codes are passed over."""
        depth, number = self.depth, self.number
        if self.codes:
            while len({code >> depth & 1 for code in self.codes}) == 1:
                number, depth = self.codes[0] % 2 ** (depth + 1), depth + 1
        for half in (number, number + 2 ** depth):
            codes = None if self.codes is None else [c for c in self.codes if c % 2 ** (depth + 1) == half]
            yield _Piece(depth + 1, half, codes, None)


def _split(pieces, write, batch_id, piece):
    """(pieces inside ``piece`` that cannot be written, how many writes failed, whether one went well); the others are written.

    Of a piece that fails, a half must fail if the other can be written, so it is split without a write of its own unless it is one record.
    """
    if piece.codes is None:
        piece.codes = pieces.codes(piece.depth, piece.number)

    def tried(some):
        some.reason = attempt(lambda: write(pieces.rows(some.depth, some.number), batch_id, some.name), 1, 0)
        return some.reason is not None

    if piece.codes is not None and len(piece.codes) < 2:
        if not piece.codes:
            return [], 0, False
        if piece.reason is None and not tried(piece):
            return [], 0, True
        return [piece], 0, False
    first, second = piece.halves()
    failing = [first] if tried(first) else []
    if not failing and (second.codes is None or len(second.codes) > 1):
        return [second], 0, True
    if tried(second):
        failing.append(second)
    return failing, sum(half.reason is not None for half in failing), len(failing) < 2


def side_by_side(spark, work, items, at_once):
    """(item, work(item)) as they end, ``at_once`` at a time. Items may be added to the list ``items`` meanwhile; the last one goes first."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {}
        while items or running:
            while items and len(running) < at_once:
                item = items.pop()
                running[pool.submit(inheritable_thread_target(spark)(work), item)] = item
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                yield running.pop(done), done.result()


def failing_records(write, pieces, batch_id, reason, tries, pause_seconds, most_failures=None, at_once=None):
    """Writes all of a batch that can be written, and returns the rest: pieces of one record each (or equal ones), with the reason."""
    spark = pieces.kept.sparkSession
    at_once = at_once or max(4, min(16, spark.sparkContext.defaultParallelism))
    waiting, alone, left, failures, in_a_row = [_Piece(0, 0, None, reason)], [], [], 1, 0
    for piece, (failing, failed, went_well) in side_by_side(
            spark, lambda piece: _split(pieces, write, batch_id, piece), waiting, at_once if most_failures is None else 1):
        failures += failed
        in_a_row = 0 if went_well else in_a_row + failed
        if in_a_row >= PROBE_EVERY:
            in_a_row, name = 0, f"none-{uuid.uuid4().hex}"  # no piece, so it is inside none that is still to be written
            away = attempt(lambda: write(pieces.rows(0, 0).limit(0), batch_id, name), tries, pause_seconds)
            if away is not None:
                raise SinkAway(f"batch {batch_id}, behind {PROBE_EVERY} failing writes of pieces, a write of no rows: {away}")
        for inner in failing:
            one = inner.codes is not None and len(inner.codes) == 1
            (alone if one else waiting).append(inner)
        if most_failures is not None and failures >= most_failures:
            left += waiting
            waiting.clear()
    for piece in left:
        if piece.reason is None:
            piece.reason = attempt(lambda: write(pieces.rows(piece.depth, piece.number), batch_id, piece.name), 1, 0)
    left = [piece for piece in left if piece.reason is not None]

    def again(piece):
        piece.reason = attempt(lambda: write(pieces.rows(piece.depth, piece.number), batch_id, piece.name), 1, 0)

    for _ in range(tries - 1):
        due = [piece for piece in alone if piece.depth and piece.reason is not None]
        if not due:
            break
        time.sleep(pause_seconds)
        for _ in side_by_side(spark, again, due, at_once):
            pass
    return [piece for piece in alone if piece.reason is not None] + left


def set_aside(aside, rows, batch_id, key, letters):
    """A commit of the table ``aside`` for each of ``letters``, {value of the column ``key``: (part, reason)}; all in one pass."""
    reasons = rows.sparkSession.createDataFrame([(value, reason) for value, (_, reason) in letters.items()],
                                                T.StructType([rows.schema[key], T.StructField("reason", T.StringType())]))
    aside.each(rows.join(F.broadcast(reasons), key), batch_id, key, {value: part for value, (part, _) in letters.items()})


def deliver(write, dead_letters, tries=5, pause_seconds=2.0, most_failures=MOST_FAILURES, at_once=None):
    """A ``foreachBatch`` function that delivers all records it can, and puts each of the others aside with the reason.

    A batch gets up to ``tries`` attempts as a whole. If all fail it is stored and halved by a hash of its records, and the halves again,
    until the failing records are alone (or equal ones together); these get their ``tries`` too and go to the dead letters. A
    batch with f such records costs about 1.5 f log2(n) writes, ``at_once`` of them (by the cluster's cores) side by side. If the sink
    then fails without any record too, the query fails and keeps its place. With ``most_failures`` the rest goes to the dead letters behind so many.

    ``write(rows, batch_id, part)`` may run again for the same batch and part, or a part inside it, after a failure or a restart, and for
    several parts at a time, so it should do nothing for one that it has written, as ``Committed`` does, or replace it. ``part`` is ""
    for a whole batch. If the dead letters cannot be written, the query fails and keeps its place.
    """
    aside = Committed(dead_letters)

    def run(rows, batch_id):
        reason = attempt(lambda: write(rows, batch_id, ""), tries, pause_seconds)
        if reason is None:
            return
        with in_pieces(rows, code_of(*rows.columns)) as pieces:
            if most_failures is not None and most_failures <= 1:
                left = [_Piece(0, 0, None, reason)]
            else:
                left = failing_records(write, pieces, batch_id, reason, tries, pause_seconds, most_failures, at_once)
            single = {_text(p.codes[0]): (p.name, p.reason) for p in left if p.codes is not None and len(p.codes) == 1}
            if single:
                set_aside(aside, pieces.kept.select(*pieces.columns, CODE), batch_id, CODE, single)
            for piece in left:
                if piece.codes is None or len(piece.codes) > 1:
                    aside(pieces.rows(piece.depth, piece.number).withColumn("reason", F.lit(piece.reason)), batch_id, piece.name)

    return run


#: Names the letters of a round of redelivery in the log of those handled.
BEGUN = "begun"


def redeliver(spark, dead_letters, write, schema=None, tries=5, pause_seconds=2.0, at_once=None):
    """Sends the dead letters again, all together; what fails again stays, each under a new commit with its new reason.

    Returns (sent, left): how many commits of dead letters were handled, and how many failed again. If they cannot be written together,
    those that fail are found as ``deliver`` finds records. Handled commits are named in a log of their own beside the dead letters, and so
    are those of a round that begins: a job that is started again goes on with the same batch, so that ``write`` knows its parts.
    """
    handled = f"{dead_letters.rstrip('/')}/_redelivered"
    log, marks, again = commits(spark, dead_letters), Committed(handled, run="redelivered"), Committed(dead_letters, run="redelivered")
    known = marks.committed(spark)
    done = {part for _, part in known}
    rounds = {number: notes["letters"] for (number, part), notes in known.items() if part == BEGUN}
    rounds = {number: letters for number, letters in sorted(rounds.items()) if not done.issuperset(letters)}
    begun = done.union(*rounds.values())
    new = [r["attempt"] for r in log.select("attempt").collect() if r["attempt"] not in begun]
    if new:
        number = 1 + max((number for number, _ in known), default=-1)
        marks.note(spark, number, BEGUN, {"letters": new})
        rounds[number] = new
    left = 0
    for number, letters in rounds.items():
        names = spark.createDataFrame([(letter,) for letter in letters], "attempt string")
        rows = read_committed(spark, dead_letters, schema, log.join(F.broadcast(names), "attempt", "left_semi")).drop("run", "batch", "reason")
        failing = _redelivered(write, rows, number, names, tries, pause_seconds, at_once)
        if failing:
            set_aside(again, rows, number, "attempt", {letter: (letter, reason) for letter, reason in failing.items()})
        marks.note_all(spark, [(number, letter, {}, new_attempt()) for letter in letters])
        left += len(failing)
    return sum(map(len, rounds.values())), left


def _redelivered(write, rows, number, names, tries, pause_seconds, at_once):
    """{letter: reason} of the letters among ``names`` that could not be written; ``rows`` are those of the letters, by ``attempt``."""
    columns = [c for c in rows.columns if c != "attempt"]
    reason = attempt(lambda: write(rows.select(*columns), number, ""), tries, pause_seconds)
    if reason is None:
        return {}
    with in_pieces(rows, code_of("attempt"), columns) as pieces:
        left = failing_records(write, pieces, number, reason, tries, pause_seconds, at_once=at_once)
    codes = names.select(code_of("attempt").alias(CODE), "attempt").collect()
    reasons = {_text(code): piece.reason for piece in left for code in piece.codes}
    return {r["attempt"]: reasons[r[CODE]] for r in codes if r[CODE] in reasons}


def start_foreach_batch(rows, write_batch, checkpoint, mode="append", trigger=None, stateful=False):
    writer = (rows.writeStream.outputMode(mode).foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    return _start(rows, writer, stateful=stateful)
