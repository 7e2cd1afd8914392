"""Token sequences of a fixed window from whole documents, by best fit decreasing.

A document longer than a window is first cut into full windows. What is left of it, and every shorter document, goes, longest
first, into the open window with the least room that still holds it. A segment tree over remaining room finds that
window. Documents are packed in groups of a million tokens within a task, so memory is bounded by a group; a group leaves a window or
two not full, and a task with little input perhaps nearly all. Pieces of windows with room are brought together and packed
once more; full ones are not shuffled.

Defined cases: a NULL or empty text is the end id alone; equal rows are packed each for itself; an empty table gives no rows;
a document of any length is packed whole; other columns are not carried.
"""

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import stored
from .bpe import Vocabulary
from .columns import in_small_batches

WINDOW = 2048
END_ID = 1
#: A group is packed when it has so many tokens.
GROUP_TOKENS = 1 << 20
#: The library's splitter fails on about a million white-space characters in a row; parts with so many are split by our own.
SPACE_RUN = 1 << 16
#: The part of a window that may stay free in the first pass, and the groups that a task of the second pass has at least.
MOST_ROOM, TASK_GROUPS = 0.01, 4
_SEQUENCE_BITS = 33  # a task's number above, its sequences below
_SECOND = 1 << 62  # sequences of the second pass
_SPACE = re.compile(r"\s+")


class Room:
    """Open windows by remaining room: a segment tree over 0 to ``window`` that knows which rooms have a window."""

    def __init__(self, window):
        self.leaves = 1 << window.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.windows = [[] for _ in range(window + 1)]

    def add(self, room, window_id):
        self.windows[room].append(window_id)
        node = room + self.leaves
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, need):
        """(room, window) of the least room of at least ``need``, taken out; None if there is none."""
        node = need + self.leaves
        if not self.some[node]:
            while node > 1 and (node & 1 or not self.some[node ^ 1]):
                node >>= 1
            if node <= 1:
                return None
            node ^= 1
            while node < self.leaves:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        room = node - self.leaves
        window_id = self.windows[room].pop()
        if not self.windows[room]:
            self.some[node] = 0
            node >>= 1
            while node and not (self.some[2 * node] or self.some[2 * node + 1]):
                self.some[node] = 0
                node >>= 1
        return room, window_id


def best_fit(lengths, window=WINDOW):
    """(item, start, length, sequence, offset) for each piece of items of these lengths, in order of placing."""
    placed, n, rests = [], 0, []
    for item, length in enumerate(lengths):
        whole = length - length % window
        for start in range(0, whole, window):
            placed.append((item, start, window, n, 0))
            n += 1
        if length > whole:
            rests.append((length - whole, item, whole))
    room = Room(window)
    for length, item, start in sorted(rests, key=lambda x: (-x[0], x[1])):
        found = room.take(length)
        free, sequence = found or (window, n)
        n += found is None
        placed.append((item, start, length, sequence, window - free))
        if free > length:
            room.add(free - length, sequence)
    return placed, n


def long_space(part):
    """Whether the part has a white-space run of ``SPACE_RUN`` characters."""
    return len(part) >= SPACE_RUN and any(m.end() - m.start() >= SPACE_RUN for m in _SPACE.finditer(part))


class Tokens:
    """Ids of texts by a compiled merging library over the tokenizer file's own tokens."""

    def __init__(self, path):
        import tiktoken

        self.vocabulary = v = Vocabulary(path)
        byte_of = {s: b for b, s in v.symbol_of.items()}
        ranks = {bytes(byte_of[c] for c in s): i for s, i in v.ids.items() if s not in v.special}
        self.library = tiktoken.Encoding("own", pat_str=v.pattern.pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text):
        v, parts = self.vocabulary, []
        for no, part in enumerate(v.split_special.split(text)):
            if no % 2:
                parts.append(np.array([v.special[part]], "<u4"))
            elif v.unsure.search(part) or long_space(part):
                parts.append(np.array([i for p in v.pieces(part) for i in v.encode_piece(p)], "<u4"))
            elif part:
                parts.append(self.library.encode_to_numpy(part, disallowed_special=()).astype("<u4"))
        return np.concatenate(parts) if parts else np.empty(0, "<u4")


@functools.lru_cache(maxsize=2)
def tokens(path):
    return Tokens(path)


def _schema(kind):
    return T.StructType([T.StructField("doc", kind), *T._parse_datatype_string(
        "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, filled long").fields])


def _group(schema, rows, lengths, sequences, window):
    """Rows (doc, start, ids, doc_tokens) of these lengths, longer ones cut, as a batch of pieces; ``sequences`` names the first sequence."""
    placed, n = best_fit(lengths, window)
    item, start, length, sequence, offset = np.array(placed, np.int64).T
    filled = np.bincount(sequence, weights=length, minlength=n).astype(np.int64)[sequence]
    columns = [[rows[i][0] for i in item], start + np.array([rows[i][1] for i in item], np.int64), length,
               [rows[i][2][a:a + k].tobytes() for i, a, k in zip(item, start, length)],
               np.array([rows[i][3] for i in item], np.int64), sequence + sequences, offset, filled]
    kinds = to_arrow_schema(schema).types
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names), n


def _in_groups(rows, schema, window, group_tokens, first):
    """Batches of pieces from rows (doc, start, ids, doc_tokens), a group of about ``group_tokens`` ids at a time."""
    group, held = [], 0
    for row in rows:
        group.append(row)
        held += len(row[2])
        if held >= group_tokens:
            made, n = _group(schema, group, [len(r[2]) for r in group], first, window)
            first, group, held = first + n, [], 0
            yield made
    if group:
        yield _group(schema, group, [len(r[2]) for r in group], first, window)[0]


def packed(df, path, doc="doc_id", text="text", window=WINDOW, end_id=END_ID, group_tokens=GROUP_TOKENS, most_room=MOST_ROOM):
    """A row per piece: ``doc``, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are unsigned little-endian 32-bit numbers; ``start`` counts the document's ids before the piece, ``offset`` those
    before it in its sequence, and ``doc_tokens`` includes the end id. Sequence numbers are unique over all tasks.

    What a first pass over the tasks of the input packs is written once. Sequences that it left with more than ``most_room`` of their
    window free are packed again, in as many tasks as their number of tokens asks for, so that padding does not follow the layout.
    """
    rows = df.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    schema = _schema(rows.schema[0].dataType)

    def first_pass(batches):
        read, end = tokens(path).ids, np.array([end_id], "<u4")

        def coded():
            for batch in batches:
                for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    codes = np.concatenate([read(t or ""), end])
                    yield d, 0, codes, len(codes)

        return _in_groups(coded(), schema, window, group_tokens, TaskContext.get().partitionId() << _SEQUENCE_BITS)

    def second_pass(batches):
        def pieces():
            for batch in batches:
                for d, start, codes, n in zip(*[batch.column(i).to_pylist() for i in (0, 1, 3, 4)]):
                    yield d, start, np.frombuffer(codes, "<u4"), n

        return _in_groups(pieces(), schema, window, group_tokens, _SECOND | TaskContext.get().partitionId() << _SEQUENCE_BITS)

    done = stored(in_small_batches(rows).mapInArrow(first_pass, schema), "packed")
    roomy = (F.lit(window) - F.col("filled")) > F.lit(int(most_room * window))
    loose = done.where(roomy).agg(F.sum("length")).first()[0] or 0
    tasks = max(1, loose // (TASK_GROUPS * group_tokens))
    again = done.where(roomy).repartition(tasks, F.xxhash64("sequence_id", "offset")).mapInArrow(second_pass, schema)
    return done.where(~roomy).unionByName(again).drop("filled").withColumnRenamed("doc", doc)
