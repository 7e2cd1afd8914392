"""Token counts without tokens: a deterministic transducer whose steps carry the number of tokens they add.

After some characters of a piece of text, what later characters can do depends on the longest ending that begins a token,
and for each place in that ending on the last token before it and the number of tokens up to it. That is a state; a
character leads to the next state and adds to the count (a negative number where it joins tokens). States and steps are
compiled when first met. A whole piece leads from the start back to the start, so it is one step of its own, also remembered.

A text is cut into chunks. A space after another character always ends a piece, whatever came before: it resets the
transducer. So the state map of a chunk is short: the text up to its first reset, whose count depends on the state at entry,
the count from there to its last reset, and the text after that, which stands for the state at exit. Two maps compose by putting
the rest of one and the beginning of the next together, a border text that is counted at once; composing is associative, so maps are
composed by pairs, a round of Spark for each doubling. A text without any reset (no white space behind another character) is one
border text from beginning to end, and is counted whole by the task that composes its last pair.

Special strings count as one token. Defined cases: a NULL text is empty and has no tokens; equal rows are counted each for
itself; an empty table gives an empty one; texts are counted whole; other columns are carried, and one called like a result
column is replaced.
"""

import functools
import math

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .bpe import Remembered, Vocabulary
from .columns import in_small_batches, place_of, row_of

CHUNK_CHARS = 1 << 16
#: Compiled states of a worker; when there are more it starts anew.
MOST_STATES = 150_000
_RESET = regex.compile(r"\S\s")


class Transducer:
    """States are numbers. ``places[state]`` is its ending, which begins a token, and (last token, tokens up to there less
    those up to here) for this place and, going back, for each place from which the ending begins a token: no other place
    matters to what follows. ``steps`` leads from a state and a character to the next state and the tokens added."""

    def __init__(self, path):
        self.vocabulary = v = Vocabulary(path)
        self.ids = {s: i for s, i in v.ids.items() if s not in v.special}
        self.beginnings = {s[:k] for s in self.ids for k in range(1, len(s) + 1)}
        self.counts = Remembered(self.count_piece)
        self.runs, self.known = {}, v.known_pairs.get
        self._forget()

    def _forget(self):
        self.steps = {}
        self.places = [("", ((None, 0),))]
        self.numbers = {self.places[0]: 0}

    def _places(self, ending):
        """How far back the places lie that a state has for an ending."""
        return [0, *(k for k in range(1, len(ending) + 1) if ending[-k:] in self.beginnings)]

    def _run(self, run):
        """What an ending and a character have in common for all states: tokens that end there, longest first, with the index
        of the place before them; the next ending; indexes of the places it keeps."""
        index = {k: i for i, k in enumerate(self._places(run[:-1]))}
        found = tuple((self.ids[run[-k:]], index[k - 1]) for k in range(len(run), 0, -1) if run[-k:] in self.ids)
        ending = run
        while ending not in self.beginnings:
            ending = ending[1:]
        return found, ending, tuple(index[k - 1] for k in self._places(ending)[1:])

    def _compile(self, state, symbol):
        """(next state, tokens added): the one token that ends here and may follow the last token before it."""
        ending, behind = self.places[state]
        run = ending + symbol
        common = self.runs.get(run)
        if common is None:
            if len(self.runs) >= MOST_STATES:
                self.runs.clear()
            common = self.runs[run] = self._run(run)
        found, ending, kept = common
        for token, place in found:
            last, before = behind[place]
            if last is None or self.known(last << 32 | token) or self.vocabulary.may_follow(last, token):
                break
        added = before + 1
        places = (ending, ((token, 0), *[(behind[i][0], behind[i][1] - added) for i in kept])) if kept else (ending, ((token, 0),))
        following = self.numbers.setdefault(places, len(self.places))
        if following == len(self.places):
            self.places.append(places)
        return following, added

    def count_piece(self, piece):
        symbols = piece.encode().decode("latin-1").translate(self.vocabulary.symbol_of)
        return self._by_symbols(symbols)

    def _by_symbols(self, symbols):
        if len(self.places) >= MOST_STATES:
            self._forget()
        state, n, step = 0, 0, self.steps.get
        for symbol in symbols:
            key = state << 9 | ord(symbol)
            following = step(key)
            if following is None:
                following = self.steps[key] = self._compile(state, symbol)
            state, added = following
            n += added
        return n

    def count(self, text):
        n, of = 0, self.counts.__getitem__
        for special, pieces in self.vocabulary.segments(text):
            n += 1 if pieces is None else sum(map(of, pieces))
        return n

    def state_map(self, chunk, whole):
        """(head, n_tokens, tail, passes): ``passes`` if the chunk has no reset; a ``whole`` text needs no border."""
        if whole:
            return "", self.count(chunk), "", False
        first = _RESET.search(chunk)
        if not first:
            return chunk, 0, "", True
        head, tail = first.start() + 1, len(chunk)
        while not _RESET.match(chunk, tail - 1):
            tail -= 1
        return chunk[:head], self.count(chunk[head:tail]), chunk[tail:], False


@functools.lru_cache(maxsize=2)
def transducer(path):
    return Transducer(path)


_MAP = "head string, n_tokens long, tail string, passes boolean"


def _state_maps(df, path):
    """``df`` with (row_no, row, n_chunks, chunk_no, chunk) as (row_no, row, n_chunks, chunk_no, map)."""
    schema = T.StructType([*df.schema.fields[:4], *T._parse_datatype_string(_MAP).fields])

    def run(batches):
        of = transducer(path).state_map
        for batch in batches:
            maps = [of(c, n == 1) for n, c in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())]
            made = [pa.array([m[i] for m in maps], kind) for i, kind in enumerate(
                (pa.string(), pa.int64(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *made], names=schema.names)

    return in_small_batches(df).mapInArrow(run, schema)


def _counted_too(df, path, borders):
    """``df`` with the tokens of the text columns ``borders`` added to ``n_tokens``, and without these columns."""
    kept = [c for c in df.columns if c not in borders]
    schema = T.StructType([df.schema[c] for c in kept])

    def run(batches):
        count = transducer(path).count
        for batch in batches:
            more = [sum(count(t) for t in texts if t) for texts in zip(*[batch.column(c).to_pylist() for c in borders])]
            columns = [pc.add(batch.column(c), pa.array(more, pa.int64())) if c == "n_tokens" else batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(columns, names=kept)

    return in_small_batches(df).mapInArrow(run, schema)


def _by_pairs(maps, path):
    """One round of the scan: the maps of chunks 2i and 2i + 1 of a row composed to map i, on whatever task the pair falls."""
    pair = F.array_sort(F.collect_list(F.struct("chunk_no", "head", "n_tokens", "tail", "passes", "row")))
    pairs = maps.groupBy("row_no", F.floor(F.col("chunk_no") / 2).cast("int").alias("pair_no")).agg(
        F.any_value("n_chunks").alias("n_chunks"), pair.alias("ms"))
    left, right = F.col("ms")[0], F.get("ms", F.lit(1))
    alone, through, on = right.isNull(), left["passes"], right["passes"]
    composed = pairs.select(
        "row_no", left["row"].alias("row"), "n_chunks", F.col("pair_no").alias("chunk_no"),
        F.when(~alone & through, F.concat(left["head"], right["head"])).otherwise(left["head"]).alias("head"),
        (left["n_tokens"] + F.coalesce(right["n_tokens"], F.lit(0))).alias("n_tokens"),
        F.when(alone, left["tail"]).when(on, F.concat(left["tail"], F.when(through, "").otherwise(right["head"])))
        .otherwise(right["tail"]).alias("tail"),
        F.when(alone, through).otherwise(through & on).alias("passes"),
        F.when(~alone & ~through & ~on, F.concat(left["tail"], right["head"])).alias("border"))
    return _counted_too(composed, path, ["border"])


def counted(df, path, text="text", chunk_chars=CHUNK_CHARS):
    """The columns of ``df`` but ``text``, and ``n_tokens``. Chunks are mapped in the task that reads the row; their maps meet in a
    scan by pairs, a round for each doubling of the number of chunks."""
    at = place_of(df.columns, text)
    kept = [c for i, c in enumerate(df.columns) if c.lower() != "n_tokens" and i != at]
    string = F.coalesce(F.col(text), F.lit(""))
    pieces = F.when(F.length(string) <= chunk_chars, F.array(string)).otherwise(
        F.regexp_extract_all(string, F.lit("(?s).{1,%d}+" % chunk_chars), F.lit(0)))
    rows = df.select(F.monotonically_increasing_id().alias("row_no"), row_of(kept).alias("row"), pieces.alias("pieces"))
    chunks = rows.select("row_no", "row", F.size("pieces").alias("n_chunks"), F.posexplode("pieces").alias("chunk_no", "chunk")).select(
        "row_no", F.when(F.col("chunk_no") == 0, F.col("row")).alias("row"), "n_chunks", "chunk_no", "chunk")
    maps = stored(_state_maps(chunks, path), "state-maps")
    parts = maps.where("n_chunks > 1")
    most = parts.agg(F.max("n_chunks")).first()[0] or 1
    for _ in range(math.ceil(math.log2(most))):
        parts = _by_pairs(parts, path)
    parts = parts.withColumn("tail", F.when(~F.col("passes"), F.col("tail"))).select("row", "n_tokens", "head", "tail")
    whole = maps.where("n_chunks = 1").select("row", "n_tokens").unionByName(_counted_too(parts, path, ["head", "tail"]))
    return whole.select(*[F.col("row").getField(c).alias(c) for c in kept], "n_tokens")
