"""Documents linked by the Jaccard similarity of their word n-grams: a size-aware join of small and large sets, exact.

Sets are those of distinct n-grams, each as a 64-bit hash; documents with equal sets (by a 128-bit hash) are one class and
compared once. Two sets of sizes a and b link if they share at least c(a, b) n-grams, so sizes differ by little.

Small sets: each writes a key for every one of its subsets of c(a, b) n-grams, for every size b it may link to. Sets that share a key
link; so a key's sets are tied to one of the smaller size as a star, and no pair is listed. A subset is its two sums of hashes.

Large sets (and the small ones near the boundary): inverted lists. A global order puts n-grams with a hash in the first ``BAND`` of
all in front, there the rarer ones first; linked sets have one of the first |a| - c + 1 n-grams of both in common, so only these
go into lists, and only as far as what follows there could suffice. Sets that meet in long lists get others, by an order over all of
their n-grams. Lists are scanned in rounds. In each, a list chooses leaders, those of the smallest component first; all others that
are not in the leader's component, and may share enough, are compared with it by their whole texts, and then it leaves the
list. What is left of a list whose members are all connected by then needs no comparison. So a group of near copies costs about its
size times the number of its members that stay apart.

The boundary is the size for which the rows of both ways, over the sizes that occur, are the fewest. Results don't depend on it, nor
on the band. Joins by list or leader may have large keys; they are plain equi-joins, which adaptive execution splits. A filter of
``FILTER_BITS`` bits, so of bounded size, tells which texts are fetched for comparison; a join follows it.

Defined cases: a NULL, empty or blank text has an empty set, is linked with none and is its own component; texts with fewer words than
an n-gram have their whole sequence as the one; equal rows stay rows of their own and are linked; a NULL id never names
a component unless there is no other; an empty table gives an empty one; texts are read whole; other columns are not carried.
"""

from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .columns import in_small_batches
from .simhash import stars_of

WORDS = 3
#: Two sets link if their intersection is at least so large a part of their union: 90 of 100.
SIMILARITY = (90, 100)
#: Sets of more n-grams are never small.
SMALL_MOST = 40
#: N-grams whose hash lies in this part of the hashes are ordered by frequency; it must exceed one less the similarity.
BAND = 0.2
#: Sets in lists with more members get lists by an order of their own.
LONG_LIST = 64
#: A list's leaders in the first round, by how much there are more in each round, and how many at most.
LEADERS, MORE, MOST_LEADERS = 1, 16, 4096
FILTER_BITS = 1 << 26
_CHUNK = 1 << 20
_LONG_WORD = 256


# ---- Sets ----

def _mixed(x):
    """A bijection of 64-bit numbers without visible structure."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
    _POWER = np.cumprod(np.full(_LONG_WORD, _ODD, np.uint64))
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE[_SPACE] = 0


def _chunks(data):
    """Parts of about a million bytes that end between words."""
    start = 0
    while start < len(data):
        end = min(start + _CHUNK, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[start:end]
        start = end


def _word_hashes(data):
    raw = np.frombuffer(data, np.uint8)
    blank = _SPACE[raw]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(starts):
        return np.empty(0, np.uint64)
    ends = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw)))) if starts[0] == 0 else (
        np.arange(len(raw)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(raw)]]))))
    parts = _BYTE[raw] * _POWER[np.minimum(place, _LONG_WORD - 1)]
    found = np.add.reduceat(parts, starts) + (ends - starts).astype(np.uint64)
    for i in np.flatnonzero(ends - starts > _LONG_WORD):
        found[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]])
    return _mixed(found)


def ngram_set(text, words=WORDS):
    """The hashes of a text's distinct n-grams of lower-case (A-Z) words, in rising order."""
    with np.errstate(over="ignore"):
        parts = [_word_hashes(c) for c in _chunks((text or "").encode().lower())]
        hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        if not len(hashes):
            return hashes
        n = min(words, len(hashes))
        grams = np.full(len(hashes) - n + 1, n, np.uint64)
        for i in range(n):
            grams = (grams + hashes[i:len(hashes) - n + 1 + i]) * _ODD
            grams ^= grams >> np.uint64(29)
        return np.unique(_mixed(grams))


# ---- Sizes ----

def _up(a, b):
    return -(-a // b)


def least_shared(a, b, similarity=SIMILARITY):
    """N-grams that linked sets of these sizes share at least."""
    part, whole = similarity
    return _up(part * (a + b), part + whole)


def partners(a, similarity=SIMILARITY):
    """Sizes of sets that one of size ``a`` may link to."""
    part, whole = similarity
    return range(_up(part * a, whole), a * whole // part + 1)


def prefix_size(a, similarity=SIMILARITY):
    part, whole = similarity
    return a - _up(part * a, whole) + 1


def least_size(similarity=SIMILARITY):
    """The smallest set that may link to a different one."""
    part, whole = similarity
    return _up(part, whole - part)


def subsets(a, most, similarity=SIMILARITY):
    """(b, c) for sizes b up to ``most``: what a set of size ``a`` writes subsets of c n-grams for. Equal sets are one class."""
    found = ((b, least_shared(a, b, similarity)) for b in partners(a, similarity) if b <= most)
    return [(b, c) for b, c in found if c < max(a, b) and c <= min(a, b)]


def boundary(counts, similarity=SIMILARITY, most=SMALL_MOST):
    """The largest size of a small set: the one with the fewest rows, where ``counts`` has the number of sets by size.

    A small set costs a row per subset, one in the lists a row per n-gram. Sets that are larger than ``most`` are in lists in any case.
    """
    low = least_size(similarity)

    def rows(x):
        small = sum(counts.get(a, 0) * sum(comb(a, c) for _, c in subsets(a, x, similarity)) for a in range(low, x + 1))
        return small + sum(counts.get(a, 0) * a for a in range(max(low, partners(x + 1, similarity).start), most + 1))

    return min(range(low - 1, most + 1), key=lambda x: (rows(x), x))


# ---- Classes ----

def _band_end(band):
    return int(band * 2 ** 64)


def marked(df, doc, text, words, similarity, band):
    """(row_no, doc, text_key, n, in_band, digest, tokens): tokens are those before all others in the global order."""
    rows = df.select(F.monotonically_increasing_id().alias("row_no"), F.col(doc).alias("doc"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.unhex(F.sha2("text", 256))).select("row_no", "doc", "text_key", "text")
    schema = T.StructType([*rows.schema.fields[:3], *T._parse_datatype_string(
        "n long, in_band long, digest binary, tokens array<long>").fields])

    def run(batches):
        for batch in batches:
            sizes, inside, digests, tokens = [], [], [], []
            for t in batch.column(3).to_pylist():
                found = ngram_set(t, words)
                n = len(found)
                k = int(np.searchsorted(found, np.uint64(_band_end(band))))
                sizes.append(n)
                inside.append(k)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                tokens.append(found[:n if n <= SMALL_MOST else max(k, prefix_size(n, similarity))].view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in tokens])]).astype(np.int32)
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(inside, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))], names=schema.names)

    return stored(in_small_batches(rows).mapInArrow(run, schema), "ngram-sets")


# ---- Small sets ----

@lru_cache(maxsize=4096)
def _left_out(a, k):
    return np.array(list(combinations(range(a), k)), np.int64).reshape(comb(a, k), k)


def subset_keys(small, most, similarity=SIMILARITY):
    """(low, high, sum1, sum2, cls, n): a row per subset of a small set (cls, n, tokens)."""
    schema = "low long, high long, sum1 long, sum2 long, cls long, n long"

    def run(batches):
        for batch in batches:
            rows = [[] for _ in range(6)]
            for cls, n, tokens in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                with np.errstate(over="ignore"):
                    one = np.array(tokens, np.int64).view(np.uint64)
                    two = _mixed(one + _ODD)
                    for b, c in subsets(n, most, similarity):
                        out = _left_out(n, n - c)
                        made = (np.full(len(out), min(n, b)), np.full(len(out), max(n, b)), (one.sum() - one[out].sum(axis=1)).view(np.int64),
                                (two.sum() - two[out].sum(axis=1)).view(np.int64), np.full(len(out), cls), np.full(len(out), n))
                        for column, values in zip(rows, made):
                            column.append(values)
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in rows],
                                                 names=["low", "high", "sum1", "sum2", "cls", "n"])

    return in_small_batches(small.select("cls", "n", "tokens")).mapInArrow(run, schema)


def small_links(small, most, similarity=SIMILARITY):
    """(a, b): the sets of each key with the first one of the smaller size."""
    keyed, key = stored(subset_keys(small, most, similarity), "subset-keys"), ["low", "high", "sum1", "sum2"]
    centres = keyed.groupBy(*key).agg(F.count("*").alias("many"), F.min(F.when(F.col("n") == F.col("low"), F.col("cls"))).alias("b"))
    centres = centres.where((F.col("many") > 1) & F.col("b").isNotNull()).drop("many")
    return keyed.join(centres, key).where(F.col("cls") != F.col("b")).select(F.col("cls").alias("a"), "b").distinct()


# ---- Inverted lists ----

#: What a list is: the order it was made by, and its n-gram.
LIST = ["level", "token"]


def _least_shared(n, m, similarity):
    part, whole = similarity
    return F.ceil((n + m) * F.lit(part) / F.lit(part + whole))


def _fits(n, m, similarity):
    part, whole = similarity
    return F.least(n, m) * whole >= F.greatest(n, m) * part


def inverted_lists(sets, level=0, similarity=SIMILARITY):
    """(level, token, cls, n, place): the first n-grams of each set in the global order, but those that no other set offers.

    ``place`` is the number of a set's n-grams before the token. Sets that have the token in common, but none before it, share
    at most those from there on; a member whose rest is too short for the smallest set of a list is left out of it.
    """
    part, whole = similarity
    offered = sets.select("cls", "n", "in_band", F.posexplode("tokens").alias("at", "token"))
    shared = offered.groupBy("token").agg(F.count("*").alias("many")).where("many > 1")
    found = offered.join(shared, "token")
    in_front = F.col("at") < F.col("in_band")
    whole_set = Window.partitionBy("cls")
    rank = F.row_number().over(whole_set.orderBy(F.when(in_front, 0).otherwise(1), "many", "at"))
    alone = F.col("in_band") - F.count(F.when(in_front, 1)).over(whole_set)
    place = F.when(in_front, alone + rank - 1).otherwise(F.col("at"))
    least = F.ceil(F.col("n") * F.lit(part) / F.lit(whole))
    lists = found.withColumn("place", place.cast("long")).where(F.col("place") < F.col("n") - least + 1).select(
        F.lit(level).alias("level"), "token", "cls", "n", "place")
    return lists


def _useful(lists, similarity):
    """``lists`` without the members that can link to none of their list, and without lists of one."""
    part, whole = similarity
    smallest = lists.groupBy(*LIST).agg(F.min("n").alias("low"), F.count("*").alias("many")).where("many > 1").drop("many")
    partner = F.greatest("low", F.ceil(F.col("n") * F.lit(part) / F.lit(whole)))
    return lists.join(smallest, LIST).where(F.col("n") - F.col("place") >= _least_shared(F.col("n"), partner, similarity)).drop("low")


def all_lists(large, classes, df, text, keys, words=WORDS, similarity=SIMILARITY, long_list=LONG_LIST):
    """The lists of all large sets. Sets in lists of more than ``long_list`` members get others instead, by an order of their own.

    There all n-grams are ordered by frequency among these sets, so what a near copy has for itself comes first, not only the part
    of it that lies in the band. Each pair that a long list would have found has both sets there.
    """
    lists = stored(_useful(inverted_lists(large, 0, similarity).join(classes.select("cls"), "cls", "left_semi"), similarity), "lists")
    long = stored(lists.groupBy(*LIST).agg(F.count("*").alias("many")).where(F.col("many") > long_list).select(*LIST), "long-lists")
    if long.isEmpty():
        return lists
    crowded = stored(lists.join(long, LIST, "left_semi").select("cls").distinct(), "crowded-sets")
    again = stored(whole_sets(texts_of(df, text, keys.join(crowded, "cls", "left_semi")), words), "whole-sets")
    return lists.join(long, LIST, "left_anti").unionByName(_useful(inverted_lists(again, 1, similarity), similarity))


def whole_sets(texts, words=WORDS):
    """(cls, n, in_band, tokens) of (cls, text): all n-grams, all of them ordered by frequency."""
    def run(batches):
        for batch in batches:
            sets = [ngram_set(t, words).view(np.int64) for t in batch.column(1).to_pylist()]
            sizes = pa.array([len(x) for x in sets], pa.int64())
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32), pa.int32())
            flat = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, sizes, pa.ListArray.from_arrays(offsets, flat)],
                                             names=["cls", "n", "in_band", "tokens"])

    return in_small_batches(texts.select("cls", "text")).mapInArrow(run, "cls long, n long, in_band long, tokens array<long>")


def open_lists(lists, stars):
    """``lists`` with ``comp``, those whose members are in more than one component."""
    rows = lists.join(stars.withColumnRenamed("a", "cls"), "cls", "left").select(
        *LIST, "cls", "n", "place", F.coalesce("b", "cls").alias("comp"))
    apart = rows.groupBy(*LIST).agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select(*LIST)
    return rows.join(apart, LIST, "left_semi")


def with_comp_sizes(rows):
    """``rows`` of open lists with ``comp_size``, the number of their sets in a component."""
    sizes = rows.select("cls", "comp").distinct().groupBy("comp").agg(F.count("*").alias("comp_size"))
    return rows.join(sizes, "comp")


def leaders_of(lists, k):
    """(level, token, leader, m, ahead, leader_comp): up to ``k`` members per list, of the smallest components, there those with the
    fewest n-grams of their own first; tasks keep as many before the shuffle."""
    first = Window.partitionBy(*LIST).orderBy("comp_size", "place", F.xxhash64("cls"), "cls")
    return lists.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select(
        *LIST, F.col("cls").alias("leader"), F.col("n").alias("m"), F.col("place").alias("ahead"), F.col("comp").alias("leader_comp"))


def _filter_bit(key):
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def texts_of(df, text, wanted):
    """(cls, text) for (cls, text_key): a text per class, fetched through a bit filter of bounded size and a join."""
    spark, words = df.sparkSession, FILTER_BITS // 64
    bit = _filter_bit("text_key")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    bits = np.zeros(words, np.int64)
    for row in wanted.groupBy(F.floor(bit / 64).alias("word")).agg(F.bit_or(one).alias("bits")).toLocalIterator():
        bits[row.word] = row.bits
    known = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def may_be(places: pd.Series) -> pd.Series:
        return (known.value[places // 64] >> (places % 64)) & 1 == 1

    rows = df.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.unhex(F.sha2("text", 256))).where(may_be(_filter_bit("text_key")))
    return stored(rows.groupBy("text_key").agg(F.first("text").alias("text")).join(wanted, "text_key").select("cls", "text"), "compared-texts")


def linked_pairs(pairs, texts, words=WORDS, similarity=SIMILARITY):
    """The (a, b) of ``pairs`` whose sets link, by their whole texts."""
    part, whole = similarity
    one = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    both = one.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        last, held = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            link = []
            for i, t, u in zip(b, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if i != last:
                    last, held = i, ngram_set(u, words)
                found = ngram_set(t, words)
                shared = len(np.intersect1d(found, held, assume_unique=True))
                link.append(shared * whole >= part * (len(found) + len(held) - shared))
            yield pa.RecordBatch.from_pydict({"a": [x for x, y in zip(a, link) if y], "b": [x for x, y in zip(b, link) if y]},
                                             pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return in_small_batches(both).mapInArrow(run, "a long, b long")


def large_links(lists, edges, df, text, keys, words=WORDS, similarity=SIMILARITY):
    """``edges`` (a, b) and the links of the lists' members, enough of them to connect all that are linked.

    ``keys`` has (cls, text_key), from which texts are fetched. A pair is compared in one round only.
    """
    tried, texts, k = None, None, LEADERS
    while True:
        rows = stored(open_lists(lists, stars_of(edges)), "open-lists")
        if rows.isEmpty():
            return edges
        if texts is None:
            texts = texts_of(df, text, keys.join(rows.select("cls").distinct(), "cls", "left_semi"))
        leaders = stored(leaders_of(with_comp_sizes(rows), k), "leaders")
        shared = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("ahead"))
        pairs = rows.join(leaders, LIST).where(
            (F.col("comp") != F.col("leader_comp")) & _fits(F.col("n"), F.col("m"), similarity)
            & (shared >= _least_shared(F.col("n"), F.col("m"), similarity)))
        pairs = pairs.select(F.greatest("cls", "leader").alias("a"), F.least("cls", "leader").alias("b")).distinct()
        pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        edges = edges.unionByName(stored(linked_pairs(pairs, texts, words, similarity), "links"))
        done = leaders.select(*LIST, F.col("leader").alias("cls"))
        lists, k = rows.join(done, [*LIST, "cls"], "left_anti").drop("comp"), min(k * MORE, MOST_LEADERS)


def linked_documents(df, doc="doc_id", text="text", words=WORDS, similarity=SIMILARITY, band=BAND):
    """(``doc``, n_shingles, component_id): a row per document; ``component_id`` is the smallest id reachable by links."""
    part, whole = similarity
    if not 0 < part <= whole or band <= 1 - part / whole:
        raise ValueError("the similarity must lie above zero, and the band above one less the similarity")
    rows = marked(df, doc, text, words, similarity, band)
    classes = stored(rows.where("n > 0").groupBy("digest").agg(
        F.min("row_no").alias("cls"), F.min("doc").alias("first"), F.min("n").alias("n")), "classes")
    low = least_size(similarity)
    counts = dict(classes.where(F.col("n").between(low, SMALL_MOST)).groupBy("n").count().collect())
    most = boundary(counts, similarity)
    first_rows = classes.select(F.col("cls").alias("row_no"))
    small = rows.where(F.col("n").between(low, most)).join(first_rows, "row_no", "left_semi").withColumnRenamed("row_no", "cls")
    large = rows.where(F.col("n") >= max(low, partners(most + 1, similarity).start)).withColumnRenamed("row_no", "cls")
    keys = rows.select(F.col("row_no").alias("cls"), "text_key")
    lists = all_lists(large, classes, df, text, keys, words, similarity)
    edges = stored(small_links(small, most, similarity), "links")
    tied = stars_of(large_links(lists, edges, df, text, keys, words, similarity)).withColumnRenamed("a", "cls")
    rooted = classes.join(tied, "cls", "left").select("digest", "first", F.coalesce("b", "cls").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("digest", "component_id")
    found = rows.where("n > 0").select("doc", "n", "digest").join(named, "digest").select("doc", "n", "component_id")
    alone = rows.where("n = 0").select("doc", "n", F.col("doc").alias("component_id"))
    return found.unionByName(alone).select(F.col("doc").alias(doc), F.col("n").alias("n_shingles"), "component_id")
