"""Near-duplicates by SimHash: fingerprints that differ in few bits, linked through BK-trees.

Fingerprints of distance up to ``RADIUS`` agree on one of RADIUS + 1 parts of their bits, so each part is a shard key and only
fingerprints of a shard are compared. A shard's members form a BK-tree: a member hangs below another under their Hamming
distance, and a search for a radius follows the edges whose distance is that near to the distance from the parent. Trees
are built and searched in the task that holds the shard, next to the members that ask, so none is broadcast. A shard with more
than ``SHARD_ROWS`` members is cut again by the bits its members don't share yet, in the same way, until none is too large.

Members of a shard that are linked, over others too, are told to the rest of the job as a star, never as pairs. Stars of all
shards are joined to components with large and small stars: each step ties neighbours to the smallest one, until nothing
changes. Documents of one fingerprint are one member throughout.

Defined cases: a NULL, empty or blank text has fingerprint 0 and is linked like any other; fewer words than a shingle are one
shingle; equal rows are in one component and all stay; a NULL document id never names a component unless there is no other; an
empty table gives an empty one; other columns are carried, and one called like a result column is replaced.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .columns import let, row_of, with_made

SHINGLE_WORDS = 3
RADIUS = 2
HASH_SEED = 42
#: Members of a shard that one task compares.
SHARD_ROWS = 16384
_BITS = 64
_BATCH_PAIRS = 1 << 18


# ---- Fingerprints ----

def fingerprint(text, words=SHINGLE_WORDS):
    """Bits set in over half of the hashes of all shingles, repeats included; 0 without words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = np.array([xxhash.xxh64_intdigest(s, seed=HASH_SEED) for s in shingles], ">u8")
    ones = np.zeros(_BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        some = hashes[start:start + (1 << 16)]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprints(df, text="text", words=SHINGLE_WORDS):
    """``df`` with ``fingerprint``, its 64 bits as a signed number."""
    def work(column):
        return pa.array(np.array([fingerprint(t, words) for t in column.to_pylist()], np.uint64).view(np.int64))

    return with_made(df, text, "fingerprint", T.LongType(), work)


# ---- BK-trees of many shards at once ----

def _distance(a, b):
    return np.bitwise_count(a ^ b).astype(np.int64)


def build_forest(members, shards):
    """(child, root): the node below each node at each distance, -1 if none, and each member's root. Members of a shard are
    next to each other. All members go down one edge per round; of those that reach a free place, the first stays."""
    n = len(members)
    first = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]]))
    root = np.repeat(first, np.diff(np.append(first, n)))
    child = np.full(n * (_BITS + 1), -1, np.int32)
    moving = np.flatnonzero(root != np.arange(n))
    at = root[moving]
    while len(moving):
        edge = at * (_BITS + 1) + _distance(members[moving], members[at])
        _, stays = np.unique(edge, return_index=True)
        child[edge[stays]] = moving[stays]
        at = child[edge].astype(np.int64)
        going = at != moving
        moving, at = moving[going], at[going]
    return child, root


def linked_in_shards(members, shards, radius=RADIUS):
    """For each member the first member of its shard that it is linked to, over others too."""
    child, root = build_forest(members, shards)
    label = np.arange(len(members))
    sizes = np.diff(np.append(np.flatnonzero(root == label), len(members)))
    asking = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    waiting = [(asking[i:i + 16384], root[asking[i:i + 16384]]) for i in range(0, len(asking), 16384)]
    while waiting:
        who, node = waiting.pop()
        if len(who) > _BATCH_PAIRS:
            half = len(who) // 2
            waiting += [(who[:half], node[:half]), (who[half:], node[half:])]
            continue
        apart = _distance(members[who], members[node])
        near = (apart <= radius) & (who < node)
        _join(label, who[near], node[near])
        below_who, below = [], []
        for step in range(-radius, radius + 1):
            edge = apart + step
            fits = (edge >= 0) & (edge <= _BITS)
            found = child[node[fits] * (_BITS + 1) + edge[fits]]
            there = found >= 0
            below_who.append(who[fits][there])
            below.append(found[there].astype(np.int64))
        if sum(map(len, below)):
            waiting.append((np.concatenate(below_who), np.concatenate(below)))
    return label


def _join(label, a, b):
    """Give linked members the smallest label of both sides, until all agree."""
    while len(a):
        low = np.minimum(label[a], label[b])
        apart = label[a] != label[b]
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label[:] = shorter
        a, b = a[apart], b[apart]


# ---- Shards ----

def _finer(mask, count):
    """Masks that fix, besides the bits of ``mask``, one of ``count`` parts of the others each."""
    def parts(free):
        def cut(j):
            return (F.size(free) * j / count).cast("int")

        return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda j: F.aggregate(
            F.slice(free, cut(j) + 1, cut(j + 1) - cut(j)), mask,
            lambda m, b: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))))

    return let(F.filter(F.sequence(F.lit(0), F.lit(_BITS - 1)), lambda b: F.getbit(mask, b) == 0), parts)


def _keyed(members, radius):
    """Each member once per part of the bits that its mask leaves: (fingerprint, mask, value)."""
    finer = members.select("fingerprint", F.explode(_finer(F.col("mask"), radius + 1)).alias("mask"))
    return finer.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))


def shard_members(fingerprints, radius=RADIUS, shard_rows=SHARD_ROWS):
    """(fingerprint, mask, value): shards of at most ``shard_rows`` members, together holding every pair within the radius."""
    if shard_rows < 2 ** radius:
        raise ValueError(f"a shard must have room for {2 ** radius} members")
    members, light = fingerprints.select("fingerprint", F.lit(0).cast("long").alias("mask")), None
    while True:
        keyed = _keyed(members, radius)
        heavy = stored(keyed.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows)
                       .select("mask", "value"), "heavy-shards")
        if heavy.isEmpty():
            return keyed if light is None else light.unionByName(keyed)
        rest = keyed.join(heavy, ["mask", "value"], "left_anti")
        light = rest if light is None else light.unionByName(rest)
        members = stored(keyed.join(heavy, ["mask", "value"], "left_semi").select("fingerprint", "mask"), "heavy-members")


def links(fingerprints, radius=RADIUS, shard_rows=SHARD_ROWS):
    """(a, b): every linked fingerprint of a shard with the first of its star there."""
    members = shard_members(fingerprints, radius, shard_rows).select("fingerprint", "mask", "value")
    members = members.repartition("mask", "value").sortWithinPartitions("mask", "value", "fingerprint")

    def stars(masks, values, found):
        shards = np.cumsum(np.concatenate([[0], (masks[1:] != masks[:-1]) | (values[1:] != values[:-1])]))
        label = linked_in_shards(found.view(np.uint64), shards, radius)
        linked = label != np.arange(len(label))
        return pa.RecordBatch.from_arrays(
            [pa.array(found[linked]), pa.array(found[label[linked]])], names=["a", "b"])

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            parts.append([batch.column(i).to_numpy() for i in (1, 2, 0)])
            n += batch.num_rows
            if n >= 2 * shard_rows:
                held = [np.concatenate(x) for x in zip(*parts)]
                last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
                cut = len(last) - int(last.sum())
                if cut:
                    yield stars(*[x[:cut] for x in held])
                parts, n = [[x[cut:] for x in held]], len(last) - cut
        if n:
            yield stars(*[np.concatenate(x) for x in zip(*parts)])

    return members.mapInArrow(run, "a long, b long")


# ---- Components ----

def stars_of(edges):
    """(a, b) with one row per node of a component except its smallest: b is the smallest. ``edges`` may point either way."""
    def state(e):
        return e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()

    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where(F.col("a") != F.col("b")).distinct(), "edges")
    before = None
    while True:
        now = tuple(state(edges))
        if now == before or not now[0]:
            return edges
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.distinct(), "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            least.select("a", F.col("low").alias("b")))
        edges = stored(small.distinct(), "edges")


def components(fingerprints, radius=RADIUS, shard_rows=SHARD_ROWS):
    """(fingerprint, first) with the smallest document of each as (fingerprint, root, component_id, first)."""
    tied = stars_of(links(fingerprints, radius, shard_rows))
    rooted = fingerprints.join(tied.withColumnRenamed("a", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("b", "fingerprint").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(smallest, "root")


def near_duplicates(df, doc="doc_id", text="text", words=SHINGLE_WORDS, radius=RADIUS, shard_rows=SHARD_ROWS):
    """``df`` with ``fingerprint`` (signed) and ``component_id``, the smallest document of those it is linked to."""
    kept = [c for c in df.columns if c.lower() not in ("fingerprint", "component_id")]
    marked = stored(with_fingerprints(df.select(row_of(kept).alias("row"), F.col(doc).alias("doc"), F.col(text).alias("text")),
                                      "text", words).drop("text"), "fingerprints")
    return _with_components(marked, "doc", radius, shard_rows).select("row.*", "fingerprint", "component_id")


def _with_components(marked, doc, radius, shard_rows):
    found = stored(marked.groupBy("fingerprint").agg(F.min(doc).alias("first")), "distinct-fingerprints")
    classes = components(found, radius, shard_rows).select("fingerprint", "component_id")
    return marked.join(classes, "fingerprint")


def one_of_each(df, doc="doc_id", text="text", words=SHINGLE_WORDS, radius=RADIUS, shard_rows=SHARD_ROWS):
    """The row of each component's smallest document, with its own columns; of equal ids in a component one row stays."""
    marked = stored(with_fingerprints(df.select(row_of(df.columns).alias("row"), F.col(doc).alias("doc"),
                                                F.col(text).alias("text")), "text", words).drop("text"), "fingerprints")
    found = stored(marked.groupBy("fingerprint").agg(F.min("doc").alias("first")), "distinct-fingerprints")
    classes = components(found, radius, shard_rows)
    chosen = classes.where(F.col("first").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("fingerprint").alias("fingerprint"), F.min("first").alias("chosen"))
    chosen = chosen.select(F.col("fingerprint").alias("chosen_fingerprint"), "chosen")
    same = (F.col("fingerprint") == F.col("chosen_fingerprint")) & F.col("doc").eqNullSafe(F.col("chosen"))
    return marked.join(chosen, same, "left_semi").dropDuplicates(["fingerprint", "doc"]).select("row.*")
