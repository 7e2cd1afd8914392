"""Exact search for the largest inner products, by branch and bound over ball trees.

Vectors are dealt into shards; the task that holds a shard builds a ball tree over it. A ball of centre c and radius r
holds no vector whose product with q is above q·c + |q| r. Blocks of queries go to every shard, and there down the tree: balls
are taken in order of their largest bound over the queries still interested, a query drops out of a ball whose bound is
below its current kth score, and what is left is scored exactly. Shards share kth scores. The one to start from comes from a
bounded sample of all vectors, so it is one that the result reaches at least. Shards are searched in waves, and each wave
starts from the kth scores that the waves before it have found together.

Components are whole numbers, floor(scale * x), and scores exact: in 64-bit floats while every product is below 2^53, in whole
numbers of any size beyond; a score outside 64 bits is set to the nearest one inside.

Defined cases: vectors that are NULL or hold a NULL or a component that is not finite, or not so once
scaled, take no part; only vectors of equal length are compared; equal rows are vectors of their own, and so are queries; ties
go to the smaller id, a NULL id last; fewer than k candidates give fewer rows; an empty table gives none; other columns are
not carried.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stored

SCALE = 1024.0
SHARD_ROWS = 8192
QUERY_BLOCK = 512
#: Vectors, chosen by hash, from which the first kth scores come.
SAMPLE_ROWS = 2048
LEAF_ROWS = 64
_NO_ID = np.iinfo(np.int64).max


def whole_numbers(vectors, scale=SCALE):
    """A matrix of floor(scale * x): floats where all products stay exact, else Python numbers."""
    given = np.array(vectors, np.float64)
    scaled = np.floor(given * scale)
    if given.size and not (np.abs(scaled).max() ** 2 * given.shape[1] < 2.0 ** 52):
        return np.array([int(x) for x in scaled.ravel()], object).reshape(given.shape)
    return scaled


def products(a, b):
    """Exact products of all rows of ``a`` with all rows of ``b``."""
    small = a.dtype != object and b.dtype != object
    if small and a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    return np.array([[min(max(sum(x * y for x, y in zip(p, q)), low), high) for q in whole[1]] for p in whole[0]],
                    np.int64).reshape(len(a), len(b))


class BallTree:
    """Balls over the rows of a matrix; each splits its rows in half along the line between two far ones."""

    def __init__(self, matrix, leaf_rows=LEAF_ROWS):
        self.points = matrix.astype(np.float64)
        self.centres, self.radii, self.halves, self.rows = [], [], [], []
        self._grow(np.arange(len(matrix)), leaf_rows)
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def _grow(self, rows, leaf_rows):
        points = self.points[rows]
        centre = points.mean(axis=0)
        with np.errstate(over="ignore", invalid="ignore"):
            away = np.nan_to_num(np.sqrt(((points - centre) ** 2).sum(axis=1)), nan=np.inf, posinf=np.inf)
        node = len(self.radii)
        self.centres.append(centre)
        self.radii.append(away.max() * (1 + 1e-9) + 1e-6)
        self.halves.append(None)
        self.rows.append(rows)
        if len(rows) > leaf_rows and away.max() > 0:
            far = points[away.argmax()]
            other = points[((points - far) ** 2).sum(axis=1).argmax()]
            order = np.argsort(points @ (far - other), kind="stable")
            half = len(rows) // 2
            self.rows[node] = None
            self.halves[node] = (self._grow(rows[order[:half]], leaf_rows), self._grow(rows[order[half:]], leaf_rows))
        return node


def search(tree, matrix, ids, row_nos, queries, own, floors, k):
    """(query, row) of the k best rows for each query, ties to the smaller id; ``floors`` are scores the kth one reaches."""
    n = len(queries)
    scores = np.full((n, k), np.iinfo(np.int64).min)
    rows = np.full((n, k), -1, np.int64)
    floats = queries.astype(np.float64)  # of the largest numbers, bounds may be infinite, which leaves nothing out
    norms = np.sqrt((floats ** 2).sum(axis=1))
    bounds = floats @ tree.centres.T + norms[:, None] * tree.radii[None, :]
    bounds += np.abs(bounds) * 1e-9 + 1.0
    bounds = np.nan_to_num(bounds, nan=np.inf, posinf=np.inf, neginf=-np.inf)
    kth = floors.copy()
    heap = [(-bounds[:, 0].max(), 0, np.arange(n))]
    while heap:
        _, node, asking = heapq.heappop(heap)
        asking = asking[bounds[asking, node] >= kth[asking]]
        if not len(asking):
            continue
        if tree.halves[node]:
            for half in tree.halves[node]:
                heapq.heappush(heap, (-bounds[asking, half].max(), half, asking))
            continue
        here = tree.rows[node]
        for start in range(0, len(here), 1024):
            _score(matrix, ids, row_nos, queries, own, asking, here[start:start + 1024], scores, rows, kth, k)
    query, rank = np.nonzero(rows >= 0)
    return query, rows[query, rank], scores[query, rank]


def _score(matrix, ids, row_nos, queries, own, asking, here, scores, rows, kth, k):
    found = products(queries[asking], matrix[here])
    mine = own[asking][:, None] == row_nos[here][None, :]
    better = ((found >= kth[asking][:, None]) & ~mine).any(axis=1)
    if not better.any():
        return
    asking, found, mine = asking[better], found[better], mine[better]
    place = np.where(mine, -1, here[None, :])
    all_rows = np.concatenate([rows[asking], place], axis=1)
    all_scores = np.concatenate([scores[asking], found], axis=1)
    all_ids = np.where(all_rows >= 0, ids[all_rows], _NO_ID)
    order = np.lexsort((all_ids, ~all_scores, all_rows < 0), axis=-1)[:, :k]
    scores[asking] = np.take_along_axis(all_scores, order, axis=1)
    rows[asking] = np.take_along_axis(all_rows, order, axis=1)
    full = rows[asking, -1] >= 0
    kth[asking[full]] = np.maximum(kth[asking[full]], scores[asking[full], -1])


def _by_length(vectors):
    lengths = {}
    for i, v in enumerate(vectors):
        lengths.setdefault(len(v), []).append(i)
    return {n: np.array(rows) for n, rows in lengths.items()}


def usable(df, key, vector, scale=SCALE):
    """(row_no, id, vector) of the vectors that take part, written once so that row numbers stay."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    fine = F.col("vector").isNotNull() & F.coalesce(F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (
        F.abs(v * scale) < float("inf"))), F.lit(False))
    rows = df.select(F.monotonically_increasing_id().alias("row_no"), F.col(key).cast("long").alias("id"), x.alias("vector"))
    return stored(rows.where(fine), "vectors")


def first_floors(rows, queries, k, sample_rows=SAMPLE_ROWS, scale=SCALE):
    """``queries`` with ``floor``: the kth score among a sample of at most ``sample_rows`` vectors, NULL if there are fewer."""
    chosen = rows.orderBy(F.xxhash64("row_no"), "row_no").limit(sample_rows).collect()
    numbers = np.array([r.row_no for r in chosen], np.int64)
    sample = {n: (numbers[at], [chosen[i].vector for i in at]) for n, at in _by_length([r.vector for r in chosen]).items()}

    def run(batches):
        whole = {n: (nos, whole_numbers(vs, scale)) for n, (nos, vs) in sample.items()}
        for batch in batches:
            own, vectors = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            floors = [None] * len(vectors)
            for n, at in _by_length(vectors).items():
                if n in whole and len(whole[n][0]) > k:
                    nos, matrix = whole[n]
                    found = products(whole_numbers([vectors[i] for i in at], scale), matrix)
                    found[own[at][:, None] == nos[None, :]] = np.iinfo(np.int64).min
                    for i, f in zip(at, np.partition(found, -k, axis=1)[:, -k]):
                        floors[i] = int(f)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors, pa.int64())], names=[*batch.schema.names, "floor"])

    return queries.mapInArrow(run, "row_no long, id long, vector array<double>, floor long")


#: The part of all shards that each wave searches but the last, which has the rest.
WAVES = (0.1, 0.3)


def waves_of(n_shards):
    """(first, end) of the shards of each wave: a few first, whose kth scores then hold for all others."""
    ends = sorted({*(math.ceil(n_shards * part) for part in WAVES), n_shards})
    return list(zip([0, *ends[:-1]], ends))


def top_k(df, is_query, key="vec_id", vector="embedding", k=10, scale=SCALE, shard_rows=SHARD_ROWS, query_block=QUERY_BLOCK):
    """The k highest products of each query row with all other rows: query_id, rank, ``key``, score."""
    rows = usable(df.select(F.col(key).alias(key), F.col(vector).alias(vector)), key, vector, scale)
    n_shards = max(1, math.ceil(rows.count() / shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row_no"), F.lit(n_shards)))
    asked = rows.drop("shard").where(F.expr(is_query) if isinstance(is_query, str) else is_query(F.col("id")))
    asked = stored(first_floors(rows.drop("shard"), asked, k, scale=scale), "queries")
    n_blocks, best = max(1, math.ceil(asked.count() / query_block)), None
    for first, end in waves_of(n_shards):
        found = searched(rows.where(F.col("shard").between(first, end - 1)), asked, first, end, n_blocks, k, scale)
        best = ranked(found if best is None else best.drop("rank").unionByName(found), k)
        if end < n_shards:
            best = stored(best, "best-so-far")
            kth = best.where(F.col("rank") == k).select("row_no", F.col("score").alias("kth"))
            asked = asked.join(kth, "row_no", "left").withColumn("floor", F.greatest("floor", "kth")).drop("kth")
    return best.select("query_id", "rank", F.col("id").alias(key), "score")


def ranked(found, k):
    """The k best rows of each query with ``rank``; tasks keep as many before the shuffle."""
    order = Window.partitionBy("row_no").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def searched(rows, asked, first, end, n_blocks, k, scale=SCALE):
    """(row_no, query_id, id, score): what the shards from ``first`` to before ``end`` have for each query, from its floor on."""
    one = F.struct("row_no", "id", "vector", "floor")
    blocks = asked.groupBy(F.pmod(F.xxhash64("row_no"), F.lit(n_blocks)).alias("block")).agg(F.collect_list(one).alias("qs"))
    everywhere = blocks.select(F.explode(F.sequence(F.lit(first).cast("long"), F.lit(end - 1).cast("long"))).alias("shard"),
                               F.col("block").alias("block"), F.lit(None).cast("long").alias("row_no"),
                               F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("vector"), "qs")
    kind = blocks.schema["qs"].dataType.simpleString()
    dealt = rows.select("shard", F.lit(-1).cast("long").alias("block"), "row_no", "id", "vector", F.lit(None).cast(kind).alias("qs"))
    both = dealt.unionByName(everywhere).repartition("shard").sortWithinPartitions("shard", "block")

    def answers(shard, qs):
        for n, at in _by_length([q["vector"] for q in qs]).items():
            if n not in shard:
                continue
            tree, matrix, ids, nulls, numbers = shard[n]
            low = np.iinfo(np.int64).min
            floors = np.array([low if qs[i]["floor"] is None else qs[i]["floor"] for i in at], np.int64)
            own = np.array([qs[i]["row_no"] for i in at], np.int64)
            query, row, score = search(tree, matrix, ids, numbers, whole_numbers([qs[i]["vector"] for i in at], scale),
                                       own, floors, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[query]), pa.array([qs[at[q]]["id"] for q in query], pa.int64()),
                 pa.array(ids[row], mask=nulls[row]), pa.array(score)], names=["row_no", "query_id", "id", "score"])

    def built(members):
        shard = {}
        for n, at in _by_length([m[2] for m in members]).items():
            matrix = whole_numbers([members[i][2] for i in at], scale)
            nulls = np.array([members[i][1] is None for i in at])
            ids = np.array([_NO_ID if members[i][1] is None else members[i][1] for i in at], np.int64)
            numbers = np.array([members[i][0] for i in at], np.int64)
            shard[n] = BallTree(matrix), matrix, ids, nulls, numbers
        return shard

    def run(batches):
        at, members, shard = None, [], None
        for batch in batches:
            names = ("shard", "block", "row_no", "id", "vector", "qs")
            for s, block, number, key_, x, qs in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]):
                if s != at:
                    at, members, shard = s, [], None
                if block < 0:
                    members.append((number, key_, x))
                else:
                    shard = built(members) if shard is None else shard
                    members = []
                    yield from answers(shard, qs)

    return both.mapInArrow(run, "row_no long, query_id long, id long, score long")
