"""Uniform random shards of exact sizes.

The rows of each input partition are put in random order, the number of rows that go from each partition to each shard
is drawn from the multivariate hypergeometric law, rows are exchanged by these numbers, and each shard is put in random
order again. So every order of all rows over the shards is equally likely, and shard sizes differ by one row at most.

The matrix of numbers is drawn by halves: of the rows for each shard, how many lie in the first half of the partitions, and
so on down to single partitions. A node of this tree is a row, so a level is one pass of Spark over its nodes.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stored
from .columns import let, row_of

SEED = 20240611
#: Rows that are put in order together; a shard has as many blocks of them as it needs.
BLOCK_ROWS = 8192
#: Levels of the tree of draws that one task makes; below, the nodes are spread.
SPREAD_LEVEL = 5
_PART_BITS = 33  # monotonically_increasing_id(): partition above, place in it below


def _ln_factorial(n):
    """Natural logarithm of n!: exact below 20, Stirling's series above (error under 1e-13)."""
    x = n.cast("double")
    series = ((x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
              + 1 / (1260 * F.pow(x, F.lit(5.0))))
    return F.when(n < 20, F.log(F.factorial(n.cast("int")).cast("double"))).otherwise(series)


def hypergeometric(total, marked, draws, u):
    """How many of ``draws`` rows out of ``total`` are among the ``marked`` ones, by inversion of ``u`` in [0, 1).

    Probabilities are taken off ``u`` from the mode outwards; the walk covers twelve standard deviations on both sides. They are
    doubles that start from a difference of logarithms of factorials: with N rows the first has a relative error of about
    N log(N) 2^-53, below a millionth up to 10^8 rows and about a thousandth at 10^11. Numbers of rows add up exactly at any size.
    """
    given = F.struct(total.cast("long").alias("total"), marked.cast("long").alias("marked"), draws.cast("long").alias("draws"),
                     u.alias("u"))
    return let(given, lambda g: let(_mode(g), lambda m: let(_at_mode(g, m), lambda p: _walked(g, m, p))))


def _mode(g):
    low = F.greatest(F.lit(0).cast("long"), g["draws"] + g["marked"] - g["total"])
    high = F.least(g["draws"], g["marked"])
    middle = F.floor((g["draws"] + 1).cast("double") * (g["marked"] + 1) / (g["total"] + 2))
    share = g["marked"] / F.greatest(g["total"], F.lit(1))
    width = F.sqrt(g["draws"] * share * (1 - share) * (g["total"] - g["draws"]) / F.greatest(g["total"] - 1, F.lit(1)))
    return let(F.struct(low.alias("low"), high.alias("high")), lambda b: F.struct(
        b["low"].alias("low"), b["high"].alias("high"), F.greatest(b["low"], F.least(b["high"], middle)).alias("at"),
        F.least(b["high"] - b["low"], F.ceil(width * 12) + 30).alias("steps")))


def _at_mode(g, m):
    """Probability of the mode."""
    rest = g["total"] - g["marked"]
    over = [g["marked"], rest, g["draws"], g["total"] - g["draws"]]
    under = [m["at"], g["marked"] - m["at"], g["draws"] - m["at"], rest - g["draws"] + m["at"], g["total"]]
    return F.exp(F.aggregate(F.array(*over), F.lit(0.0), lambda a, n: a + _ln_factorial(n))
                 - F.aggregate(F.array(*under), F.lit(0.0), lambda a, n: a + _ln_factorial(n)))


def _walked(g, m, at_mode):
    def state(u, up, down, found):
        return F.struct(u.alias("u"), up.alias("up"), down.alias("down"), found.alias("found"))

    def walk(s, k):
        x, y, rest = m["at"] + k - 1, m["at"] - k + 1, g["total"] - g["marked"] - g["draws"]
        up = s["up"] * (g["marked"] - x) * (g["draws"] - x) / ((x + 1) * (rest + x + 1))
        down = s["down"] * y * (rest + y) / ((g["marked"] - y + 1) * (g["draws"] - y + 1))
        ways = F.struct(F.when(x < m["high"], up).otherwise(0.0).alias("up"), F.when(y > m["low"], down).otherwise(0.0).alias("down"))

        def off(w):
            after = s["u"] - w["up"]
            hit = F.when(after < 0, m["at"] + k).when(after - w["down"] < 0, m["at"] - k)
            return state(after - w["down"], w["up"], w["down"], hit)

        return F.when(s["found"].isNotNull(), s).otherwise(let(ways, off))

    none = F.lit(None).cast("long")
    start = state(g["u"] - at_mode, at_mode, at_mode, F.when(g["u"] < at_mode, m["at"]).otherwise(none))
    steps = F.when(m["steps"] > 0, F.sequence(F.lit(1).cast("long"), m["steps"])).otherwise(F.array().cast("array<bigint>"))
    return F.coalesce(F.aggregate(steps, start, walk)["found"], m["at"])


def _unit(*parts):
    """A number in [0, 1) that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0 ** -53)


def _halved(nodes, seed):
    """Each node with more than one partition as its two halves."""
    half = (F.size("parts") / 2).cast("int")
    split = nodes.withColumn("left", F.slice("parts", F.lit(1), half)).withColumn(
        "draws", F.aggregate("left", F.lit(0).cast("long"), lambda a, p: a + p["n"]))

    def take(state, cap, i):
        got = hypergeometric(state["total"], cap, state["draws"], _unit(F.lit(seed), F.col("first"), F.size("parts"), i))
        return let(got, lambda x: F.struct((state["total"] - cap).alias("total"), (state["draws"] - x).alias("draws"),
                                           F.concat(state["out"], F.array(x)).alias("out")))

    total = F.aggregate("caps", F.lit(0).cast("long"), lambda a, c: a + c)
    empty = F.struct(total.alias("total"), F.col("draws"), F.array().cast("array<bigint>").alias("out"))
    indexed = F.transform("caps", lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    drawn = split.withColumn("got", F.when(F.size("parts") > 1, F.aggregate(
        indexed, empty, lambda s, c: take(s, c["c"], c["i"]), lambda s: s["out"])))
    one = F.array(F.struct("first", "parts", "caps"))
    two = F.array(
        F.struct("first", F.col("left").alias("parts"), F.col("got").alias("caps")),
        F.struct((F.col("first") + half).alias("first"),
                 F.slice("parts", half + 1, F.greatest(F.size("parts") - half, F.lit(0))).alias("parts"),
                 F.zip_with("caps", "got", lambda c, g: c - g).alias("caps")))
    return drawn.select(F.explode(F.when(F.size("parts") > 1, two).otherwise(one)).alias("x")).select("x.*")


def communication_matrix(part_sizes, n_parts, n_rows, n_shards, seed=SEED):
    """Rows per shard for each partition: (part, counts), from (part, n). ``n_parts`` and ``n_rows`` are its totals."""
    base, more = divmod(n_rows, n_shards)
    caps = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)),
                       lambda s: F.lit(base).cast("long") + F.when(s < more, 1).otherwise(0).cast("long"))
    nodes = part_sizes.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("parts")).where(
        F.size("parts") > 0).select(F.lit(0).alias("first"), "parts", caps.alias("caps"))
    for level in range(math.ceil(math.log2(max(n_parts, 1)))):
        if level == SPREAD_LEVEL:
            nodes = nodes.repartition(1 << SPREAD_LEVEL, "first")  # from here on each task draws a part of the tree
        nodes = _halved(nodes, seed)
    return nodes.select(F.col("parts")[0]["part"].alias("part"), F.col("caps").alias("counts"))


def uniform_shards(df, n_shards, seed=SEED, block_rows=BLOCK_ROWS):
    """All rows of ``df`` with ``shard`` (0 to n_shards - 1) and ``slot``, its place there (0 and up without gaps).

    Rows are written once with their random numbers, so a rerun of a lost task cannot deal them out differently. The matrix
    has a row per input partition. Equal rows are rows of their own; NULLs anywhere are carried; a table with fewer rows
    than shards leaves some shards empty, an empty one gives no rows; columns of ``df`` called shard or slot are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    dealt = df.select(row_of(kept).alias("row"), F.rand(seed).alias("first"), F.rand(seed + 1).alias("second"))
    dealt = dealt.sortWithinPartitions("first").select("row", "second", F.monotonically_increasing_id().alias("place"))
    dealt = stored(dealt, "dealt").withColumn("part", F.shiftright("place", _PART_BITS)).withColumn(
        "at", F.col("place").bitwiseAND(F.lit(2 ** _PART_BITS - 1)))
    sizes = stored(dealt.groupBy("part").agg(F.count("*").alias("n")), "part-sizes")
    n_parts, n_rows = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = stored(communication_matrix(sizes, n_parts, n_rows, n_shards, seed), "matrix")
    ends = F.transform(F.sequence(F.lit(1), F.size("counts")), lambda k: F.aggregate(
        F.slice("counts", F.lit(1), k), F.lit(0).cast("long"), lambda a, c: a + c))
    blocks = max(1, math.ceil(n_rows / n_shards / block_rows))
    sent = dealt.join(counts.select("part", ends.alias("ends")), "part").select(
        "row", "second", "place", F.size(F.filter("ends", lambda e: e <= F.col("at"))).alias("shard"),
        F.floor(F.col("second") * blocks).alias("block"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sent.groupBy("shard", "block").agg(F.count("*").alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("second", "place"))
    placed = sent.withColumn("inside", inside).join(starts, ["shard", "block"])
    return placed.select("row.*", "shard", (F.col("start") + F.col("inside") - 1).alias("slot"))
