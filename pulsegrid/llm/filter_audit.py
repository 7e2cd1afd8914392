"""What filters do to one another in every order: path counting over the lattice of filter sets.

A state of the lattice is the set of filters applied so far; an edge applies one more. What an edge removes depends on its state
alone, not on the order in which that was reached. So a document counts by the set of filters it fails, and tables of these counts
give every edge; the corpus is read once. Forward counts say in how many orders a state is reached, backward counts in how many
the rest can follow; their product over an edge is the number of orders that use it. Removals weighted by it sum to a filter's
Shapley value times the number of orders, and the steps of one order are the edges on its path.

Filters may be told to come before others; only orders that obey are counted and listed. At most ``MOST_FILTERS`` filters: the
lattice has a state per set of them, and is built by the driver. Listing has a row per order and step.

Repeated texts are a filter of their own: a document fails it if a smaller id has an equal text. Texts are compared by a 256-bit
hash; rows of a text are counted by id, part and failures before they are brought together, so a group of copies of any size
is a few rows. ``KEY_PARTS`` spreads rows without an id, which meet no label.

Defined cases: a NULL text is empty; a NULL part is the empty string; a NULL id is smaller than none and has no label; rows with
one id and text are rows of their own, and none of them repeats another; an id with several labels has each of them; an
empty table gives no rows; other columns are not read.
"""

import string
from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from .columns import WHITE

MOST_FILTERS = 10
KEY_PARTS = 1024


# ---- Failure conditions of the text itself ----

def _words(text):
    return F.filter(F.split(text, f"[{WHITE}]+"), lambda w: w != "")


def _without(text, characters):
    return F.length(text) - F.length(F.translate(text, characters, ""))


#: Name and failure condition by (words, text); the words are split once for all of them.
TEXT_FILTERS = {
    "A": lambda words, text: F.size(words) < 200,
    "B": lambda words, text: F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
    "C": lambda words, text: _without(text, string.ascii_uppercase).cast("long") * 100 > F.length(text).cast("long") * 3,
    "D": lambda words, text: text.rlike("[#$%&*|]"),
}
REPEATED = "E"


# ---- Lattice ----

@dataclass(frozen=True)
class Lattice:
    """States are numbers with a bit per filter; ``before`` holds pairs (earlier, later) of filter names."""

    names: tuple
    before: tuple = ()

    def __post_init__(self):
        if not 1 <= len(self.names) <= MOST_FILTERS or len(set(self.names)) < len(self.names):
            raise ValueError(f"one to {MOST_FILTERS} filters with differing names")
        if not self.forward[self.whole]:
            raise ValueError("no order obeys all of: " + ", ".join(f"{a} before {b}" for a, b in self.before))

    @property
    def whole(self):
        return (1 << len(self.names)) - 1

    def allowed(self, state, f):
        """Whether filter ``f`` may be the next one in ``state``."""
        earlier = sum(1 << self.names.index(a) for a, b in self.before if self.names.index(b) == f)
        return not state >> f & 1 and state & earlier == earlier

    @property
    def steps(self):
        """All edges as (state, filter), from small states to large ones."""
        return [(s, f) for s in range(self.whole + 1) for f in range(len(self.names)) if self.allowed(s, f)]

    @property
    def forward(self):
        """Orders that reach each state."""
        ways = [1] + [0] * self.whole
        for s, f in self.steps:
            ways[s | 1 << f] += ways[s]
        return ways

    @property
    def backward(self):
        """Orders that lead from each state to the last one."""
        ways = [0] * self.whole + [1]
        for s, f in reversed(self.steps):
            ways[s] += ways[s | 1 << f]
        return ways

    def edges(self):
        """(state, filter, orders that use the edge) of edges that some order uses."""
        ahead, behind = self.forward, self.backward
        used = ((s, f, ahead[s] * behind[s | 1 << f]) for s, f in self.steps)
        return [e for e in used if e[2]]


# ---- Counts ----

def failed_sets(docs, doc="doc_id", text="text", part="lang", filters=None, repeated=REPEATED):
    """(doc, part, same, failed): the text's hash and the set of filters that the text itself fails."""
    filters = TEXT_FILTERS if filters is None else filters
    rows = docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))

    def failed(words):
        bits = [F.when(fails(words[0], F.col("text")), 1 << i).otherwise(0) for i, fails in enumerate(filters.values())]
        return sum(bits, F.lit(0))

    once = F.transform(F.array(_words(F.col("text"))), lambda w: failed([w]))[0]
    same = F.unhex(F.sha2("text", 256)) if repeated else F.lit(None).cast("binary")
    return rows.select("doc", "part", same.alias("same"), once.alias("failed")), (*filters, *([repeated] if repeated else []))


def with_labels(sets, labels, doc="doc_id", good="quality", toxic="toxic"):
    """``sets`` counted by all their columns (``n``), with whether the id is labelled good or toxic."""
    known = labels.where(F.col(doc).isNotNull()).groupBy(F.col(doc).alias("doc")).agg(
        F.coalesce(F.max((F.col(good) == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col(toxic) == 1).cast("int")), F.lit(0)).alias("toxic")).withColumn("spread", F.lit(0))
    counted = sets.groupBy("doc", "part", "same", "failed").agg(F.count("*").alias("n")).withColumn(
        "spread", F.when(F.col("doc").isNull(), F.pmod(F.hash("same", "part"), F.lit(KEY_PARTS)) + 1).otherwise(0))
    zero = {"good": F.coalesce("good", F.lit(0)), "toxic": F.coalesce("toxic", F.lit(0))}
    return counted.join(known, ["doc", "spread"], "left").drop("spread").withColumns(zero)


def failure_counts(sets, repeated_bit=None):
    """(part, failed, good, toxic, n) over all documents; with ``repeated_bit`` that bit is set where a smaller id has the text."""
    kind = ["part", "failed", "good", "toxic"]
    if repeated_bit is None:
        return sets.groupBy(*kind).agg(F.sum("n").alias("n"))
    copies = sets.groupBy("same", *kind).agg(
        F.sum("n").alias("n"), F.min("doc").alias("low"), F.min_by("n", "doc").alias("n_low"),
        F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    first = F.min("low").over(Window.partitionBy("same"))
    own = F.col("n_null") + F.when(F.col("low") == F.col("first"), F.col("n_low")).otherwise(0)
    split = copies.withColumn("first", first).withColumn("own", own).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("failed"), F.col("own").alias("n")),
            F.struct(F.col("failed").bitwiseOR(F.lit(1 << repeated_bit)).alias("failed"), (F.col("n") - F.col("own")).alias("n")))).alias("x"))
    return split.select("part", "x.failed", "good", "toxic", "x.n").groupBy(*kind).agg(F.sum("n").alias("n")).where("n > 0")


def edge_counts(counts, lattice):
    """A row per part and edge: state, filter (a number), orders that use the edge, and what happens there.

    kept, removed, redundant (fails the filter, but was removed before), unique_fails (fails it alone), good_lost, toxic_lost.
    """
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("orders"))
                      for s, f, w in lattice.edges()])
    rows = counts.select("part", "failed", "good", "toxic", "n", F.explode(edges).alias("e")).select("*", "e.*")
    bit = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    alive, hit = F.col("failed").bitwiseAND(F.col("state")) == 0, F.col("failed").bitwiseAND(bit) != 0

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    return rows.groupBy("part", "state", "filter", "orders").agg(
        total(alive & ~hit).alias("kept"), total(alive & hit).alias("removed"), total(~alive & hit).alias("redundant"),
        total(F.col("failed") == bit).alias("unique_fails"), total(alive & hit & (F.col("good") == 1)).alias("good_lost"),
        total(alive & hit & (F.col("toxic") == 1)).alias("toxic_lost"))


def with_shapley(edges):
    """``edges`` with ``shapley``: what the filter removes, summed over all orders."""
    return edges.withColumn("shapley", F.sum(F.col("orders") * F.col("removed")).over(
        Window.partitionBy("part", "filter")).cast("long"))


def order_steps(spark, lattice):
    """(filter_order, step, state, filter): the edges on the path of each allowed order, grown a filter at a time."""
    out = {}
    for s, f in ((s, f) for s, f, _ in lattice.edges()):
        out.setdefault(s, []).append(f)
    step = "struct<step:int,state:int,filter:int>"
    moves = F.create_map(*[x for s, fs in out.items() for x in (F.lit(s), F.array(*map(F.lit, fs)))])
    paths = spark.range(1).select(F.lit(0).alias("state"), F.lit("").alias("filter_order"),
                                  F.array().cast(f"array<{step}>").alias("path"))
    names = F.array(*map(F.lit, lattice.names))
    for n in range(1, len(lattice.names) + 1):
        paths = paths.withColumn("filter", F.explode(F.element_at(moves, F.col("state")))).select(
            F.col("state").bitwiseOR(F.call_function("shiftleft", F.lit(1), F.col("filter"))).alias("state"),
            F.concat("filter_order", names[F.col("filter")]).alias("filter_order"),
            F.concat("path", F.array(F.struct(F.lit(n).alias("step"), "state", "filter"))).alias("path"))
    return paths.select("filter_order", F.inline("path"))


def audit(docs, labels, doc="doc_id", text="text", part="lang", filters=None, repeated=REPEATED, before=()):
    """A row per part, allowed order and step, with the counts of ``edge_counts`` and ``shapley``."""
    sets, names = failed_sets(docs, doc, text, part, filters, repeated)
    lattice = Lattice(tuple(names), tuple(before))
    counts = failure_counts(with_labels(sets, labels, doc), len(names) - 1 if repeated else None)
    edges = with_shapley(edge_counts(counts, lattice))
    steps = order_steps(docs.sparkSession, lattice)
    return edges.join(steps, ["state", "filter"]).select(
        "part", "filter_order", "step", F.array(*map(F.lit, names))[F.col("filter")].alias("filter"), "kept", "removed",
        "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
