"""Secrets in texts: known patterns, and strings that pass a battery of randomness tests.

Candidates are runs of at least 20 characters of a coding alphabet, and their parts of at least 20 between separators
(a secret behind a path or a name): letters and digits alone, with ``+/``, and with ``-_``. A part is reported where its whole
run is let go; parts of different separators may overlap. The coding is inferred from the characters present;
under it the string is tested for a uniform alphabet (chi-squared over equal parts of the alphabet), for runs above and below
the middle, and for serial correlation. The hypothesis tested is "random"; the smallest of three p-values counts
threefold. Short strings give weak tests, so the false-discovery rate (Benjamini and Hochberg) is controlled within
classes of length: a string is let go as not random if its class rejects it at ``RATE``; all others are reported. So of
the strings let go at most that share was random.

Positions are code points, ends exclusive. Defined cases: a NULL or empty text has no spans; equal rows are scanned alike, all
stay and all count for the rate; an empty table gives an empty one; other columns are carried, and one called like a result
column is replaced.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stored
from .columns import let, row_of, running_totals

# The known kinds in their order, with pattern, the group that is measured, and its least length.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: A cheaper pattern that every text with a valid match has.
PRESENT = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}

RANDOM = "random"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
SEPARATOR = r"[+/_-]"
#: Parts of a candidate, by what may stand inside them.
PARTS = tuple(rf"[A-Za-z0-9{inside}]{{20,}}={{0,2}}" for inside in ("", "+/", "_-"))
LEAST = 20
RATE = 0.05
#: Classes of length, half a power of two each; longer strings share the last.
LENGTH_CLASSES = 12
_BINS_PER_POWER, _MOST_BIN = 8, 2400
_MOST_PARTS = 13

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Codings from the narrowest: characters, alphabet in order of value, equal parts for the uniformity test.
CODINGS = (
    ("base10", r"^[0-9]+$", _DIGITS, 5),
    ("base16", r"^[0-9a-f]+$", _DIGITS + "abcdef", 8),
    ("base16u", r"^[0-9A-F]+$", _DIGITS + "ABCDEF", 8),
    ("base26", r"^[a-z]+$", _LOWER, 13),
    ("base26u", r"^[A-Z]+$", _UPPER, 13),
    ("base32", r"^[A-Z2-7]+$", _UPPER + "234567", 8),
    ("base36", r"^[0-9a-z]+$", _DIGITS + _LOWER, 6),
    ("base36u", r"^[0-9A-Z]+$", _DIGITS + _UPPER, 6),
    ("base52", r"^[A-Za-z]+$", _UPPER + _LOWER, 4),
    ("base64", r"^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/", 8),
    ("base64url", r"^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_", 8),
    ("base66", r"^.*$", _UPPER + _LOWER + _DIGITS + "+/-_", 6),
)


def matches(text, pattern):
    """Leftmost non-overlapping matches as (start, end, found): a match starts after the gaps and matches before it."""
    def placed(gaps, found):
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                             lambda g, m: (F.length(g) + F.length(m)).cast("long"))
        return F.zip_with(running_totals(lengths), found, lambda end, m: F.struct(
            (end - F.length(m)).alias("start"), end.alias("end"), m.alias("found")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) == 0, F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")).otherwise(
        let(F.split(text, pattern, -1), lambda gaps: placed(gaps, found))))


_SPANS = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>"


def known_spans(text):
    """Spans of the known kinds by start, then kind."""
    found = []
    for no, (kind, pattern, group, least) in enumerate(KINDS):
        long_enough = F.filter(matches(text, pattern), lambda m: F.length(
            F.regexp_extract(m["found"], pattern, group) if group else m["found"]) >= least)
        spans = F.transform(long_enough, lambda m: F.struct(
            m["start"].alias("start"), F.lit(no).alias("kind_no"), m["end"].alias("end"), F.lit(kind).alias("kind")))
        found.append(F.when(text.rlike(PRESENT[kind]), spans.cast(_SPANS)).otherwise(F.array().cast(_SPANS)))
    return F.array_sort(F.concat(*found))


def upper_tail(z):
    """Chance of a standard normal value above ``z`` (a five-term approximation, error under 1e-7)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    # Coefficients of the approximation.
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _count(string, part):
    return (F.length(string) - F.length(F.replace(string, F.lit(part), F.lit("")))).cast("double") / len(part)


def _translate(string, old, new):
    return F.call_function("translate", string, old, new)


def _uniform(coded, n, coding):
    """Chi-squared over equal parts of the alphabet, by the cube-root approximation to the normal law."""
    parts = coding["parts"]

    def chi(binned):
        mean = n / parts
        counts = [_count(binned, chr(97 + b)) for b in range(_MOST_PARTS)]
        used = [F.when(F.lit(b) < parts, (c - mean) * (c - mean)).otherwise(0.0) for b, c in enumerate(counts)]
        spread = 2 / (9 * (parts - 1))
        root = F.pow(sum(used) / mean / (parts - 1), F.lit(1 / 3))
        return upper_tail((root - (1 - spread)) / F.sqrt(spread))

    return let(_translate(coded, coding["alphabet"], coding["part_of"]), chi)


def _runs(coded, n, coding):
    """Runs of values below and above the middle of the alphabet."""
    def test(bits):
        ones = _count(bits, "1")
        expected = 2 * ones * (n - ones) / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z = (1 + _count(bits, "01") + _count(bits, "10") - expected) / F.sqrt(F.greatest(spread, F.lit(1e-9)))
        one_sided = (ones == 0) | (ones == n)
        return F.when(one_sided, 2 * F.pow(F.lit(0.5), F.least(n, F.lit(900.0)))).otherwise(2 * upper_tail(F.abs(z)))

    return let(_translate(coded, coding["alphabet"], coding["half_of"]), test)


def _serial(coded, n, coding):
    """Correlation of a value with the next one."""
    def correlation(vs):
        mean = F.aggregate(vs, F.lit(0.0), lambda a, v: a + v) / n

        def about(m):
            both = F.zip_with(F.slice(vs, F.lit(1), F.size(vs) - 1), F.slice(vs, F.lit(2), F.size(vs) - 1),
                              lambda a, b: (a - m) * (b - m))
            square = F.aggregate(vs, F.lit(0.0), lambda a, v: a + (v - m) * (v - m))
            r = F.aggregate(both, F.lit(0.0), lambda a, v: a + v) / F.greatest(square, F.lit(1e-9))
            return F.when(square == 0, F.lit(0.0)).otherwise(2 * upper_tail(F.abs((r + 1 / n) * F.sqrt(n))))

        return let(mean, about)

    values = F.transform(F.split(coded, ""), lambda c: F.instr(coding["alphabet"], c).cast("double"))
    return let(values, correlation)


def _coding_of(coded):
    result = None
    for _, pattern, alphabet, parts in CODINGS:
        part_of = "".join(chr(97 + i * parts // len(alphabet)) for i in range(len(alphabet)))
        half_of = "".join("01"[2 * i // len(alphabet)] for i in range(len(alphabet)))
        coding = F.struct(F.lit(alphabet).alias("alphabet"), F.lit(part_of).alias("part_of"),
                          F.lit(half_of).alias("half_of"), F.lit(parts).alias("parts"))
        result = F.when(coded.rlike(pattern), coding) if result is None else result.when(coded.rlike(pattern), coding)
    return result


def randomness(found):
    """p-value of the battery for a candidate under its inferred coding."""
    def under(coded, coding):
        n = F.length(coded).cast("double")
        least = F.least(_uniform(coded, n, coding), _runs(coded, n, coding), _serial(coded, n, coding))
        return F.least(F.lit(1.0), 3 * least)

    return let(F.rtrim(found, F.lit("=")), lambda coded: let(_coding_of(coded), lambda coding: under(coded, coding)))


def _length_class(length):
    return F.least(F.lit(LENGTH_CLASSES - 1), F.floor(F.log2(length / LEAST) * 2)).cast("int")


_JUDGED = ("start", "end", "length_class", "bin")
_CANDIDATES = "array<struct<start:bigint,end:bigint,length_class:int,bin:int,whole:struct<length_class:int,bin:int>>>"


def _judged(start, end, found):
    p = F.greatest(randomness(found), F.lit(1e-90))
    return F.struct(start.alias("start"), end.alias("end"), _length_class(end - start).alias("length_class"),
                    F.least(F.lit(_MOST_BIN), F.floor(-F.log2(p) * _BINS_PER_POWER)).cast("int").alias("bin"))


def _parts_of(m):
    """The parts of a candidate that are candidates of their own."""
    found = F.array_distinct(F.concat(*[matches(m["found"], part) for part in PARTS]))
    shorter = F.filter(found, lambda x: x["end"] - x["start"] < m["end"] - m["start"])
    return F.when(m["found"].rlike(SEPARATOR), shorter).otherwise(F.array().cast(
        "array<struct<start:bigint,end:bigint,found:string>>"))


def candidates(text):
    """(start, end, class, bin, whole): the bin is the p-value's negative logarithm in steps of an eighth of a power of two.

    ``whole`` has class and bin of the whole run for a part of it, else it is NULL.
    """
    def tested(m):
        def with_parts(run):
            whole = F.struct(run["length_class"].alias("length_class"), run["bin"].alias("bin"))
            parts = F.transform(_parts_of(m), lambda x: let(
                _judged(m["start"] + x["start"], m["start"] + x["end"], x["found"]),
                lambda part: F.struct(*[part[c].alias(c) for c in _JUDGED], whole.alias("whole"))))
            own = F.struct(*[run[c].alias(c) for c in _JUDGED],
                           F.lit(None).cast("struct<length_class:int,bin:int>").alias("whole"))
            return F.concat(F.array(own).cast(_CANDIDATES), parts.cast(_CANDIDATES))

        return let(_judged(m["start"], m["end"], m["found"]), with_parts)

    return F.when(text.rlike(CANDIDATE), F.flatten(F.transform(matches(text, CANDIDATE), tested))).otherwise(
        F.array().cast(_CANDIDATES))


def rejected_from(scanned, rate=RATE):
    """For each class of length the least bin whose strings are let go as not random, over all candidates.

    The result has ``LENGTH_CLASSES`` rows at most. A bin is judged by its largest p-value.
    """
    bins = scanned.select(F.explode("found").alias("c")).groupBy("c.length_class", "c.bin").agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("length_class")
    beyond = by_class.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    judged = bins.select("length_class", "bin", F.sum("n").over(by_class).alias("m"), F.sum("n").over(beyond).alias("hit"))
    largest = F.pow(F.lit(2.0), -F.col("bin") / _BINS_PER_POWER)
    return judged.where(F.col("m") * largest <= rate * F.col("hit")).groupBy("length_class").agg(F.min("bin").alias("bin"))


def scan(df, text="text", rate=RATE):
    """``df`` with ``known`` and ``spans``: arrays of (start, kind_no, end, kind) by start, then kind.

    ``spans`` holds the known ones and those of the battery. Scanned rows are written once, because the rate takes a look
    at all candidates before the first verdict.
    """
    row = row_of([c for c in df.columns if c.lower() not in ("known", "spans")])
    string = F.coalesce(F.col(text), F.lit(""))
    scanned = stored(df.select(row.alias("row"), known_spans(string).alias("known"), candidates(string).alias("found")),
                     "scanned")
    limits = F.array().cast("array<struct<length_class:int,bin:int>>")
    rejected = rejected_from(scanned, rate).collect()
    if rejected:
        limits = F.array(*[F.struct(F.lit(r.length_class).alias("length_class"), F.lit(r.bin).alias("bin"))
                           for r in rejected])
    def let_go(c):
        return F.exists(limits, lambda x: (x["length_class"] == c["length_class"]) & (x["bin"] <= c["bin"]))

    kept = F.filter("found", lambda c: ~let_go(c) & (c["whole"].isNull() | let_go(c["whole"])))
    added = F.transform(kept, lambda c: F.struct(
        c["start"].alias("start"), F.lit(len(KINDS)).alias("kind_no"), c["end"].alias("end"), F.lit(RANDOM).alias("kind")))
    return scanned.select("row.*", "known", F.array_sort(F.concat("known", added.cast(_SPANS))).alias("spans"))


def written(spans):
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text, spans, mark="[secret]"):
    """``text`` with each stretch of spans that overlap replaced by ``mark``."""
    def merge(s, x):
        apart = F.struct(F.concat(s["out"], F.when(s["end"] >= 0, F.array(F.struct(s["start"], s["end"]))).otherwise(
            F.array().cast("array<struct<start:bigint,end:bigint>>"))).alias("out"),
            x["start"].alias("start"), x["end"].alias("end"))
        joined = F.struct(s["out"].alias("out"), s["start"].alias("start"), F.greatest(s["end"], x["end"]).alias("end"))
        return F.when(x["start"] < s["end"], joined).otherwise(apart)

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    first = F.struct(none.alias("out"), F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"))
    closed = F.aggregate(spans, first, merge, lambda s: F.concat(s["out"], F.array(F.struct(s["start"], s["end"]))))

    def rebuilt(cs):
        pieces = F.transform(cs, lambda c, i: F.concat(let(
            F.coalesce(F.get(cs, i - 1)["end"], F.lit(0).cast("long")),
            lambda at: F.substr(text, (at + 1).cast("int"), (c["start"] - at).cast("int"))), F.lit(mark)))
        tail = F.substr(text, (cs[F.size(cs) - 1]["end"] + 1).cast("int"))
        return F.concat(F.array_join(pieces, ""), tail)

    return F.when(F.size(spans) > 0, let(closed, rebuilt)).otherwise(text)
