"""Quality rules as a cascade: a document is rejected by the first rule it breaks, cheap and selective rules first.

Every rule is run on a bounded sample, which gives its time and the share it rejects; rules are then tried by rejected share
per second. The order decides what is computed, never which documents are kept.

Defined cases: a NULL or blank text has no words, so all its counts are 0 and it is rejected for having too few; equal
rows are judged alike and all stay; an empty table gives an empty one; other columns are carried, and one called like a result
column is replaced.
"""

import math
import time
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import functions as F

from ..session import stored
from .columns import WHITE, let, row_of, total

#: Rows on which the rules are timed; the sample has no influence on the verdicts.
SAMPLE_ROWS = 1000
WINDOW_WORDS = 8  # _window_hashes() doubles its windows three times
SYMBOLS = "#*$%&|<>"


def words_of(text):
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def word_chars(words, text):
    return F.length(F.translate(F.coalesce(text, F.lit("")), WHITE, "")).cast("long")


def n_symbols(words, text):
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def _lines(text):
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.translate(x, WHITE, "") != "")


def n_lines(words, text):
    return F.size(_lines(text)).cast("long")


def n_dup_lines(words, text):
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_words(words, text):
    return F.size(words).cast("long")


def n_capitals(words, text):
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long")


def _window_hashes(words):
    """A hash for each window of eight words: of pairs, of pairs of pairs, and of pairs of those."""
    def paired(hashes, step):
        return F.zip_with(F.slice(hashes, F.lit(1), F.size(hashes) - step),
                          F.slice(hashes, F.lit(step + 1), F.size(hashes) - step), lambda a, b: F.xxhash64(a, b))

    single = F.transform(words, lambda w: F.xxhash64(w))
    return let(single, lambda a: let(paired(a, 1), lambda b: let(paired(b, 2), lambda c: paired(c, 4))))


def n_repeat_words(words, text):
    """Words that lie in a window of eight words which occurs at least twice in the text; windows are compared by hash."""
    last = WINDOW_WORDS - 1

    def same(a, b):
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def repeated(ws):
        twice = F.filter(ws, lambda x, j: same(x, F.get(ws, j - 1)) | same(x, F.get(ws, j + 1)))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(starts):
        def add(s, i):
            end = i + last
            return F.struct(end.alias("end"), (s["n"] + end - F.greatest(s["end"], i - 1)).alias("n"))

        zero = F.lit(0).cast("long")
        return F.aggregate(starts, F.struct(zero.alias("end"), zero.alias("n")), add, lambda s: s["n"])

    def counted(hashes):
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).cast("long").alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.array_sort(placed), lambda ws: covered(repeated(ws))))

    return F.when(F.size(words) <= WINDOW_WORDS, F.lit(0).cast("long")).otherwise(let(_window_hashes(words), counted))


def n_stutters(words, text):
    """Words equal to the one before."""
    return let(words, lambda ws: F.size(F.filter(ws, lambda w, i: w == F.get(ws, i - 1)))).cast("long")


MEASURES = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_lines": n_lines,
            "n_dup_lines": n_dup_lines, "n_capitals": n_capitals, "n_stutters": n_stutters,
            "n_repeat_words": n_repeat_words}


@dataclass(frozen=True)
class Rule:
    """``broken`` takes a function that gives a measure's column by name."""

    name: str
    broken: Callable


RULES = (
    Rule("few_words", lambda m: m("n_words") < 20),
    Rule("repeated_passages", lambda m: m("n_repeat_words") * 100 > m("n_words") * 30),
    Rule("symbols", lambda m: m("n_symbols") * 10 > m("n_words")),
    Rule("word_length", lambda m: (m("word_chars") < m("n_words") * 3) | (m("word_chars") > m("n_words") * 15)),
    Rule("repeated_lines", lambda m: (m("n_dup_lines") >= 3) & (m("n_dup_lines") * 10 > m("n_lines") * 3)),
    Rule("stutters", lambda m: m("n_stutters") * 10 > m("n_words") * 3),
    Rule("capitals", lambda m: m("n_capitals") * 10 > m("word_chars") * 4),
)


def measure_of(words="words", text="text"):
    return lambda name: MEASURES[name](F.col(words), F.col(text))


#: Runs of a rule over the sample; the fastest counts. Costs below the floor, in seconds, can't be told from the job around them.
RUNS, LEAST_SECONDS = 3, 0.03


def rule_figures(sample, rules, measure, clock=time.perf_counter):
    """(rule, seconds, share rejected) on a sample; what a job takes without a rule is taken off."""
    def run(condition):
        job, times = sample.agg(F.count_if(condition), F.count("*")), []
        job.first()
        for _ in range(RUNS):
            begun = clock()
            hit, n = job.first()
            times.append(clock() - begun)
        return min(times), hit / max(n, 1)

    idle, _ = run(F.col("text").isNull())
    found = []
    for rule in rules:
        seconds, share = run(rule.broken(measure))
        found.append((rule, max(seconds - idle, LEAST_SECONDS), share))
    return found


def ordered(figures):
    """Rules by rejected share per second, highest first; costs count as powers of four, and equal figures keep the given order, so that
    small differences between runs don't change it."""
    def figure(rule_no):
        _, seconds, share = figures[rule_no]
        return -share / 4.0 ** round(math.log(seconds, 4))

    return [figures[i][0] for i in sorted(range(len(figures)), key=figure)]


def cascade(rules, measure):
    """True if no rule is broken; a rule is only computed for rows that all rules before it let pass."""
    verdict = None
    for rule in rules:
        verdict = F.when(rule.broken(measure), False) if verdict is None else verdict.when(rule.broken(measure), False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def verdict(text, rules):
    """``cascade`` over a text. Its words are bound inside the expression: as a column of their own, a filter on the verdict,
    which Spark moves below that column, would split the text once for every use."""
    return let(words_of(text), lambda words: cascade(rules, lambda name: MEASURES[name](words, text)))


def sampled_order(df, text="text", rules=RULES, sample_rows=SAMPLE_ROWS, seed=7):
    n = df.count()
    sample = df.select(F.col(text).alias("text")).sample(min(1.0, sample_rows / max(n, 1)), seed)
    sample = stored(sample.limit(2 * sample_rows).withColumn("words", words_of(F.col("text"))), "rule-sample")
    return ordered(rule_figures(sample, rules, measure_of()))


def judged(df, text="text", rules=RULES, measures=(), sample_rows=SAMPLE_ROWS, order=None):
    """``df`` with ``kept`` and the named ``measures``; measures that are asked for are computed for every row, others not."""
    order = order or sampled_order(df, text, rules, sample_rows)
    names = {c.lower() for c in ("kept", *measures)}
    row = row_of([c for c in df.columns if c.lower() not in names])
    rows = df.select(row.alias("row"), F.col(text).alias("text"), words_of(F.col(text)).alias("words"))
    lazy = measure_of()
    rows = rows.select("row", "text", "words", *[lazy(m).alias(m) for m in measures])

    def measure(name):
        return F.col(name) if name in measures else lazy(name)

    return rows.select("row.*", *measures, cascade(order, measure).alias("kept"))


def keep_good(df, text="text", rules=RULES, sample_rows=SAMPLE_ROWS):
    """The rows of ``df`` that no rule rejects, with their own columns."""
    order = sampled_order(df, text, rules, sample_rows)
    return df.where(verdict(F.col(text), order))
