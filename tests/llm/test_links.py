"""Filter audit, whitening and the n-gram join: against brute force, and what they make of odd rows."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import filter_audit, ngram_join, queries, whitening

DOC = "doc_id long, text string, lang string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- Filter audit ----

def audit_by_hand(docs, labels):
    """One order after the other, one document after the other."""
    def words(text):
        return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]

    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails, out = [], []
    for d, text, _ in docs:
        text = text or ""
        w = words(text)
        fails.append({"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                      "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
                      "E": d is not None and any(e is not None and e < d and (u or "") == text for e, u, _ in docs)})
    for part in {p or "" for _, _, p in docs}:
        here = [(d, f) for (d, _, p), f in zip(docs, fails) if (p or "") == part]
        steps, removed = [], Counter()
        for order in itertools.permutations("ABCDE"):
            alive = here
            for i, name in enumerate(order, 1):
                gone = [d for d, f in alive if f[name]]
                redundant = sum(f[name] for d, f in here) - len(gone)
                alive = [(d, f) for d, f in alive if not f[name]]
                removed[name] += len(gone)
                steps.append((part, "".join(order), i, name, len(alive), len(gone), redundant,
                              sum(f[name] and sum(f.values()) == 1 for _, f in here), sum(d in good for d in gone),
                              sum(d in toxic for d in gone)))
        out += [(*s, removed[s[3]]) for s in steps]
    return sorted(out, key=repr)


def some_docs():
    rng = random.Random(5)
    long = [" ".join(rng.choice(["alpha", "beta", "Gamma", "d", "e%"]) + str(rng.randrange(40)) for _ in range(n)) for n in (5, 210, 260, 230)]
    texts = [None, "", "  ", "one two", *long, "word " * 300, "UPPER CASE " * 110, " ".join(f"w{i}" for i in range(250))]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(60)]
    return docs + [(None, texts[1], "en"), (None, long[1], "en"), (7, long[1], "de"), (7, long[1], "de"), docs[0], docs[0]]


def test_audit_equals_all_orders_by_hand(spark):
    docs = some_docs()
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 50, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (8, None, None), (999, 1, 1)]
    labels = [(d, q, None if t is None else int(t)) for d, q, t in labels]
    got = filter_audit.audit(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rows_of(got) == audit_by_hand(docs, labels)


def test_audit_with_filters_in_a_given_order(spark):
    docs = spark.createDataFrame([(1, "aa b", "x"), (2, "b", "x"), (3, "aa", "x"), (4, "c", "x")], DOC)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    filters = {"P": lambda words, text: text.contains("a"), "Q": lambda words, text: text.contains("b"), "R": lambda words, text: text == "c"}
    got = filter_audit.audit(docs, labels, filters=filters, repeated=None, before=[("P", "Q")]).collect()
    orders = {r.filter_order for r in got}
    assert orders == {"PQR", "PRQ", "RPQ"} and len(got) == 9
    assert {r["filter"]: r.shapley for r in got} == {"P": 6, "Q": 3, "R": 3}
    with pytest.raises(ValueError):
        filter_audit.Lattice(("P", "Q"), (("P", "Q"), ("Q", "P")))


def test_lattice_counts_orders():
    lattice = filter_audit.Lattice(tuple("ABCDE"))
    sizes = [bin(s).count("1") for s in range(32)]
    assert lattice.forward == [math.factorial(n) for n in sizes] and lattice.backward == [math.factorial(5 - n) for n in sizes]
    assert len(lattice.edges()) == 80 and sum(w for s, _, w in lattice.edges() if s == 0) == 120


def test_audit_of_an_empty_table_and_odd_columns(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], DOC), labels).count() == 0
    odd = spark.createDataFrame([(1, "a b", "en", 3, 4, 5.0)], "doc_id long, text string, lang string, same int, part int, `n.x` double")
    assert filter_audit.audit(odd, labels).count() == 600


def test_audit_reads_texts_once(spark):
    docs = spark.createDataFrame(some_docs(), DOC)
    sets, _ = filter_audit.failed_sets(docs)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1 and "Exchange" not in plan


# ---- Whitening ----

def whitened_by_numpy(vectors, k=4):
    rows = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.unique([x for _, x in rows], axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    order = np.argsort(-e)[:k]
    return n, [(i, sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, total)), (x - total / n) @ v[:, order] / np.sqrt(e[order])) for i, x in rows], (
        e[order] / e.sum())


def test_whitening_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 4)
    monkeypatch.setattr(whitening, "TASK_BLOCKS", 2)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 6)) * [5, 3, 2, 1, 0.5, 0.2] + 40
    vectors = [(i, v.tolist()) for i, v in enumerate(base)] + [(200 + i, base[0].tolist()) for i in range(60)]
    vectors += [(None, base[1].tolist()), (300, None), (301, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (302, [float("nan")] * 6),
                (303, [float("inf")] * 6), (0, base[2].tolist()), (304, [1e300] * 6)]
    got = whitening.whitened(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()
    n, want, shares = whitened_by_numpy([v for v in vectors if v[0] != 304])
    assert len(got) == 4 * len(want) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    by_key = {}
    for r in got:
        by_key.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
        assert abs(r.explained - shares[r.component - 1]) < 1e-12
    signs = None
    for i, deviation, white in want:
        mine = by_key[i, deviation]
        signs = [math.copysign(1, mine[c + 1][0] * white[c]) for c in range(4)] if signs is None else signs
        assert all(np.allclose(mine[c + 1], signs[c] * white[c], atol=1e-9) for c in range(4))


def test_entries_of_any_size_are_centred_exactly(spark):
    for big in (1, 2 ** 20, 2 ** 40, 2 ** 61):
        fit = [[big, 3], [-big, 4], [big - 1, 9]]
        sums = tuple(map(sum, zip(*fit)))
        centre = whitening.Centre(3, sums, big)
        rows = spark.createDataFrame([(i, x) for i, x in enumerate(fit)], "i int, x array<bigint>")
        got = rows.select("i", centre.gaps().cast("array<string>").alias("g"), centre.deviation().alias("d")).collect()
        for r in got:
            gaps = [3 * x - s for x, s in zip(fit[r.i], sums)]
            square = sum(g * g for g in gaps)
            assert list(map(int, r.g)) == gaps and r.d == (square if square < 2 ** 63 else None)


def test_whitening_of_vectors_without_variance(spark):
    kind = "vec_id long, embedding array<float>, n int, `n.x` string"
    one = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0], 0, ""), (2, [1.0, 2.0], 0, "")], kind)).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.n == 1 for r in one)
    line = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0], 0, ""), (2, [3.0, 2.0], 0, "")], kind)).collect()
    assert {(r.vec_id, r.component): r.whitened and abs(round(r.whitened, 9)) for r in line} == {
        (1, 1): 1.0, (2, 1): 1.0, (1, 2): None, (2, 2): None}
    assert {r.component: r.explained for r in line} == {1: 1.0, 2: 0.0}
    none = whitening.whitened(spark.createDataFrame([(1, None, 0, ""), (2, [], 0, "")], kind))
    assert none.count() == 0 and whitening.whitened(spark.createDataFrame([], kind)).columns == none.columns


def test_whitening_fits_each_length_for_itself(spark):
    rows = [(i, [float(i), float(i * i)]) for i in range(5)] + [(10 + i, [float(i)]) for i in range(3)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert Counter((r.vec_id >= 10, r.n) for r in got) == {(False, 5): 10, (True, 3): 3}


# ---- N-gram join ----

def joined_by_hand(docs, similarity=(90, 100)):
    part, whole = similarity

    def grams(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
        return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()

    sets, comp = [grams(t) for _, t in docs], list(range(len(docs)))
    for i, j in itertools.combinations(range(len(docs)), 2):
        if sets[i] and sets[j] and whole * len(sets[i] & sets[j]) >= part * len(sets[i] | sets[j]):
            old, new = comp[i], comp[j]
            comp = [new if c == old else c for c in comp]
    low = {}
    for c, (d, _) in zip(comp, docs):
        low[c] = d if low.get(c) is None else low[c] if d is None else min(d, low[c])
    return sorted(((d, len(s), low[c]) for (d, _), s, c in zip(docs, sets, comp)), key=repr)


def near_copies(seed, sizes, copies):
    rng = random.Random(seed)
    docs = []
    for size in sizes:
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(text) or 1)
                kind = rng.random()
                text[at:at + (kind < 0.7)] = [] if kind < 0.2 else [f"x{rng.randrange(10 ** 6)}"]
            docs.append((len(docs) + 1, " ".join(text)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("sizes,copies", [(range(1, 45), 7), ((60, 90, 150, 400), 30), ((300,), 120)])
def test_ngram_join_equals_all_pairs(spark, sizes, copies):
    docs = near_copies(len(sizes), sizes, copies)
    got = ngram_join.linked_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    want = joined_by_hand(docs)
    assert rows_of(got) == want and len({w[2] for w in want}) < len(docs)


@pytest.mark.parametrize("most", [8, 14, 18, 22])
def test_ngram_join_for_any_boundary(spark, monkeypatch, most):
    monkeypatch.setattr(ngram_join, "boundary", lambda *_: most)
    docs = near_copies(9, range(8, 30), 12)
    got = ngram_join.linked_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows_of(got) == joined_by_hand(docs)


def test_small_and_large_sets_both_find_links(spark):
    docs = spark.createDataFrame(near_copies(4, [14, 15, 80], 20), "doc_id long, text string")
    marked = ngram_join.marked(docs, "doc_id", "text", 3, (90, 100), 0.2).withColumnRenamed("row_no", "cls").dropDuplicates(["digest"])
    assert ngram_join.small_links(marked.where("n BETWEEN 9 AND 18"), 18).count() > 0
    assert ngram_join.inverted_lists(marked.where("n > 40")).count() > 0


def test_ngram_join_of_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(30000))
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "two one"), (8, " one\ttwo "), (None, "one"),
            (9, "\xc9t\xe9 a b"), (10, "\xe9t\xe9 a b"), (11, long), (12, long + " end"), (13, long[:-60000]), (4, "one"), (None, "z z z"),
            (14, "k" * 200000), (15, "K" * 200000)]
    frame = spark.createDataFrame([(*d, 1, 2.0) for d in docs], "doc_id long, Text string, digest int, `n.x` double")
    assert rows_of(ngram_join.linked_documents(frame)) == joined_by_hand(docs)
    assert ngram_join.linked_documents(frame.limit(0)).count() == 0


def test_common_passages_do_not_link(spark):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, passage + " " + " ".join(f"u{rng.randrange(10 ** 7)}" for _ in range(60))) for i in range(80)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    assert all(r.component_id == r.doc_id for r in ngram_join.linked_documents(rows).collect())


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    text = " ".join("abc"[: i % 4] * (i % 7) for i in range(3000)) + " " + "long" * 400
    whole = ngram_join.ngram_set(text)
    monkeypatch.setattr(ngram_join, "_CHUNK", 50)
    assert np.array_equal(whole, ngram_join.ngram_set(text))


def test_least_shared_is_the_bound():
    for a in range(1, 120):
        for b in range(a, 150):
            fits = [i for i in range(a + 1) if 100 * i >= 90 * (a + b - i)]
            assert (b in ngram_join.partners(a)) == bool(fits) and (a in ngram_join.partners(b)) == bool(fits)
            if fits:
                assert ngram_join.least_shared(a, b) == fits[0]


def test_audit_query_counts_every_document(spark):
    sf = "/root/testdata/sf0.001"
    last = queries.QUERIES["op11_filter_audit"](spark, sf).where("filter_order = 'ABCDE'")
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    first = last.where("step = 1").agg(F.sum(F.col("kept") + F.col("removed") + F.col("redundant"))).first()[0]
    assert first == n
