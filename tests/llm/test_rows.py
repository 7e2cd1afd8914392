"""Sharding, near-duplicates, top-k search and archives against plain Python."""

import base64
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.llm import sharding, simhash, topk, warc
from pulsegrid.session import new_dir

# ---- Sharding ----


@pytest.mark.parametrize("n, shards, parts, block", [(0, 3, 1, 10), (1, 5, 1, 10), (103, 7, 1, 5), (500, 40, 6, 4), (211, 3, 5, 10 ** 6)])
def test_exact_sizes_and_places(spark, n, shards, parts, block):
    rows = [(i // 2 if i % 7 else None, None if i % 5 == 0 else f"t{i // 3}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).withColumns(
        {"shard": F.lit("clash"), "part": F.lit("own"), "row": F.col("doc_id")})
    out = sharding.uniform_shards(df, shards, block_rows=block).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(rows, key=str)
    assert all(r.part == "own" and r.row == r.doc_id for r in out)
    sizes = [sum(r.shard == s for r in out) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
    for s in range(shards):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))


def test_hypergeometric_law(spark):
    total, marked, draws = 50, 13, 21
    u = [(i + 0.5) / 20000 for i in range(20000)]
    x = sharding.hypergeometric(*[F.lit(v).cast("long") for v in (total, marked, draws)], F.col("u"))
    got = {r.x: r.n for r in spark.createDataFrame([(v,) for v in u], "u double").groupBy(x.alias("x")).agg(
        F.count("*").alias("n")).collect()}
    for k in range(marked + 1):
        p = math.comb(marked, k) * math.comb(total - marked, draws - k) / math.comb(total, draws)
        assert abs(got.get(k, 0) / len(u) - p) < 2 / len(u)


def test_hypergeometric_of_large_numbers(spark):
    total, marked, draws = 10 ** 10, 25 * 10 ** 7, 5 * 10 ** 9
    x = sharding.hypergeometric(*[F.lit(v).cast("long") for v in (total, marked, draws)], F.col("u"))
    found = [r.x for r in spark.createDataFrame([(i / 40,) for i in range(40)], "u double").select(x.alias("x")).collect()]
    mean, spread = marked / 2, math.sqrt(draws * 0.025 * 0.975 * 0.5)
    assert all(abs(v - mean) < 8 * spread for v in found) and len(set(found)) == 40


def test_matrix_sums(spark):
    sizes = [5, 0, 17, 40, 1, 9]
    parts = spark.createDataFrame([(10 * i, n) for i, n in enumerate(sizes)], "part long, n long")
    for seed in range(4):
        rows = sharding.communication_matrix(parts, len(sizes), sum(sizes), 5, seed).collect()
        assert {r.part: sum(r.counts) for r in rows} == {10 * i: n for i, n in enumerate(sizes)}
        assert [sum(r.counts[s] for r in rows) for s in range(5)] == [15, 15, 14, 14, 14]
        assert all(c >= 0 for r in rows for c in r.counts)


def test_every_row_may_come_to_every_place(spark):
    rows = spark.createDataFrame([(i,) for i in range(4)], "doc_id long").repartition(2)
    seen = {tuple(sorted((r.shard, r.slot, r.doc_id) for r in sharding.uniform_shards(rows, 2, seed=s).collect())) for s in range(12)}
    assert len(seen) > 6


# ---- Near-duplicates ----

def plain_fingerprint(text):
    words = [w for w in "".join(c if c in " \t\n\x0b\x0c\r" or not c.isspace() else c for c in (text or "")).encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, radius=2):
    """Index of the first linked one, over others too."""
    label = list(range(len(fingerprints)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(fingerprints)), 2):
        if (fingerprints[i] ^ fingerprints[j]).bit_count() <= radius:
            a, b = sorted((top(i), top(j)))
            label[b] = a
    return [top(i) for i in range(len(fingerprints))]


def flipped(rng, base, most):
    return base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, most)))


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_trees_find_all_links(radius):
    rng = random.Random(radius)
    bases = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    members = sorted({flipped(rng, rng.choice(bases), 6) for _ in range(250)})
    shards = np.sort(np.array([rng.randrange(4) for _ in members]))
    label = simhash.linked_in_shards(np.array(members, np.uint64), shards, radius)
    for s in range(4):
        at = np.flatnonzero(shards == s)
        assert (label[at] == at[plain_components([members[i] for i in at], radius)]).all()


@pytest.mark.parametrize("shard_rows", [16, 16384])
def test_components_over_shards(spark, shard_rows):
    rng = random.Random(shard_rows)
    bases = [rng.getrandbits(64) for _ in range(5)] + [0]
    members = list({flipped(rng, rng.choice(bases), 9) for _ in range(140)})
    chain = [sum(1 << b for b in range(k)) << 20 for k in range(0, 40, 2)]
    members = list(dict.fromkeys(members + chain))
    signed = [(m - (1 << 64) if m >> 63 else m, i) for i, m in enumerate(members)]
    df = spark.createDataFrame(signed, "fingerprint long, first long")
    got = {r.first: r.component_id for r in simhash.components(df, shard_rows=shard_rows).collect()}
    assert got == dict(enumerate(plain_components(members)))


def documents():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows, doc = [], 100
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(150, 400))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            if rng.random() < 0.6:
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((doc, rng.choice([" ", "\n", " \t"]).join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
            doc -= 1
    return rows + [(7, None), (8, ""), (9, " \n"), (None, "alone words here now"), (500, "a b"), (501, "A\x0bB"), (502, " É"),
                   rows[3], rows[3], (600, "x " * 4000)]


def test_documents_and_their_components(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"fingerprint": F.lit("clash"), "root": F.lit("own"), "first": F.col("doc_id"), "doc": F.lit(1)})
    out = simhash.near_duplicates(df).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    top = plain_components(prints)
    smallest = {t: min((rows[i][0] for i in range(len(rows)) if top[i] == t and rows[i][0] is not None), default=None) for t in set(top)}
    want = sorted(((d, p, smallest[t]) for (d, _), p, t in zip(rows, prints, top)), key=str)
    assert sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in out), key=str) == want
    assert all(r.root == "own" and r.first == r.doc_id for r in out)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(smallest.values(), key=str)


def test_no_documents_to_compare(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0 and simhash.one_of_each(df).count() == 0


# ---- Top-k ----

def plain_top(rows, k):
    fine = [(no, i, [math.floor(1024 * x) for x in v]) for no, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and math.isfinite(1024 * x) for x in v)]
    low, high = -(2 ** 63), 2 ** 63 - 1
    out = []
    for no, i, q in fine:
        if i is not None and i % 100 == 0:
            found = [(-min(max(sum(a * b for a, b in zip(q, v)), low), high), j is None, j or 0) for m, j, v in fine
                     if m != no and len(v) == len(q)]
            out += [(i, r + 1, None if null else j, -s) for r, (s, null, j) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def vectors(seed, n, length, ids=1000):
    rng = random.Random(seed)
    base = [rng.gauss(0, 1) for _ in range(length)]
    return [(rng.choice([rng.randrange(0, ids), rng.randrange(0, ids, 100)]),
             base if rng.random() < 0.3 else [rng.gauss(0, 1) for _ in range(length)]) for _ in range(n)]


@pytest.mark.parametrize("shard_rows", [30, 8192])
def test_highest_products(spark, shard_rows):
    odd = [(100, None), (200, [1.0, None, 2.0, 0.0, 0.0]), (300, [float("nan")] * 5), (400, [float("inf"), 1.0, 1.0, 1.0, 1.0]),
           (None, [9.0] * 5), (500, [1.0, 2.0]), (501, [3.0, 4.0]), (600, []), (601, []), (700, [1.5] * 3)]
    rows = vectors(1, 220, 5) + odd
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {"id": F.lit("own"), "shard": F.lit(1), "score": F.lit(2)}).repartition(4)
    got = topk.top_k(df, lambda i: i % 100 == 0, k=7, shard_rows=shard_rows, query_block=9).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_top(rows, 7)


def test_products_beyond_floats(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([1e7, 3e7 + 1 / 1024, -2e8, 1e12]) * rng.random() for _ in range(6)]) for i in range(0, 4000, 50)]
    rows += [(10 ** 6, [1e300, -1e300, 0.0, 0.0, 0.0, 1e10]), (10 ** 6 + 100, [1e308] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((tuple(r) for r in topk.top_k(df, lambda i: i % 100 == 0).collect()), key=str) == plain_top(rows, 10)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, lambda i: i % 100 == 0).count() == 0


def test_balls_hold_their_rows():
    matrix = np.random.default_rng(1).normal(size=(500, 6)) * 100
    tree = topk.BallTree(matrix, 16)
    leaves = [r for r in tree.rows if r is not None]
    assert sorted(np.concatenate(leaves)) == list(range(500)) and max(map(len, leaves)) <= 16
    for node, rows in enumerate(tree.rows):
        if rows is not None:
            assert (np.linalg.norm(matrix[rows] - tree.centres[node], axis=1) <= tree.radii[node]).all()


# ---- Archives ----

def pages():
    rng = random.Random(6)
    rows = [(i, f"http://h/{i}", rng.choice(["<p>one</p>", "é" * 50, "", None, f"<p>{i}</p>"])) for i in range(60)]
    return rows + [rows[3], (None, None, "alone"), (1000, "http://h/a b\r\nWARC-Type: x", "x" * 200000), (1001, "u", "\r\n\r\nWARC/1.1\r\n")]


@pytest.mark.parametrize("split, archive", [(1, 500), (97, 1 << 30), (1 << 26, 1 << 30)])
def test_records_are_read_back(spark, split, archive):
    rows = pages()[:40] if split == 1 else pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"key": F.lit("own"), "payload": F.lit(1)})
    manifest = warc.write_archives(df.repartition(3), new_dir(spark, "archives"), archive_bytes=archive)
    out = warc.read_archives(manifest, split_bytes=split).collect()
    assert len(out) == len(rows) == manifest.agg(F.sum("records")).first()[0]
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    got = sorted(((r.key, r.type, r.refers_to, r.digest, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in out), key=str)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = i is None and (h or "") not in first or first.get(h or "") == i
        want.append((None if i is None else str(i), "response" if same else "revisit", None if same else str(first[h or ""]),
                     base64.b32encode(hashlib.sha1(data).digest()).decode(), len(data), data if same else None))
    assert got == sorted(want, key=str)


def test_archives_of_others(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    warc.write_archives(df, folder)
    assert warc.read_archives(warc.archives_in(spark, folder)).count() == 2
    assert warc.read_archives(warc.archives_in(spark, folder), payloads=False).where("payload is not null").count() == 0


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(df, new_dir(spark, "archives"))).count() == 0


def test_magic_by_chance_is_no_record():
    rng = random.Random(1)
    members = [warc.compressed(warc.record(i, None, rng.randbytes(300) + warc.MAGIC + bytes(40))) for i in range(20)]
    junk = warc.MAGIC + b"\x00" * 7 + b"\x03" + zlib.compress(b"WARC")
    data = b"".join(m + (junk if i % 3 == 0 else b"") for i, m in enumerate(members))
    for step in (1, 50, 10 ** 6):
        found = [warc.parsed(d)[0] for s in range(0, len(data), step)
                 for _, d in warc.records(lambda a, n: data[a:a + n], s, min(s + step, len(data)))]
        assert found == [str(i) for i in range(20)]


def test_a_record_that_holds_an_archive():
    inner = warc.compressed(warc.record("inner", None, random.Random(3).randbytes(5000)))
    member = warc.compressed(warc.record("outer", None, random.Random(2).randbytes(70000) + inner))
    assert [warc.parsed(d)[0] for s in range(0, len(member), 1000)
            for _, d in warc.records(lambda a, n: member[a:a + n], s, min(s + 1000, len(member)))] == ["outer"]


@pytest.mark.parametrize("split", [50_000, 1 << 26])
def test_a_header_of_any_length_is_read(spark, split):
    url = base64.b32encode(random.Random(4).randbytes(200_000)).decode().rstrip("=")
    rows = [(1, "u", "a"), (2, url, "long"), (3, "v", "long"), (4, "w", "b")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    out = warc.read_archives(warc.write_archives(df, new_dir(spark, "archives")), split_bytes=split).collect()
    assert sorted((r.key, r.url, r.type, r.refers_to) for r in out) == [
        ("1", "u", "response", None), ("2", url, "response", None), ("3", "v", "revisit", "2"), ("4", "w", "response", None)]


@pytest.mark.parametrize("step", [1, 50, 10 ** 6])
def test_a_place_without_a_record_is_an_error(step):
    members = [warc.compressed(warc.record(i, None, b"x" * 30 * i)) for i in range(5)]
    bad = warc.MAGIC + bytes(60)

    def keys(data, size=None):
        size = size or len(data)
        return [warc.parsed(d)[0] for s in range(0, size, step)
                for _, d in warc.records(lambda a, n: data[a:a + n], s, min(s + step, size), size)]

    whole = b"".join(members)
    assert keys(whole) == [str(i) for i in range(5)]
    for data, size in [(bad + whole, None), (members[0] + bad + members[1], None), (whole + bad, None),
                       (whole[:-9], len(whole)), (whole[:-len(members[-1])], len(whole))]:
        with pytest.raises(ValueError, match="no record at byte"):
            keys(data, size)


def test_schema_types(spark):
    df = spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string")
    out = warc.read_archives(warc.write_archives(df, new_dir(spark, "archives")))
    assert out.schema["payload"].dataType == T.BinaryType()
