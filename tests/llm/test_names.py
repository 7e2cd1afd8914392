"""Column names that Spark takes for something else: another case, dots, clashes with own names, a number in the last place."""

import public_tokenizers
import pytest

from pulsegrid.llm import bpe, ngram_join, packing, quality, secret_scan, sharding, simhash, token_count, warc

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["Hello there world", None, "", "x y z " * 40, "Hello there world"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, f"dot {i}", f"tick {i}", 5, 10 * i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, Text string, `n.x` string, `a``b` string, row int, last long")


def own(df, like):
    """What the rows carry besides the result, by document."""
    assert set(like.columns) - {"Text"} <= set(df.columns)
    return sorted((r["doc_id"], r["n.x"], r["a`b"], r["row"], r["last"]) for r in df.collect())


OPERATORS = {
    "shards": lambda df: sharding.uniform_shards(df, 3),
    "secrets": lambda df: secret_scan.scan(df, text="text"),
    "quality": lambda df: quality.judged(df, text="text", order=list(quality.RULES)),
    "kept": lambda df: quality.keep_good(df, text="text").unionByName(df).dropDuplicates(["doc_id"]),
    "encoded": lambda df: bpe.decoded(bpe.encoded(df, PATH, text="text"), PATH),
    "simhash": lambda df: simhash.near_duplicates(df, text="text"),
    "counted": lambda df: token_count.counted(df, PATH, text="text"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_are_carried_whatever_their_names(odd, name):
    want = [(i, f"dot {i}", f"tick {i}", 5, 10 * i) for i in range(len(TEXTS))]
    assert own(OPERATORS[name](odd), odd) == want


def test_names_are_found_in_any_case(odd, spark):
    plain = odd.toDF("doc_id", "text", "n", "b", "row", "last")
    ids = {r.doc_id: r.ids for r in bpe.encoded(odd, PATH, text="text").collect()}
    assert ids == {r.doc_id: r.ids for r in bpe.encoded(plain, PATH).collect()} and ids[0] == ids[4] != ids[3]
    prints = {r.doc_id: r.fingerprint for r in simhash.with_fingerprints(odd, text="TEXT").collect()}
    assert prints == {r.doc_id: r.fingerprint for r in simhash.with_fingerprints(plain).collect()}
    counts = {r.doc_id: r.n_tokens for r in token_count.counted(odd, PATH).collect()}
    assert counts == {i: len(x) for i, x in ids.items()}
    packed = packing.packed(odd, PATH, doc="Doc_Id").collect()
    assert {r["Doc_Id"]: r.doc_tokens - 1 for r in packed} == counts
    linked = {r.doc_id: r.component_id for r in ngram_join.linked_documents(odd).collect()}
    assert linked == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}


def test_one_of_each_keeps_all_columns(odd):
    kept = simhash.one_of_each(odd, text="text")
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 3]


def test_ranges_are_read_by_many_tasks(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 500) for i in range(40)], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, warc.archive_folder(spark), archive_bytes=2000)
    read = warc.read_archives(manifest, split_bytes=500)
    assert read.count() == 40 and read.rdd.getNumPartitions() > 20
