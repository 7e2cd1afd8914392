"""The registered queries on the smallest tables: against DuckDB where SQL can express them, else against plain Python."""

import hashlib
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pulsegrid.llm import secret_scan
from pulsegrid.llm.quality import RULES
from pulsegrid.llm.queries import QUERIES
from pulsegrid.llm.sql import ORACLES

from ..oracle_check import compare, duck
from .test_links import joined_by_hand, whitened_by_numpy
from .test_rows import plain_components, plain_fingerprint
from .test_texts import fails, known, measures
from .test_tokens import LIBRARY, check_pieces, ids

SF = "/root/testdata/sf0.001"


def documents():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF).collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_duckdb(spark, name):
    n, differing, message = compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert differing == 0 and n > 0, message


def test_shards(spark):
    docs, got = dict(documents()), rows(spark, "op2_uniform_shards")
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
    sizes = [sorted(r["slot"] for r in got if r["shard"] == s) for s in range(40)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1


def test_secrets(spark):
    docs = dict(documents())
    for r in rows(spark, "op4_secret_scan"):
        spans = known(docs[r["doc_id"]])
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert r["base_sha256"] == sha(text)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == [s for s in text.split(",") if s]
    assert len(docs) == len(rows(spark, "op4_secret_scan"))


def test_tokens(spark):
    docs = dict(documents())
    coded, counted = rows(spark, "op6_bpe"), rows(spark, "op9_token_count")
    assert len(coded) == len(counted) == len(docs)
    for r in coded:
        found = ids(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(found), sha(",".join(map(str, found))), sha(docs[r["doc_id"]] or ""))
    for r in counted:
        n = len(ids(docs[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((docs[r["doc_id"]] or "").encode()), n, n > 512)


def test_near_duplicates(spark):
    docs = documents()
    prints = [plain_fingerprint(t) for _, t in docs]
    top = plain_components(prints)
    smallest = {}
    for (d, _), t in zip(docs, top):
        smallest[t] = min(d, smallest.get(t, d))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op7_simhash")}
    assert got == {d: (f"{p:016x}", smallest[t]) for (d, _), p, t in zip(docs, prints, top)}


def test_packing(spark):
    docs, got = documents(), rows(spark, "op8_packing")
    coded = {d: np.array([*ids(t), 1], "<u4") for d, t in docs}
    for r in got:
        r["ids"] = coded[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()
        assert r["ids_crc32"] == zlib.crc32(r["ids"])
    assert check_pieces(got, docs, 2048) < 0.02


def test_linked_documents(spark):
    docs = documents()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(spark, "op13_ngram_join")), key=repr)
    assert got == joined_by_hand(docs)


def test_whitened_vectors(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet", columns=["vec_id", "embedding"])
    n, want, shares = whitened_by_numpy(list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist())))
    got = {}
    for r in rows(spark, "op12_whitening"):
        got[r["vec_id"], r["component"]] = r
    assert len(got) == 4 * len(want) and all(r["n"] == n and r["identity_error"] < 1e-4 for r in got.values())
    for c in range(4):
        mine = np.array([got[i, c + 1]["whitened"] for i, _, _ in want])
        theirs = np.array([white[c] for _, _, white in want])
        assert min(abs(mine - theirs).max(), abs(mine + theirs).max()) < 1e-8
        assert all(got[i, c + 1]["deviation"] == d and abs(got[i, c + 1]["explained"] - shares[c]) < 1e-9 for i, d, _ in want)


def test_pipeline(spark):
    good = [(d, t) for d, t in documents() if not any(fails(rule, measures(t)) for rule in RULES)]
    top = plain_components([plain_fingerprint(t) for _, t in good])
    smallest = {}
    for (d, _), t in zip(good, top):
        smallest[t] = min(d, smallest.get(t, d))
    kept = dict(x for x in good if x[0] in smallest.values())
    pieces = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    assert set(pieces) == set(kept) and len(kept) > 100
    for doc, parts in pieces.items():
        found = np.frombuffer(b"".join(p for _, p in sorted(parts)), "<u4").tolist()
        text = LIBRARY.decode(found[:-1], skip_special_tokens=False)
        assert found[-1] == 1
        if not known(kept[doc]):
            assert text == kept[doc] or "[secret]" in text
        else:
            assert "[secret]" in text and not [s for s in known(text) if s[3] != "assign"]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()


def test_stages_take_empty_tables_and_nulls(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        stage(spark, odd, SF).collect()


def test_marks_are_no_secrets():
    assert not known("[secret]") and secret_scan.RANDOM == "random"
