"""Encoding, counting and packing against the tokenizer library, which none but the tests uses for whole texts."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsegrid.llm import bpe, packing, token_count

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ALPHABETS = ["abcdefgh ", "aeiou stnr", "ab", " \n\t\r x", "é漢字かな한글Ж ", "0123456789.,-", "😀👍🏽 ‍", "'stremvld a", "-=_*#",
             ["<|endoftext|>", "<|endof", "text|>", " "], [chr(c) for c in (0, 0x558, 0x85, 0x180E, 0x3000, 0x10940, 0x3FC3B)]]


def texts(n=300, seed=1):
    rng = random.Random(seed)
    made = [None, "", " ", "   ", "\n\n a", "<|endoftext|>", "a<|endoftext|> b", "a" * 3000, "ab" * 2000, " " * 500, "-" * 700, "é" * 900]
    for i in range(n):
        made.append("".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.randint(0, 70))))
    return made + made[-3:]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_ids_and_texts(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "decoded": F.lit("clash")})
    out = bpe.decoded(bpe.encoded(df, PATH), PATH).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.ids == ids(r.text), r.text
        assert r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False) == (r.text or "")


def test_decoding_any_ids(spark):
    rng = random.Random(2)
    lists = [[rng.randrange(50257) for _ in range(rng.randint(0, 20))] for _ in range(100)] + [None, []]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    for r in bpe.decoded(df, PATH).collect():
        assert r.decoded == LIBRARY.decode(r.ids or [], skip_special_tokens=False)


def test_pieces_follow_the_tokenizer_on_every_character():
    vocabulary, split = bpe.Vocabulary(PATH), LIBRARY.pre_tokenizer.pre_tokenize_str
    for start in range(0, 0x110000, 0x40):
        for c in map(chr, range(start, start + 0x40)):
            if not "\ud800" <= c <= "\udfff" and not vocabulary.unsure.search(c):
                s = f"a{c}a1{c}1.{c}. {c} {c}"
                assert [m.span() for m in vocabulary.pattern.finditer(s)] == [o for _, o in split(s)], hex(ord(c))


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_PIECES", 20)
    monkeypatch.setattr(token_count, "MOST_STATES", 50)
    encoder, transducer = bpe.Encoder(PATH), token_count.Transducer(PATH)
    for t in texts(seed=8):
        assert np.frombuffer(encoder.encode(t), "<i4").tolist() == ids(t)
        assert transducer.count(t or "") == len(ids(t))
    assert len(encoder.codes) <= 20 and len(transducer.counts) <= 20


def test_states_alone_count():
    transducer = token_count.Transducer(PATH)
    for t in texts(seed=4):
        for piece in transducer.vocabulary.pieces(t or ""):
            symbols = piece.encode().decode("latin-1").translate(transducer.vocabulary.symbol_of)
            assert transducer._by_symbols(symbols) == len(LIBRARY.model.tokenize(symbols)), piece


@pytest.mark.parametrize("chunk", [1, 2, 7, 1 << 16])
def test_counts(spark, chunk):
    rows = list(enumerate(texts(120, seed=chunk)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"n_tokens": F.lit("clash"), "row": F.lit("own"), "chunk": F.col("doc_id"), "_": F.lit(1)})
    out = token_count.counted(df, PATH, chunk_chars=chunk).collect()
    assert sorted(r.doc_id for r in out) == [d for d, _ in rows]
    assert all(r.n_tokens == len(ids(rows[r.doc_id][1])) and r.row == "own" and r.chunk == r.doc_id for r in out)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encoded(df, PATH).count() == 0 and token_count.counted(df, PATH).count() == 0
    assert packing.packed(df, PATH).count() == 0


# ---- Packing ----

def plain_best_fit(lengths, window):
    """Windows as (room left) lists, searched one by one."""
    rooms = [0] * sum(n // window for n in lengths)
    for rest in sorted((n % window for n in lengths if n % window), reverse=True):
        fits = [r for r in rooms if r >= rest]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else window) - rest)
    return sorted(rooms)


@pytest.mark.parametrize("window", [1, 7, 64, 100])
def test_best_fit_decreasing(window):
    rng = random.Random(window)
    for _ in range(30):
        lengths = [rng.randint(1, 3 * window) for _ in range(rng.randint(0, 120))]
        placed, n = packing.best_fit(lengths, window)
        used = [0] * n
        for _, _, length, sequence, offset in sorted(placed, key=lambda p: (p[3], p[4])):
            assert offset == used[sequence]
            used[sequence] += length
        assert sorted(window - u for u in used) == plain_best_fit(lengths, window)
        for item, length in enumerate(lengths):
            pieces = sorted((s, k) for i, s, k, *_ in placed if i == item)
            assert [s for s, _ in pieces] == [sum(k for _, k in pieces[:j]) for j in range(len(pieces))]
            assert sum(k for _, k in pieces) == length


def check_pieces(rows, docs, window):
    """Every id in one piece, sequences gapless and not too long; the share of padding."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids"], r["doc_tokens"]))
    for pieces in by_sequence.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
    used = [sum(n for _, n in p) for p in by_sequence.values()]
    assert max(used, default=0) <= window
    assert set(by_doc) == {d for d, _ in docs}
    for doc, text in docs:
        want, pieces = [*ids(text), 1], sorted(by_doc[doc])
        assert [s for s, *_ in pieces] == [sum(p[1] for p in pieces[:i]) for i in range(len(pieces))]
        assert np.frombuffer(b"".join(p[2] for p in pieces), "<u4").tolist() == want
        assert all(p[3] == len(want) and zlib.crc32(p[2]) >= 0 for p in pieces)
    return sum(0 if u & (u - 1) == 0 else window - u for u in used) / max(1, sum(used))


@pytest.mark.parametrize("group", [200, 1 << 22])
def test_packed_documents(spark, group):
    docs = list(enumerate(texts(200, seed=6)))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "start": F.lit(1)})
    check_pieces(packing.packed(df.repartition(3), PATH, window=256, group_tokens=group).collect(), docs, 256)


def test_equal_rows_are_packed_each(spark):
    df = spark.createDataFrame([(1, "a b c")] * 3 + [(None, None)], "doc_id long, text string")
    rows = packing.packed(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows) == [(0, 1), (1, 4), (1, 4), (1, 4)]


@pytest.mark.parametrize("space", [" ", "\n"])
def test_a_document_with_two_million_blanks(space):
    text = "a b" + space * 2_000_000 + "c d<|endoftext|>" + space * 70_000
    assert packing.Tokens(PATH).ids(text).tolist() == ids(text)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "0123456789", "acgt", "ab"])
def test_long_runs_take_time_in_proportion(letters):
    rng = random.Random(4)
    code = bpe.encoder(PATH).vocabulary.encode_piece
    run = "".join(rng.choice(letters) for _ in range(2_000_000))
    assert code(run[:20_000]) == ids(run[:20_000])

    def seconds(n):
        begun = time.process_time()
        assert sum(bpe.encoder(PATH).vocabulary.lengths[i] for i in code(run[:n])) == n
        return time.process_time() - begun

    seconds(1000)
    short, long = seconds(250_000), seconds(2_000_000)
    assert long < 16 * short


def test_parts_of_a_long_piece_are_matched_as_the_whole(monkeypatch):
    vocabulary = bpe.encoder(PATH).vocabulary
    long = [(chars * (900 // len(chars))) for chars in ("-", "=", "ab", "the ", " ")]
    long += ["".join(random.Random(i).choice("abcdefgh0123é-") for _ in range(900)) for i in range(20)]
    whole = [vocabulary.encode_piece(p) for p in long]
    monkeypatch.setattr(bpe, "_PART", 2 * vocabulary.longest)
    assert [vocabulary.encode_piece(p) for p in long] == whole


@pytest.mark.parametrize("parts", [1, 64, 300])
def test_padding_does_not_follow_the_file_layout(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(parts)
    packed = packing.packed(docs, PATH).select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset").collect()
    sequences, held = {}, {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        held[r.doc_id] = held.get(r.doc_id, 0) + r.length
    for pieces in sequences.values():
        pieces.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, [*pieces[1:], (sum(n for _, n in pieces), 0)]))
        assert sum(n for _, n in pieces) <= 2048
    assert all(held[r.doc_id] == r.doc_tokens for r in packed)
    tokens = sum(r.length for r in packed)
    assert len(sequences) * 2048 < 1.01 * tokens
