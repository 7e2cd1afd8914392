"""Byte-pair encoding and decoding with the files of a public byte-level tokenizer.

Encoding works without merging: an Aho-Corasick automaton finds the longest token at a place of a piece of text; it, or else the
longest shorter token that starts it, is taken if it may follow the token before, and if none may, that one is shortened. Two
tokens may stand side by side if merging their parts in order of rank never joins across their border; a row of tokens in
which all neighbours may is the one that merging gives. A place that led nowhere is closed, so the work is linear in the piece.

Decoding copies bytes from one table of all tokens by their offsets.

Special strings inside texts become their own ids, as the library does by default. Defined cases: a NULL text is
empty and has no ids; NULL ids decode to an empty text; equal rows are coded alike and all stay; an empty table gives an empty
one; texts of any length are coded whole; other columns are carried, and one called like a result column is replaced.
"""

import functools
import json

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import types as T

from .columns import with_made

# Fixed value: the pattern that splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters on which the pattern library here and the tokenizer's, whose Unicode version is older, are known to agree.
#: A text with any other character is split by the tokenizer's own splitter.
AGREED = ("\\u0000-\\u0557\\u0559-\\u058a\\u058d-\\u087f\\u0900-\\u0c5b\\u0c5d-\\u0cdb\\u0cdd-\\u13ff\\u1e00-\\u206f\\u20a0-\\u2bff"
          "\\u3000-\\u9fff\\uac00-\\ud7a3\\ue000-\\ufffd\\U0001f300-\\U0001f64f\\U0001f680-\\U0001f6ff\\U0001f900-\\U0001f9ff")
#: Pieces of text in each of two generations that a worker remembers, and the length of those it never does.
MEMORY_PIECES, MEMORY_CHARS = 150_000, 64
#: Bytes of a long piece that are matched at once.
_PART = 1024


@functools.lru_cache(maxsize=1)
def _byte_symbols():
    """The printable character that stands for each byte: itself where printable, else one from 256 up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {b: chr(b) for b in own}
    symbols |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in symbols)}
    return {b: symbols[b] for b in range(256)}


class Vocabulary:
    """Tokens, merges and special strings of a tokenizer file whose ids number its merges in order."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path, self.ids = path, model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.parts = {i: (i, i) for i in self.ids.values()}
        self.joined, last = {}, -1
        for left, right in merges:
            a, b, c = self.ids[left], self.ids[right], self.ids[left + right]
            if c <= last or c <= max(a, b):
                raise ValueError(f"{path}: ids don't follow the order of the merges")
            self.parts[c], self.joined[a, b], last = (a, b), c, c
        self.lengths = {i: len(s) for s, i in self.ids.items()}
        self.longest = max(len(s) for s in self.ids)
        if 2 * self.longest > _PART:
            raise ValueError(f"{path}: tokens of over {_PART // 2} bytes")
        self.symbol_of = _byte_symbols()
        self.known_pairs = {}
        self.pattern, self.unsure = regex.compile(PATTERN), regex.compile(f"[^{AGREED}]")
        self.split_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(
            self.special, key=len, reverse=True)) + ")") if self.special else None

    @functools.cached_property
    def automaton(self):
        found = ahocorasick.Automaton()
        for symbols, i in self.ids.items():
            if symbols not in self.special:
                found.add_word(symbols, i)
        found.make_automaton()
        return found

    @functools.cached_property
    def shorter(self):
        """The longest token that is a proper beginning of each token."""
        return {i: next((self.ids[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.ids), None)
                for s, i in self.ids.items() if s not in self.special}

    @functools.cached_property
    def splitter(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path).pre_tokenizer

    def may_follow(self, left, right):
        pair = left << 32 | right
        known = self.known_pairs.get(pair)
        if known is None:
            if len(self.known_pairs) > 250_000:
                self.known_pairs.clear()
            known = self.known_pairs[pair] = self._never_joined(left, right)
        return known

    def _never_joined(self, left, right):
        """Undo the later of the two tokens' last merges again and again; at no time may the neighbours have an earlier merge."""
        bound = float("inf")
        while True:
            if self.joined.get((left, right), bound) < bound:
                return False
            left_part, right_part = self.parts[left][1], self.parts[right][0]
            whole_left, whole_right = left_part == left, right_part == right
            if whole_left and whole_right:
                return True
            if whole_right or (not whole_left and left > right):
                left, bound = left_part, left
            else:
                right, bound = right_part, right + 1

    def longest_tokens(self, symbols, place):
        """What ``iter_long`` gives for a long piece, in parts: the library copies all that it is given. The last tokens of a part may be
        cut short, so they are looked for again in the next."""
        while place < len(symbols):
            part = symbols[place:place + _PART]
            sure = len(part) - self.longest if place + len(part) < len(symbols) else len(part)
            for end, token in self.automaton.iter_long(part):
                if end >= sure:
                    place += end + 1 - self.lengths[token]
                    break
                yield end, token
            else:
                return

    def encode_piece(self, piece):
        symbols = piece.encode().decode("latin-1").translate(self.symbol_of)
        n, lengths, shorter, known = len(symbols), self.lengths, self.shorter, self.known_pairs.get
        tokens, closed, place, last = [], None, 0, None
        tokens_from = self.automaton.iter_long if n <= _PART else self.longest_tokens
        longest = tokens_from(symbols, 0)
        token = next(longest)[1]
        while True:
            whole = token
            while token is not None:
                end = place + lengths[token]
                if (closed is None or end not in closed) and (
                        last is None or known(last << 32 | token) or self.may_follow(last, token)):
                    break
                token = shorter[token]
            if token is None:
                closed = closed or set()
                closed.add(place)
                token = tokens.pop()
                place -= lengths[token]
                last = tokens[-1] if tokens else None
                longest = None
                continue
            tokens.append(token)
            place, last = end, token
            if place == n:
                return tokens
            if token != whole or longest is None:
                longest = tokens_from(symbols, place)
            token = next(longest)[1]

    def segments(self, text):
        """Parts of a text: (special id, None) or (None, pieces)."""
        for no, part in enumerate(self.split_special.split(text) if self.split_special else [text]):
            if no % 2:
                yield self.special[part], None
            elif part:
                yield None, self.pieces(part)

    def pieces(self, part):
        if self.unsure.search(part):
            return [part[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(part)]
        return self.pattern.findall(part)


class Remembered(dict):
    """What ``work`` gives for a piece of text. When there are too many, those not met again since the last time are let go."""

    def __init__(self, work):
        super().__init__()
        self.work, self.older = work, {}

    def __missing__(self, piece):
        value = self.older.get(piece) or self.work(piece)
        if len(piece) <= MEMORY_CHARS:
            if len(self) >= MEMORY_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value


class Encoder:
    def __init__(self, path):
        self.vocabulary = Vocabulary(path)
        self.codes = Remembered(lambda piece: np.array(self.vocabulary.encode_piece(piece), "<i4").tobytes())

    def encode(self, text):
        """The ids of a text as little-endian 32-bit numbers."""
        if not text:
            return b""
        out, code = [], self.codes.__getitem__
        for special, pieces in self.vocabulary.segments(text):
            if pieces is None:
                out.append(int(special).to_bytes(4, "little"))
            else:
                out += map(code, pieces)
        return b"".join(out)


class Decoder:
    def __init__(self, path):
        vocabulary = Vocabulary(path)
        byte_of = {s: b for b, s in vocabulary.symbol_of.items()}
        words = {i: bytes(byte_of[c] for c in s) for s, i in vocabulary.ids.items() if s not in vocabulary.special}
        words |= {i: s.encode() for s, i in vocabulary.special.items()}
        table = [words.get(i, b"") for i in range(max(words) + 1)]
        self.blob = np.frombuffer(b"".join(table), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(w) for w in table])]).astype(np.int64)

    def decode(self, ids):
        """Texts are put together byte by byte before they are read as UTF-8; unknown ids give nothing."""
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.offsets) - 1)]
        lengths = self.offsets[ids + 1] - self.offsets[ids]
        shift = self.offsets[ids] - (np.cumsum(lengths) - lengths)
        return self.blob[np.repeat(shift, lengths) + np.arange(lengths.sum())].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(path):
    """One per worker and file."""
    return Encoder(path)


@functools.lru_cache(maxsize=2)
def decoder(path):
    return Decoder(path)


def int_lists(parts):
    """An Arrow array with a list for each bytes object of little-endian 32-bit numbers."""
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encoded(df, path, text="text"):
    """``df`` with ``ids``, the token ids of the whole ``text``."""
    def work(column):
        code = encoder(path).encode
        return int_lists([code(t) for t in column.to_pylist()])

    return with_made(df, text, "ids", T.ArrayType(T.IntegerType()), work)


def decoded(df, path, ids="ids"):
    """``df`` with ``decoded``, the text that the list ``ids`` stands for, special strings included."""
    def work(column):
        read = decoder(path).decode
        flat, starts = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.concatenate(
            [[0], column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)]))
        return pa.array([read(flat[a:b]) for a, b in zip(starts[:-1], starts[1:])], pa.string())

    return with_made(df, ids, "decoded", T.StringType(), work)
