"""Operator 3: byte-level BPE encoding and decoding.

Each match of the split pattern is encoded by itself. Its bytes, read as
Latin-1 characters, go through an Aho-Corasick automaton of the vocabulary
(pyahocorasick), which gives the longest token at every position in one pass.
Tokens are then laid from left to right, longest first; a token may follow
another only if the merges by rank would leave the border between them alone,
which is decided by undoing both tokens' merges from the latest on and is
memoised per pair. A position found to be a dead end is marked and never tried
again, so the work is linear in the bytes, and the result is that of the
merges themselves.

Defined results: a null text is empty and has no tokens; decoding null ids
gives null, and an id outside the vocabulary raises. Rows are handled one by
one, whole; other columns are carried along untouched. A carried column with
the name of the output column is replaced.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcorpus.llm.common import in_slices, per_process, ship_by_value

#: Entries kept by the memo of words and by that of token pairs; both start anew when full.
WORD_MEMO, PAIR_MEMO = 400_000, 1_000_000
#: Longer matches of the pattern are encoded without being kept.
MEMO_CHARS = 64


def read_ranks(path: str) -> bytes:
    """The vocabulary file (base64 token and rank per line), read on the driver."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x)}


def latin_pattern(pattern: str) -> str:
    """The pattern for texts of Latin-1 characters and the ``re`` module, which
    is faster there: the classes it lacks, and white space, are listed."""
    import regex

    latin = "".join(map(chr, range(256)))
    listed = {c: "".join(f"\\x{ord(x):02x}" for x in regex.findall(c, latin)) for c in (r"\p{L}", r"\p{N}", r"\s")}
    out, k, depth = [], 0, 0
    while k < len(pattern):
        name = next((c for c in (*listed, r"\S") if pattern.startswith(c, k)), None)
        if name == r"\S":
            out.append(f"[^{listed[chr(92) + 's']}]")
        elif name:
            out.append(listed[name] if depth else f"[{listed[name]}]")
        else:
            name = pattern[k:k + 2] if pattern[k] == "\\" else pattern[k]
            depth += {"[": 1, "]": -1}.get(name, 0)
            out.append(name)
        k += len(name)
    return "".join(out)


class Encoder:
    """Encodes with one vocabulary of ranks, splitting texts by ``pattern`` (of the ``regex`` module)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import re

        import ahocorasick
        import regex

        self.ranks = ranks
        self.find, self.find_latin = regex.compile(pattern).findall, re.compile(latin_pattern(pattern)).findall
        size = max(ranks.values()) + 1
        self.token = [b""] * size
        self.size = [0] * size
        self.automaton = ahocorasick.Automaton()
        for t, r in ranks.items():
            self.token[r], self.size[r] = t, len(t)
            self.automaton.add_word(t.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.made = [n == 1 for n in self.size]
        for r in sorted(ranks.values()):
            self.made[r] = self.size[r] == 1 or self.split(r) is not None
        #: The longest token that merges make and that is a proper prefix of the token, or -1.
        self.shorter = [self._prefix(t) for t in self.token]
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}

    def _prefix(self, b: bytes) -> int:
        found = (self.ranks[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in self.ranks)
        return next((t for t in found if self.made[t]), -1)

    def when(self, t: int) -> int:
        """The time a token comes into being: single bytes are there from the start."""
        return t if self.size[t] > 1 else -1

    def split(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``t``; None if merging its bytes never makes it."""
        if t not in self.splits:
            self.splits[t] = None
            b = self.token[t]
            for k in range(1, len(b)):
                left, right = self.ranks.get(b[:k]), self.ranks.get(b[k:])
                if left is None or right is None or max(self.when(left), self.when(right)) >= t:
                    continue
                if self.made[left] and self.made[right] and self.apart(left, right, t):
                    self.splits[t] = (left, right)
                    break
        return self.splits[t]

    def apart(self, a: int, b: int, until: int) -> bool:
        """Whether no merge before the time ``until`` crosses the border of ``a`` and ``b``.

        The two tokens at the border are followed back in time. Undoing the
        left one, made at its rank, leaves the border to merges of lower rank;
        undoing the right one also to those of the same rank, as merges of one
        rank go from left to right."""
        while True:
            across = self.ranks.get(self.token[a] + self.token[b])
            if across is not None and across < until:
                return False
            left, right = self.when(a), self.when(b)
            if left < 0 and right < 0:
                return True
            if left > right:
                until, a = left, self.splits[a][1]
            else:
                until, b = right + 1, self.splits[b][0]

    def follows(self, a: int, b: int) -> bool:
        """``apart`` for all times, kept in the memo of pairs."""
        if len(self.pairs) >= PAIR_MEMO:
            self.pairs.clear()
        known = self.pairs[a << 32 | b] = self.apart(a, b, len(self.token))
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        n, size, made, shorter, pairs = len(piece), self.size, self.made, self.shorter, self.pairs.get
        longest = [0] * n
        for end, t in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size[t]] = t  # ends come in order: the last for a start is the longest
        live = bytearray(b"\1") * (n + 1)
        laid: list[int] = []
        at, last, t = 0, -1, longest[0]
        if not made[t]:
            t = shorter[t]
        while True:
            end = at + size[t]
            fits = live[end]
            if fits and last >= 0:
                fits = pairs(last << 32 | t)
                if fits is None:
                    fits = self.follows(last, t)
            if fits:
                laid.append(t)
                if end == n:
                    return laid
                at, last, t = end, t, longest[end]
                if not made[t]:
                    t = shorter[t]
                continue
            t = shorter[t]
            while t < 0:  # nothing fits here: mark the place, go back a token and try a shorter one
                live[at] = 0
                t = laid.pop()
                at -= size[t]
                last = laid[-1] if laid else -1
                t = shorter[t]

    def encode_word(self, word: str) -> list[int]:
        ids = self.encode_piece(word.encode())
        if len(word) <= MEMO_CHARS:
            if len(self.words) >= WORD_MEMO:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        known, slow = self.words.get, self.encode_word
        try:
            text.encode("latin-1")
            found = self.find_latin(text)
        except UnicodeEncodeError:
            found = self.find(text)
        for w in found:
            ids += known(w) or slow(w)
        return ids


def _schema(df: DataFrame, column: str, kind: T.DataType, drop: str | None) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name.lower() != column.lower() and f.name != drop]
    return T.StructType([*fields, T.StructField(column, kind)])


def encode(df: DataFrame, vocabulary: bytes, pattern: str, text: str = "text", out: str = "ids",
           keep_text: bool = True) -> DataFrame:
    """Add ``out``: the token ids of the whole ``text`` (without special tokens)."""
    schema = _schema(df, out, T.ArrayType(T.IntegerType(), False), None if keep_text else text)
    raw = df.sparkSession.sparkContext.broadcast(vocabulary)
    names = schema.names[:-1]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        shared, key = per_process(), ("bpe", hashlib.sha256(raw.value + pattern.encode()).hexdigest())
        encoder = shared.get(key) or shared.setdefault(key, Encoder(parse_ranks(raw.value), pattern))
        for batch in batches:
            for part in in_slices(batch, text):
                ids: list[int] = []
                ends = [0]
                for t in part.column(text).to_pylist():
                    ids += encoder.encode(t or "")
                    ends.append(len(ids))
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(ids, np.int32)))
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], column], [*names, out])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the bytes that the token ids stand for."""
    schema = _schema(df, out, T.BinaryType(), None)
    raw = df.sparkSession.sparkContext.broadcast(vocabulary)
    names = schema.names[:-1]

    def run(batches):
        import pyarrow as pa

        token = {r: t for t, r in parse_ranks(raw.value).items()}.__getitem__
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                try:
                    found = [None if x is None else b"".join(map(token, x)) for x in part.column(ids).to_pylist()]
                except KeyError as e:
                    raise ValueError(f"id {e} is not in the vocabulary") from None
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], pa.array(found, pa.binary())], [*names, out])

    return df.mapInArrow(run, schema)


ship_by_value(__name__)
