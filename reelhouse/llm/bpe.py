"""Byte-level BPE encoding and decoding, exact and in linear time per piece of text.

Ordinary BPE merges pairs in rank order. Its result is also the only sequence of tokens in
which every two neighbours are *compatible*, that is, merging the bytes of the two alone gives
back the same two tokens. So a piece can be encoded from left to right: take the longest
token at the position; if it is not compatible with the token before it, try its next shorter
prefix that is a token; if none is left, step back, and never try that position again.

The longest tokens come from one pass of an Aho-Corasick automaton (pyahocorasick) per piece.
Its keys are text, so bytes are mapped to Latin-1 characters. It holds the tokens reversed
and runs over the reversed piece, as a match that ends at a reversed position begins at
that position of the piece. Compatibility of pairs is memoised, and so are whole pieces; both
memos are emptied when they reach a stated size, which costs time only.

As the tokenizer library does, a piece that is a token as a whole is encoded as that token.

Nulls and empty texts give no ids and no bytes. Rows are independent (repeated rows encode
alike); an empty table gives an empty result; only the id and the text are read, so extra
columns cannot clash.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import slices

PIECE_MEMO, PAIR_MEMO = 600_000, 1_000_000


class BytePairCodec:
    """Encoder and decoder for one rank file and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.reversed = ahocorasick.Automaton()
        for b, i in ranks.items():
            self.reversed.add_word(b[::-1].decode("latin-1"), (len(b), i))
        self.reversed.make_automaton()
        self._shorter: dict[int, int] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE by rank; only ever called for the bytes of one or two tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives back both; ``left`` -1: of ``right`` alone."""
        key = (left, right)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIR_MEMO:
                self._pairs.clear()
            if left < 0:
                known = self.merge(self.token[right]) == [right]
            else:
                known = self.merge(self.token[left] + self.token[right]) == [left, right]
            self._pairs[key] = known
        return known

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        known = self._shorter.get(token)
        if known is None:
            b = self.token[token]
            known = next((self.ranks[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.ranks), -1)
            self._shorter[token] = known
        return known

    def encode_bytes(self, data: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        longest, length = [-1] * n, [0] * n
        for end, (size, token) in self.reversed.iter(data[::-1].decode("latin-1")):
            at = n - 1 - end
            if size > length[at]:
                longest[at], length[at] = token, size
        out: list[int] = []
        blocked = bytearray(n + 1)
        tokens, pos = self.token, 0
        candidate = longest[0]
        while pos < n:
            before = out[-1] if out else -1
            while candidate >= 0:
                end = pos + len(tokens[candidate])
                if not blocked[end] and self.compatible(before, candidate):
                    break
                candidate = self.shorter(candidate)
            if candidate >= 0:
                out.append(candidate)
                pos = end
                candidate = longest[pos] if pos < n else -1
            elif out:
                blocked[pos] = 1
                last = out.pop()
                pos -= len(tokens[last])
                candidate = self.shorter(last)
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return out

    def encode(self, text: str) -> list[int]:
        """The ids of a text: the pattern's matches, each encoded on its own."""
        memo = self._pieces
        pieces = self.split(text)
        try:
            return list(chain.from_iterable([memo[p] for p in pieces]))
        except KeyError:
            pass
        out: list[int] = []
        for p in pieces:
            ids = memo.get(p)
            if ids is None:
                ids = tuple(self.encode_bytes(p.encode()))
                if len(p) <= 64:
                    if len(memo) >= PIECE_MEMO:
                        memo.clear()
                    memo[p] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@functools.cache
def codec(path: str, pattern: str) -> BytePairCodec:
    """The codec of a rank file, built once per worker process."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(b): int(i) for b, i in map(bytes.split, filter(None, map(bytes.strip, f)))}
    return BytePairCodec(ranks, pattern)


def _texts(df: DataFrame, id_col: str, text: str) -> tuple[DataFrame, str]:
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")), kind


def encode_column(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(``id_col``, ids array<int>) for each row."""
    source, kind = _texts(df, id_col, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path, pattern).encode
        for b in slices(batches, 1):
            ids = pa.array([encode(t or "") for t in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], [id_col, "ids"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode_column(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(``id_col``, data binary) for each row of ids; null ids give no bytes."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(path, pattern).decode
        for b in batches:
            data = pa.array([decode(x or []) for x in b.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), data], [id_col, "data"])

    return df.select(F.col(id_col), F.col(ids)).mapInArrow(run, f"`{id_col}` {kind}, data binary")


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode each row in one pass: counts and digests of the ids and of the decoded bytes."""
    source, kind = _texts(df, id_col, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        decimal = {i: str(i) for i in own.token}.__getitem__
        sha = hashlib.sha256
        for b in slices(batches, 1):
            n, by_ids, by_bytes = [], [], []
            for t in b.column(1).to_pylist():
                ids = own.encode(t or "")
                n.append(len(ids))
                by_ids.append(sha(",".join(map(decimal, ids)).encode()).hexdigest())
                by_bytes.append(sha(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_bytes, pa.string())],
                                             [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
