"""Which keys occur inside which names: a Bloom filter of the keys' beginnings, probed at every place of every name.

The filter holds two hashes of each key: of its first `Q` bytes (or all of a shorter key) and of the whole key. It is built in tasks as
words of bits and merged with ``bit_or``, so any number of partial filters is one; its size follows the number of keys up to `MOST_BITS`
(2 MB for each million keys, 32 MB at most: the broadcast's bound; beyond that it lets more through and the result stays exact).

Names are probed before any shuffle: the bytes of an Arrow batch are one buffer, whose places are hashed and looked up by
array operations. Only where a beginning may lie are whole keys' lengths cut out and looked up. What passes is joined with
the keys by equality, which is the exact test. So what is shuffled grows with the hits, not with names x places x key lengths.

Bytes are those of UTF-8, in which a key occurs in a name exactly where its bytes occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a key's beginning; hash functions; bits for each key and at most.
Q, HASHES, BITS_PER_KEY, MOST_BITS = 8, 4, 16, 1 << 28
#: Bytes of names that are probed at once.
PROBED = 4 << 20
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _places(codes: np.ndarray, bits: int):
    """For each hash function, the bit of each 64-bit code."""
    with np.errstate(over="ignore"):
        h = codes ^ (codes >> np.uint64(30))
        h = h * np.uint64(_MIX[0])
        h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[1])
        h ^= h >> np.uint64(31)
        step = (h >> np.uint64(32)) | np.uint64(1)
        for i in range(HASHES):
            yield (h + np.uint64(i) * step) & np.uint64(bits - 1)


def _start_codes(data: np.ndarray, q: int) -> np.ndarray:
    """A code of the ``q`` bytes at each place of ``data`` (which has Q spare bytes at its end), with ``q`` in it."""
    view = np.ndarray(len(data) - Q, "<u8", data.tobytes(), strides=(1,))
    with np.errstate(over="ignore"):
        return (view & np.uint64((1 << 8 * q) - 1)) * np.uint64(2 * q + 1) + np.uint64(q)


def _whole_code(key: bytes) -> int:
    from hashlib import blake2b

    return int.from_bytes(blake2b(key, digest_size=8).digest(), "little")


def _key_codes(keys: list[bytes]) -> np.ndarray:
    starts = np.array([int.from_bytes(k[:Q], "little") for k in keys], np.uint64)
    q = np.array([min(len(k), Q) for k in keys], np.uint64)
    with np.errstate(over="ignore"):
        return np.concatenate([starts * (np.uint64(2) * q + np.uint64(1)) + q, np.array([_whole_code(k) for k in keys], np.uint64)])


def build(keys: DataFrame, bits: int) -> np.ndarray:
    """The filter's words for the keys (text, first column; nulls and empty ones are left out)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            found = [k.encode() for k in b.column(0).to_pylist() if k]
            if not found:
                continue
            at = np.unique(np.concatenate(list(_places(_key_codes(found), bits))))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], ["word", "bits"])

    merged = keys.mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    rows = merged.toArrow()           # at most bits / 64 rows
    words = np.zeros(bits // 64, np.int64)
    words[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return words.view(np.uint64)


def _passes(words: np.ndarray, bits: int, codes: np.ndarray) -> np.ndarray:
    """The indices of the codes that the filter lets through."""
    left = np.arange(len(codes))
    for i in range(HASHES):
        place = next(p for k, p in enumerate(_places(codes[left], bits)) if k == i)
        left = left[(words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
    return left


def bits_for(keys: int) -> int:
    """A power of two of bits for so many keys."""
    return min(MOST_BITS, max(1 << 10, 1 << (BITS_PER_KEY * max(keys, 1) - 1).bit_length()))


def windows(names: DataFrame, keys: DataFrame) -> DataFrame:
    """(gram): pieces of the names (first column) that may be keys (first column, distinct); every key inside a name is among them."""
    spark = names.sparkSession
    lengths = sorted(r.n for r in keys.select(F.octet_length(keys.columns[0]).alias("n")).where("n IS NOT NULL").distinct().collect())
    if not lengths:
        return spark.createDataFrame([], "gram string")
    bits = bits_for(keys.count())
    shared = spark.sparkContext.broadcast(build(keys, bits))         # at most MOST_BITS

    def pieces(batches: Iterator, pa) -> Iterator:
        """The names in columns of about `PROBED` bytes."""
        for b in batches:
            column = b.column(0).drop_null().cast(pa.large_binary())
            rows = max(1, len(column) * PROBED // max(column.nbytes, 1))
            for i in range(0, len(column), rows):
                yield column.slice(i, rows)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words = shared.value
        for column in pieces(batches, pa):
            offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
            data, offsets = np.concatenate([data, np.zeros(Q, np.uint8)]), offsets - offsets[0]
            raw, found = data.tobytes(), set()
            if lengths[0] == 0:
                found.add(b"")
            for q in sorted({min(n, Q) for n in lengths if n}):
                at = _passes(words, bits, _start_codes(data, q))
                room = offsets[np.searchsorted(offsets, at, "right").clip(max=len(offsets) - 1)] - at      # bytes left in the name
                for n in (n for n in lengths if n and min(n, Q) == q):
                    cut = list({raw[i:i + n] for i in at[room >= n].tolist()} - found)
                    if cut:
                        codes = np.array([_whole_code(c) for c in cut], np.uint64)
                        found.update(cut[i] for i in _passes(words, bits, codes))
            grams = [g.decode() for g in found if _text(g)]
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string())], ["gram"])

    return names.mapInArrow(run, "gram string")


def _text(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:         # cut inside a character: no key
        return False
    return True
