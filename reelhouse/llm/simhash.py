"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints: 64 bits over word shingles; a bit is set if more than half the shingles' hashes
have it. Equal fingerprints are one node, so exact copies never meet as pairs.

Links: two fingerprints that differ in at most ``tau`` bits. The 64 bits are dealt into ``m``
parts and each part i gets a threshold t_i, with the sum of the t_i being tau - m + 1 (a part with
t_i = -1 is not looked at). Then two fingerprints within tau bits are within t_i bits in at
least one part i: otherwise they differ in at least sum(t_i + 1) = tau + 1 bits. So each
fingerprint probes, in each part, all values within t_i bits of its own, and every candidate is
verified on all 64 bits.

* Bits that go together are put into one part, as a part of correlated bits is the one that
  divides badly, and the others then divide well. The correlations are counted over all fingerprints.
* m and the thresholds are chosen by dynamic programming over the estimated cost: the number
  of probes, and the number of candidates, from the distances between random pairs in each
  part (all fingerprints take part) and from the bits' own frequencies where no such pair was
  seen. The estimates steer the cost only, never the result.

Groups: only connected components are asked for, so the pairs within a large group are
neither made nor compared. First each fingerprint is held against the smallest one with its
value in each part, which contracts a group with a few links for each member. Then, in each value
of a part, one component has the most members; two members of it need not be compared. So
only the other members probe the whole value, and members of the largest one probe the others.

Null and empty texts have the fingerprint 0, linked like any other. Null ids are nodes of no
document: their rows get the component of their fingerprint. Repeated rows are kept. Empty
tables give empty results. Only the id and the text are read by `fingerprints`; `keep_one`
packs each row into one struct, so no name of an extra column can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import slices, stage
from reelhouse.llm.components import components

BITS = 64
#: A probe costs about as much as so many verified candidates.
PROBE_COST = 20
_CHUNK = 1 << 16


def fingerprint(text: str, words: int, seed: int = 42) -> bytes:
    """The 8 bytes (big-endian) of the fingerprint of a text."""
    import xxhash

    found = text.encode().lower().split()       # bytes: A-Z and ASCII white space only
    if not found:
        return bytes(8)
    n = max(1, len(found) - words + 1)
    digest, votes = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for start in range(0, n, _CHUNK):
        hashes = b"".join([digest(b" ".join(found[i:i + words]), seed) for i in range(start, min(n, start + _CHUNK))])
        votes += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > n).tobytes()


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text: str = "text", seed: int = 42) -> DataFrame:
    """(id, fp long) for each row; the long has the fingerprint's bits."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            data = b"".join([fingerprint(t or "", words, seed) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.frombuffer(data, ">i8").astype(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("_text")).mapInArrow(run, f"id {kind}, fp long")


# --- parts and thresholds -------------------------------------------------------------------

def _bits(values: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each value; column k is bit k (least significant first)."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(df: DataFrame, per_batch, width: int) -> np.ndarray:
    """The sum over all batches of the vector (``width`` numbers) that ``per_batch`` makes of the fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += per_batch(b.column(0).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["at", "n"])

    sums = df.mapInArrow(run, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()   # `width` rows
    out = np.zeros(width)
    for r in sums:
        out[r["at"]] = r["n"]
    return out


def grouped_bits(together: np.ndarray, n: float, parts: int) -> list[list[int]]:
    """Deal the bits into ``parts`` groups of near-equal width, correlated bits together.

    ``together[i, j]`` counts the fingerprints with both bits set (the diagonal: with bit i).
    """
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tied = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tied, 0)
    left, out = set(range(BITS)), []
    for i in range(parts):
        width = -(-len(left) // (parts - i))
        own = [max(left, key=lambda b: (tied[b, list(left)].sum(), -b))]
        left.remove(own[0])
        while len(own) < width:
            best = max(left, key=lambda b: (tied[b, own].sum(), -b))
            own.append(best)
            left.remove(best)
        out.append(sorted(own))
    return out


def allocate(candidates: list[list[float]], probes: list[list[float]], tau: int) -> tuple[float, list[int]]:
    """The thresholds (-1 to tau, one for each part, tau - m + 1 in all) of the least cost.

    ``candidates[i][t]`` and ``probes[i][t]`` are the numbers for part i at threshold t; -1 costs nothing.
    """
    m = len(candidates)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}     # sum of t + 1 so far
    for i in range(m):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, tau + 1):
                total = used + t + 1
                price = cost + (candidates[i][t] + PROBE_COST * probes[i][t] if t >= 0 else 0)
                if total <= tau + 1 and (total not in step or price < step[total][0]):
                    step[total] = (price, [*chosen, t])
        best = step
    return best[tau + 1]


def _near_chance(q: np.ndarray, tau: int) -> np.ndarray:
    """P(at most t of independent bits differ), t = 0 to tau; ``q``: each bit's chance to differ."""
    d = np.zeros(len(q) + 1)
    d[0] = 1
    for x in q:
        d[1:] = d[1:] * (1 - x) + d[:-1] * x
        d[0] *= 1 - x
    return np.cumsum(d)[: tau + 1]


def plan(nodes: DataFrame, n: int, tau: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that is looked at."""
    def pairs_of_bits(v: np.ndarray) -> np.ndarray:
        b = _bits(v).astype(np.float32)
        return (b.T @ b).astype(float).ravel()

    together = _summed(nodes, pairs_of_bits, BITS * BITS).reshape(BITS, BITS)
    p = np.diag(together) / max(n, 1)
    differ = 2 * p * (1 - p)
    dealt = {m: grouped_bits(together, n, m) for m in range(2, tau + 2)} if tau else {1: [list(range(BITS))]}
    masks = [np.array([sum(1 << b for b in part)], np.uint64) for m in dealt for part in dealt[m]]

    def distances(v: np.ndarray) -> np.ndarray:
        u, out = v.astype(np.int64).view(np.uint64), np.zeros((len(masks), tau + 2))
        for shift in range(1, min(5, len(u))):
            x = u ^ np.roll(u, shift)
            for k, mask in enumerate(masks):
                out[k, : tau + 1] += np.bincount(np.minimum(np.bitwise_count(x & mask), tau + 1), minlength=tau + 2)[: tau + 1]
            out[:, tau + 1] += len(u)
        return out.ravel()

    seen = _summed(nodes, distances, len(masks) * (tau + 2)).reshape(-1, tau + 2)
    choices, k = [], 0
    for m, parts in dealt.items():
        candidates, probes = [], []
        for part in parts:
            chance = np.maximum(np.cumsum(seen[k, : tau + 1]) / max(seen[k, tau + 1], 1), _near_chance(differ[part], tau))
            candidates.append((chance * n * n).tolist())
            probes.append(np.cumsum([float(comb(len(part), t)) * n for t in range(tau + 1)]).tolist())
            k += 1
        cost, chosen = allocate(candidates, probes, tau)
        choices.append((cost, [(part, t) for part, t in zip(parts, chosen, strict=True) if t >= 0]))
    return min(choices, key=lambda c: c[0])[1]


# --- links and components -------------------------------------------------------------------

def _long(bits) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def _flipped(part: int, own: Column):
    return lambda flip: F.struct(F.lit(part).alias("part"), own.bitwiseXOR(flip).alias("value"))


def _values(parts: list[tuple[list[int], int]], fp: Column, near: bool) -> Column:
    """Array of (part, value): the fingerprint's own values, or all within the part's threshold."""
    out = []
    for i, (part, t) in enumerate(parts):
        flips = [_long(c) for k in range((t if near else 0) + 1) for c in combinations(part, k)]
        own = fp.bitwiseAND(F.lit(_long(part)))
        if len(flips) == 1:
            out.append(F.array(F.struct(F.lit(i).alias("part"), own.alias("value"))))
        else:
            out.append(F.transform(F.array(*[F.lit(x) for x in flips]), _flipped(i, own)))
    return F.concat(*out)


def _linked(a: str, b: str, tau: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= tau


def linked_components(fps: DataFrame, tau: int) -> DataFrame:
    """(fp, least) for each fingerprint of ``fps`` (id, fp): ``least`` is the smallest id that links lead to."""
    nodes = stage(fps.groupBy("fp").agg(F.min("id").alias("id")), "simhash-nodes")
    n = nodes.count()
    if n < 2:
        return nodes.select("fp", F.col("id").alias("least"))
    parts = plan(nodes.select("fp"), n, tau)
    each = n * len(parts)                   # rows of a table with a value of each part

    # Contract: each fingerprint against the smallest one that has its value in a part.
    own = stage(nodes.select("fp", F.explode(_values(parts, F.col("fp"), False)).alias("at")).select("fp", "at.*"), "simhash-values")
    centres = own.groupBy("part", "value").agg(F.min("fp").alias("centre"), F.count("*").alias("members")).filter("members > 1")
    shared = stage(own.join(centres, ["part", "value"]), "simhash-shared", rows=each)
    stars = components(shared.filter(_linked("fp", "centre", tau)).select(F.col("fp").alias("a"), F.col("centre").alias("b")))
    named = stage(nodes.select("fp").join(stars, nodes.fp == stars.node, "left").select("fp", F.coalesce("component", "fp").alias("comp")), "simhash-stars", rows=n)

    # The component with the most members of each value; it need not be held against itself.
    held = own.join(named, "fp")
    sizes = held.groupBy("part", "value", "comp").agg(F.count("*").alias("k"))
    most = sizes.groupBy("part", "value").agg(F.max_by("comp", F.struct("k", "comp")).alias("most"), F.count("*").alias("comps"))
    probing = named.select("fp", "comp", F.explode(_values(parts, F.col("fp"), True)).alias("at")).select("fp", "comp", "at.*")
    if all(t == 0 for _, t in parts):
        most = most.filter("comps > 1")           # a value with one component has nothing to compare
    data = stage(held.join(most, ["part", "value"]).select("part", "value", F.col("fp").alias("other"), F.col("comp").alias("other_comp"), "most"), "simhash-data", rows=each)
    probes = probing.join(most.select("part", "value", "most"), ["part", "value"])
    test = (F.col("fp") < F.col("other")) & (F.col("comp") != F.col("other_comp")) & _linked("fp", "other", tau)

    def met(probe: DataFrame, with_: DataFrame) -> DataFrame:
        p, d = probe.select("part", "value", "fp", "comp"), with_.select(F.col("part").alias("p"), F.col("value").alias("v"), "other", "other_comp")
        return p.join(d, (F.col("part") == F.col("p")) & (F.col("value") == F.col("v")) & test).select(F.col("comp").alias("a"), F.col("other_comp").alias("b"))

    flips = sum(comb(len(part), k) for part, t in parts for k in range(t + 1))
    probes = stage(probes, "simhash-probes", rows=n * flips)
    bridges = met(probes.filter("comp <> most"), data).unionByName(met(probes.filter("comp = most"), data.filter("other_comp <> most")))
    joined = components(bridges.distinct())
    groups = named.join(joined, named.comp == joined.node, "left").select("fp", F.coalesce("component", "comp").alias("group"))
    groups = stage(groups.join(nodes, "fp").select("fp", "group", "id"), "simhash-groups", rows=n)
    least = groups.groupBy("group").agg(F.min("id").alias("least"))
    return groups.join(least, "group").select("fp", "least")


def near_duplicates(docs: DataFrame, words: int, tau: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, least) for each row of ``docs``.

    Rows of a fingerprint that many share are answered by the join's other side, one row for each
    fingerprint; Spark splits such a key, as both sides are written tables.
    """
    fps = stage(fingerprints(docs, words, id_col, text), "simhash-fingerprints")
    least = stage(linked_components(fps, tau), "simhash-least")
    return fps.join(least, "fp").select("id", "fp", "least")


def keep_one(docs: DataFrame, words: int, tau: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that are linked to a row with a smaller id; same columns.

    Of repeated rows with the id that stays, one stays. Rows with a null id stay only if no row
    of their group has an id, one for each group.
    """
    packed = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "docs-numbered")
    flat = packed.select(F.col("row"), F.col("doc").getField(id_col).alias("id"), F.col("doc").getField(text).alias("text"))
    key = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    fps = stage(fingerprints(flat.select(key.alias("key"), "text"), words, "key", "text"), "simhash-fingerprints")
    kept = linked_components(fps, tau).select(F.col("least.row").alias("row")).distinct()
    return packed.join(kept, "row", "left_semi").select("doc.*")
