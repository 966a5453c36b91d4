"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

A document's set holds the 64-bit hashes of its distinct word n-grams (A-Z lower-cased; words are what
ASCII white space parts; with fewer words than n, the whole sequence is the one member). A *node* is a distinct
set, so that copies meet nobody twice. Two nodes link when 100 * intersection >= ``least`` * union.

1. Alone: a set of n members with more than n - ceil(least * n / 100) members of its own links with nothing. One
   member in `SHARE` (by hash, the same ones everywhere) is counted for that, which proves most sets alone. A task
   passes on at most two nodes for each member, so that a member that all have is no hot key.
2. Tiles: of the other sets, members are ordered by how many sets have them, rarest first. Linked sets share one of
   their first n - ceil(least * n / 100) + 1 members, and their sizes are in the same band or in neighbouring ones (a band
   ends where a set of its beginning stops being ``least`` percent of it). So a set lies in the tiles (band, member) of these
   members and of its own band and the one below. Members that only one set has make no tile.
3. In a tile, the sizes, the members' places and the signatures bound the intersection from above. A signature has
   `BITS` bits, each the parity of the members that hash to it, so two signatures differ in at most as many bits as the sets in members.
4. What remains is compared exactly, by merging the sorted arrays.

Only components are asked for, so a tile's pairs are not all made. First each set is held against centres, the smallest
node of its tile and of a random share of it, which contracts a group of copies with two links a member. Then only sets of different components are
compared: those outside a tile's largest component against all of the tile, one pair for each two components first, then what still
lies in two. Nothing is capped; the rest of a hot tile is an equality join on written tables, which Spark splits.

Null and empty texts and texts without words have the empty set, linked with nothing. Whole texts are read, whatever
their length (a set takes 8 bytes a word in one task). Repeated rows are kept; equal ids with different texts are different
documents. Null ids take part, and are a component's id only if it has no other. Empty tables give empty results.
Only the id and the text are read, so names of other columns can't clash. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import slices, stage
from reelhouse.llm.components import components

#: Bits of a signature.
BITS = 512
#: One member in so many is counted to prove sets alone.
SHARE = 3
#: Members that a task sorts at once on the map side, and the mean number of them in a part on the other.
CHUNK, PART = 1 << 21, 1 << 20
#: The mean number of nodes whose counts one task adds up at a time.
CROWD = 1 << 16
#: Sets of a tile that share a centre, beside the tile's own.
CREW = 8
_WORDS = BITS // 64


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def members(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct n-gram hashes of a text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    found = (text or "").encode().lower().split()       # bytes: A-Z and ASCII white space only
    if not found:
        return np.empty(0, np.uint64)
    h = np.array([digest(w) for w in found], np.uint64)
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k: len(h) - n + 1 + k])
    return np.unique(out)


def node_of(s: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s.tobytes(), seed=len(s)) - (1 << 63)


def signature(s: np.ndarray) -> np.ndarray:
    """`BITS` parities as 64-bit integers."""
    odd = np.bincount((s % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def needed(n: Column, least: int) -> Column:
    """The members that a set of ``n`` must share with any set that it links with."""
    return F.floor((n * least + 99) / 100)


def overlap(n: Column, m: Column, least: int) -> Column:
    """The members that sets of ``n`` and ``m`` must share to link."""
    return F.floor(((n + m) * least + 99 + least) / (100 + least))


def band(n: Column, least: int) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / least)) + 1e-9)


def described(docs: DataFrame, words: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, node) for each row: the set's size and its node (meaningless for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            sets = [members(t, words) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([node_of(s) for s in sets], pa.int64())], ["id", "n", "node"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("_text")).mapInArrow(run, f"id {kind}, n long, node long")


def _least_and_most(members_: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each member once, with the least and the greatest node that has it."""
    order = np.lexsort((nodes, members_))
    m, n = members_[order], nodes[order]
    first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]]) if len(m) else np.empty(0, np.int64)
    return m[first], n[first], n[np.r_[first[1:], len(n)] - 1] if len(m) else n


def _summed(nodes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each node once, with its counts added up."""
    node, at = np.unique(np.concatenate(nodes), return_inverse=True)
    return node, np.bincount(at, np.concatenate(counts), len(node)).astype(np.int64)


def own_members(docs: DataFrame, words: int, parts: int, crowds: int, text: str = "text") -> DataFrame:
    """(node, own): how many of the counted members no other node has.

    Members are dealt over ``parts``, and what a part finds of its nodes over ``crowds`` of nodes, both as packed arrays: at
    most one count for each counted member.
    """
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            m, low, high = _least_and_most(np.concatenate(ms), np.concatenate(ns))
            two = low != high
            m, nodes = np.concatenate([m, m[two]]), np.concatenate([low, high[two]])
            part = m // np.uint64(SHARE) % np.uint64(parts)
            order = np.lexsort((nodes, part))
            m, nodes, part = m[order], nodes[order], part[order].astype(np.int64)
            cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            ends = np.r_[cut[1:], len(m)]
            return pa.RecordBatch.from_arrays(
                [pa.array(part[cut]), pa.array([m[a:e].tobytes() for a, e in zip(cut, ends, strict=True)], pa.binary()),
                 pa.array([nodes[a:e].tobytes() for a, e in zip(cut, ends, strict=True)], pa.binary())], ["part", "members", "nodes"])

        ms, ns, held = [], [], 0
        for b in slices(batches, 0):
            for t in b.column(0).to_pylist():
                s = members(t, words)
                node, s = node_of(s), s[s % np.uint64(SHARE) == 0]
                if len(s):
                    ms.append(s)
                    ns.append(np.full(len(s), node, np.int64))
                    held += len(s)
                if held >= CHUNK:
                    yield flush()
                    ms, ns, held = [], [], 0
        if held:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            _, low, high = _least_and_most(np.concatenate(ms), np.concatenate(ns))
            node, k = np.unique(low[low == high], return_counts=True)
            crowd = node.view(np.uint64) % np.uint64(crowds)
            order = np.argsort(crowd, kind="stable")
            node, k, crowd = node[order], k[order].astype(np.int32), crowd[order].astype(np.int64)
            cut = np.flatnonzero(np.r_[True, crowd[1:] != crowd[:-1]]) if len(node) else np.empty(0, np.int64)
            ends = [*cut[1:], len(node)]
            return pa.RecordBatch.from_arrays(
                [pa.array(crowd[cut]), pa.array([node[a:e].tobytes() for a, e in zip(cut, ends, strict=False)], pa.binary()),
                 pa.array([k[a:e].tobytes() for a, e in zip(cut, ends, strict=False)], pa.binary())], ["crowd", "nodes", "counts"])

        now, ms, ns = None, [], []
        for b in batches:
            for part, m, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part != now and ms:
                    yield flush()
                    ms, ns = [], []
                now = part
                ms.append(np.frombuffer(m, np.uint64))
                ns.append(np.frombuffer(n, np.int64))
        if ms:
            yield flush()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, counts, held = None, [], [], 0
        for b in batches:
            for crowd, n, k in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if crowd != now and nodes:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(nodes, counts)], ["node", "own"])
                    nodes, counts, held = [], [], 0
                now = crowd
                nodes.append(np.frombuffer(n, np.int64))
                counts.append(np.frombuffer(k, np.int32).astype(np.int64))
                held += len(nodes[-1])
                if held >= CHUNK:
                    nodes, counts = ([x] for x in _summed(nodes, counts))
                    held = 0
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(nodes, counts)], ["node", "own"])

    blobs = docs.select(F.col(text).alias("_text")).mapInArrow(spread, "part long, members binary, nodes binary")
    dealt = blobs.repartition(parts, "part").sortWithinPartitions("part")
    found = dealt.mapInArrow(count, "crowd long, nodes binary, counts binary")
    return found.repartition(crowds, "crowd").sortWithinPartitions("crowd").mapInArrow(total, "node long, own long")


def sets_of(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """(node, n, members array, s0..): one row for each row of ``docs`` with a word."""
    names = ["node", "n", "members", *(f"s{k}" for k in range(_WORDS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 0, 1 << 20):
            sets = [s for t in b.column(0).to_pylist() if len(s := members(t, words))]
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets], np.int64)
            flat = pa.array(np.concatenate(sets).view(np.int64))
            marks = np.stack([signature(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) for s in sets], pa.int64()), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), flat),
                 *(pa.array(np.ascontiguousarray(marks[:, k])) for k in range(_WORDS))], names)

    marks = ", ".join(f"s{k} long" for k in range(_WORDS))
    return docs.select(F.col(text).alias("_text")).mapInArrow(run, f"node long, n long, members array<bigint>, {marks}")


def tiles(sets: DataFrame, least: int) -> DataFrame:
    """(band, member, away, node, n, place) for each tile that a set of ``sets`` (one row a node) lies in.

    ``away`` is 1 in the band below the set's own; two sets that are both away meet in their own band. Tiles of one set, or of none at home, are left out.
    """
    each = sets.select("node", "n", F.explode("members").alias("member"))
    shared = each.groupBy("member").agg(F.count("*").alias("sets")).filter("sets > 1")
    common = each.join(shared, "member").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("sets", "member"))).alias("common"))
    n, own = F.col("n"), F.col("n") - F.size("common")
    first = F.slice("common", F.lit(1), F.greatest((n - needed(n, least) + 1 - own).cast("int"), F.lit(0)))
    placed = common.select("node", "n", own.alias("own"), F.posexplode(first).alias("at", "rare"))
    here = placed.select(F.posexplode(F.array(band(n, least), band(n, least) - 1)).alias("away", "band"), F.col("rare.member").alias("member"),
                         "node", "n", (F.col("own") + F.col("at")).alias("place"))
    here = stage(here, "setjoin-places")
    met = here.groupBy("band", "member").agg(F.count("*").alias("k"), F.min("away").alias("least")).filter("k > 1 AND least = 0")
    return here.join(met.select("band", "member", "k"), ["band", "member"])


def signatures(sets: DataFrame) -> DataFrame:
    """(node, s0..): narrow rows, joined only where two sets may still link."""
    return sets.select("node", *(f"s{k}" for k in range(_WORDS)))


def _fits(least: int) -> Column:
    """Whether sets x_ and y_ of one tile can link, by their sizes and their places in it."""
    n, m = F.col("x_n"), F.col("y_n")
    return ((F.col("x_away") + F.col("y_away") < 2) & (F.least(n, m) * 100 >= F.greatest(n, m) * least)
            & (F.least(n - F.col("x_place"), m - F.col("y_place")) >= overlap(n, m, least)))


def _near(least: int) -> Column:
    """Whether sets x_ and y_ can link, by their signatures."""
    differ = sum((F.bit_count(F.col(f"x_s{k}").bitwiseXOR(F.col(f"y_s{k}"))) for k in range(_WORDS)), F.lit(0))
    n, m = F.col("x_n"), F.col("y_n")
    return differ <= n + m - 2 * overlap(n, m, least)


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("band", "member", *(F.col(c).alias(f"{name}_{c}") for c in rows.columns if c not in ("band", "member")))


def linked(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The rows of ``pairs`` (a, b: nodes; more columns may follow) whose sets link, by exact intersection."""
    a = sets.select(F.col("node").alias("a"), F.col("members").alias("_a"))
    b = sets.select(F.col("node").alias("b"), F.col("members").alias("_b"))
    width = len(pairs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = batch.column(width), batch.column(width + 1)
            keep = np.zeros(batch.num_rows, bool)
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            lv, rv = left.values.to_numpy(), right.values.to_numpy()
            for i in range(batch.num_rows):
                x, y = lv[lo[i]: lo[i + 1]], rv[ro[i]: ro[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= least * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(batch.columns[:width], batch.schema.names[:width]).filter(pa.array(keep))

    joined = pairs.join(a, "a").join(b, "b").select(*pairs.columns, "_a", "_b")
    return joined.mapInArrow(run, pairs.schema)


def _against_centres(own: DataFrame, marks: DataFrame, least: int) -> DataFrame:
    """(a, b): for each set the smallest and the greatest node among the centres that it may link with.

    Centres are the smallest node of each tile and of random shares of about `CREW` sets of each tile, so the pairs grow as the tiles' rows do. A
    set meets much the same centres in all its tiles, as the shares go by the node.
    """
    keys = ["band", "member", "crew"]
    crew = F.pmod(F.xxhash64("node"), F.ceil(F.col("k") / CREW))
    both = own.withColumn("crew", F.explode(F.array(F.lit(-1).cast("long"), crew))).drop("k")        # -1: the whole tile
    home = both.groupBy(*keys).agg(F.min(F.struct("away", "node", "n", "place")).alias("y")).filter("y.away = 0")
    home = home.select(*keys, *(F.col(f"y.{c}").alias(f"y_{c}") for c in ("away", "node", "n", "place")))
    x = both.select(*keys, *(F.col(c).alias(f"x_{c}") for c in ("away", "node", "n", "place")))
    near = x.join(home, keys).filter((F.col("x_node") != F.col("y_node")) & _fits(least)).select("x_node", "y_node", "x_n", "y_n").distinct()
    for side in ("x", "y"):
        near = near.join(marks.select(*(F.col(c).alias(f"{side}_{c}") for c in marks.columns)), f"{side}_node")
    chosen = near.filter(_near(least)).groupBy("x_node").agg(F.min("y_node").alias("low"), F.max("y_node").alias("high"))
    pairs = chosen.select("x_node", F.explode(F.array("low", "high")).alias("y_node"))
    return pairs.select(F.greatest("x_node", "y_node").alias("a"), F.least("x_node", "y_node").alias("b")).distinct()


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` (node, comp) after the links (c, d) between components."""
    joined = components(links.select(F.col("c").alias("a"), F.col("d").alias("b")))
    both = comps.join(joined.withColumnRenamed("node", "_old"), F.col("comp") == F.col("_old"), "left")
    return stage(both.select("node", F.coalesce("component", "comp").alias("comp")), "setjoin-groups")


def _linked_groups(sets: DataFrame, least: int) -> DataFrame:
    """(node, comp) for the nodes of ``sets`` that lie in tiles; those that link have one comp."""
    own = stage(tiles(sets, least), "setjoin-tiles")
    marks = signatures(sets)
    alone = own.select("node").distinct().withColumn("comp", F.col("node"))
    first = linked(_against_centres(own, marks, least), sets, least)
    named = _merged(alone, first.withColumnsRenamed({"a": "c", "b": "d"}))

    held = own.drop("k").join(named, "node")
    counts = held.groupBy("band", "member", "comp").agg(F.count("*").alias("k"))
    most = counts.groupBy("band", "member").agg(F.max_by("comp", F.struct("k", "comp")).alias("most"), F.count("*").alias("comps"))
    open_ = stage(held.join(most.filter("comps > 1").drop("comps"), ["band", "member"]).join(marks, "node"), "setjoin-open")
    # Each pair of components once: members outside the largest one against all; among themselves by order.
    x, y = _side(open_.filter("comp <> most").drop("most"), "x"), _side(open_, "y")
    test = (F.col("x_comp") != F.col("y_comp")) & ((F.col("y_comp") == F.col("y_most")) | (F.col("x_node") < F.col("y_node"))) & _fits(least) & _near(least)
    met = (x.join(y, ["band", "member"]).filter(test)
           .select(F.col("x_node").alias("a"), F.col("y_node").alias("b"), F.least("x_comp", "y_comp").alias("c"), F.greatest("x_comp", "y_comp").alias("d")))
    met = stage(met.distinct(), "setjoin-met")
    # One pair for each two components first; what then still lies in two is compared in full.
    one = met.groupBy("c", "d").agg(F.min(F.struct("a", "b")).alias("pair")).select("pair.a", "pair.b", "c", "d")
    named = _merged(named, linked(one, sets, least))
    of = named.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
    rest = (met.select("a", "b").join(of.withColumnsRenamed({"_n": "a", "_c": "c"}), "a").join(of.withColumnsRenamed({"_n": "b", "_c": "d"}), "b").filter("c <> d"))
    return _merged(named, linked(rest, sets, least))


def near_duplicates(docs: DataFrame, words: int = 5, least: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, least) for each row: the set's size and the smallest id that links lead to, its own included.

    ``least`` is the similarity asked for in percent (50 to 99).
    """
    rows = stage(described(docs, words, id_col, text), "setjoin-rows")
    nodes = stage(rows.filter("n > 0").groupBy("node").agg(F.max("n").alias("n"), F.min("id").alias("id")), "setjoin-nodes")
    known, total = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    own = own_members(docs, words, 1 + total // SHARE // PART, 1 + known // CROWD, text)
    open_ = F.coalesce("own", F.lit(0)) <= F.col("n") - needed(F.col("n"), least)
    left = stage(nodes.join(own, "node", "left").filter(open_).select("node", "id"), "setjoin-left")
    read = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    chosen = left.select(F.col("id").alias("_id"))
    # The ids grow with the corpus, so they are never broadcast; only the texts of these sets are made into sets again.
    found = sets_of(read.join(chosen.hint("merge"), read.id.eqNullSafe(chosen["_id"]), "left_semi"), words)
    sets = stage(found.join(left.select("node"), "node", "left_semi").dropDuplicates(["node"]), "setjoin-sets")
    groups = _linked_groups(sets, least)
    named = stage(nodes.select("node", "id").join(groups, "node", "left").select("node", "id", F.coalesce("comp", "node").alias("group")), "setjoin-groups")
    smallest = named.groupBy("group").agg(F.min("id").alias("least"))
    labels = named.join(smallest, "group").select("node", F.col("least"), F.lit(True).alias("any"))
    linked_ = rows.join(labels, (rows.node == labels.node) & (rows.n > 0), "left")
    return linked_.select("id", "n", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("least"))
