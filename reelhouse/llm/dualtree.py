"""Ranked lexical search: the k best documents of each item, by a dual-tree search with exact pruning.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. A document's
coordinate at a term is the term's part of its score (integers, see `impacts`); an item's is 1 at each of its terms.
So a score is an inner product, and for a set of documents the maxima of their coordinates, summed over all terms
that any of a set of items holds, bound every score between the two sets.

* Documents: one pass over the whole texts keeps the items' terms of each (`vectors`), and the corpus counts are taken from
  all of them. Each task then reads its vectors in batches; a batch is ordered by the documents' heaviest terms and becomes a
  hierarchy: nodes of `WIDTH` documents, nodes of `WIDTH` such nodes, and so on, with the maxima of each.
* Items: a hierarchy by halving, at the term that the items at hand share most evenly (`Node`).
* Search: pairs of nodes from both roots down. A pair whose bound is below the weakest kth score so far of the node's
  items is dropped with all that is under it. An equal bound is kept, as ties go to the smaller id. What reaches single documents
  is scored exactly, so the result doesn't depend on the batches, the order or the pruning.
* Each task returns its k best for each item; these are ranked in two steps, by item and shard of tasks, then by item.

Items are the stated query set. They are taken in blocks of about `BLOCK` terms, by a hash of the item; only a block's terms,
weights and hierarchy come to the driver and are broadcast, whatever the number of items (one item's own terms at least).

Null and empty texts and texts without terms have no score and no results. Rows of one item id are one item with the terms of
all; a null item id is an item. Repeated document rows are documents of their own, with equal scores; null document ids come first among
ties. Very long texts are read whole by one task. Empty tables give empty results. Only ids and texts are
read, so names of other columns can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.llm.common import slices, stage

#: Item terms in a block; coordinates in a batch of documents; children of a node of documents.
BLOCK, CELLS, WIDTH = 1 << 17, 1 << 22, 16
#: A pair of nodes goes down the documents' side once its items are this few, by level (documents: WIDTH ** 2, WIDTH, 1).
FEW = (8, 1)
SHARDS = 64

_FOLD = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text in order, as UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


def item_terms(items: DataFrame, item_col: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term) of each item, once each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1, 1 << 20):
            found = [sorted(set(terms_of(t))) for t in b.column(1).to_pylist()]
            at = np.repeat(np.arange(b.num_rows), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array([t for f in found for t in f], pa.binary())], ["item", "term"])

    kind = items.schema[item_col].dataType.simpleString()
    return items.select(F.col(item_col).alias("item"), F.col(text).alias("_text")).mapInArrow(run, f"item {kind}, term binary").distinct()


def vectors(docs: DataFrame, vocabulary, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n, terms, tfs) of each row with a term: all its terms counted, and those of ``vocabulary`` (a broadcast dict) listed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for b in slices(batches, 1):
            rows, ns, terms, tfs = [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                found = terms_of(t)
                if found:
                    ids, tf = np.unique(np.array([known[w] for w in found if w in known], np.int32), return_counts=True)
                    rows.append(i)
                    ns.append(len(found))
                    terms.append(ids)
                    tfs.append(tf)
            if not rows:
                continue
            starts = pa.array(np.r_[0, np.cumsum([len(t) for t in terms])].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(ns, pa.int64()), pa.ListArray.from_arrays(starts, pa.array(np.concatenate(terms))),
                 pa.ListArray.from_arrays(starts, pa.array(np.concatenate(tfs).astype(np.int64)))], ["doc", "n", "terms", "tfs"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc"), F.col(text).alias("_text")).mapInArrow(run, f"doc {kind}, n long, terms array<int>, tfs array<bigint>")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The terms' parts of a document's score. ``m`` grows with the document's length over the mean length."""
    return weights * (1_000_000_000 * tf // (1000 * tf + 20 * m))


@dataclass
class Node:
    """Some items: their places and the terms that any of them holds. A node of one item has no children."""
    items: np.ndarray
    terms: np.ndarray
    children: list[Node] = field(default_factory=list)


def item_tree(held: list[np.ndarray]) -> Node:
    """The hierarchy over items with these terms. Each is halved at the term that closest to half of its items hold."""
    def grow(items: np.ndarray) -> Node:
        every = np.concatenate([held[i] for i in items])
        terms, counts = np.unique(every, return_counts=True)
        node = Node(items, terms)
        if len(items) > 1:
            term = terms[np.argmin(np.abs(2 * counts - len(items)))]
            side = np.array([term in held_sets[i] for i in items])
            if side.all() or not side.any():
                side = np.arange(len(items)) < len(items) // 2
            # the larger side first on the work list keeps the depth of Python's stack small
            node.children = [Node(items[side], terms), Node(items[~side], terms)]
        return node

    held_sets = [set(h.tolist()) for h in held]
    root = grow(np.arange(len(held)))
    work = [root]
    while work:
        node = work.pop()
        node.children = [grow(c.items) for c in node.children]
        work.extend(node.children)
    return root


class Best:
    """The k best (score, document) of each item so far; equal scores by ascending id, null first."""

    def __init__(self, items: int, k: int):
        self.k, self.rows, self.kth = k, [[] for _ in range(items)], np.zeros(items, np.int64)

    def add(self, item: int, scores: np.ndarray, docs: pa.Array, at: np.ndarray) -> None:
        if len(scores) > self.k:
            few = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, at = scores[few], at[few]
        rows = self.rows[item]
        rows.extend((-s, d is not None, d) for s, d in zip(scores.tolist(), docs.take(pa.array(at)).to_pylist(), strict=True))
        if len(rows) >= 2 * self.k or (len(rows) >= self.k and not self.kth[item]):
            rows.sort()
            del rows[self.k:]
            self.kth[item] = -rows[-1][0]

    def top(self, item: int) -> list[tuple]:
        return sorted(self.rows[item])[: self.k]


def _levels(coordinates: np.ndarray) -> list[np.ndarray]:
    """The coordinates (terms x documents, a multiple of WIDTH ** 2 of them) and the maxima of the nodes, roots first."""
    out = [coordinates]
    for _ in FEW:
        t, n = out[0].shape
        out.insert(0, out[0].reshape(t, n // WIDTH, WIDTH).max(axis=2))
    return out


def visit(root: Node, levels: list[np.ndarray], docs: pa.Array, best: Best) -> int:
    """Search a batch's hierarchy; returns how many exact scores were taken."""
    scored, work = 0, [(root, 0, np.arange(levels[0].shape[1]))]
    while work:
        node, level, alive = work.pop()
        bounds = levels[level][np.ix_(node.terms, alive)].sum(axis=0)
        keep = bounds >= max(1, best.kth[node.items].min())
        alive = alive[keep]
        if not len(alive):
            continue
        if node.children and (level == len(FEW) or len(node.items) > FEW[level]):
            work.extend((c, level, alive) for c in node.children)
        elif level < len(FEW):
            work.append((node, level + 1, (alive[:, None] * WIDTH + np.arange(WIDTH)).ravel()))
        else:
            scored += len(alive)
            best.add(int(node.items[0]), bounds[keep], docs, alive)
    return scored


def _searched(found: DataFrame, model, documents: int, total: int, k: int, item_kind: str) -> DataFrame:
    """(shard, item, doc, score): each task's k best documents of each item. ``model``: broadcast (ids, weights, tree)."""
    kind = found.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights, root = model.value
        best = Best(len(ids), k)
        node = WIDTH ** len(FEW)
        most = max(node, CELLS // max(len(weights), 1) // node * node)
        for b in batches:
            for start in range(0, b.num_rows, most):
                part = b.slice(start, most)
                n = part.num_rows
                m = np.array([50 + 50 * x * documents // total for x in part.column(1).to_pylist()], np.int64)
                terms, tfs = part.column(2), part.column(3)
                size = np.diff(terms.offsets.to_numpy())
                at, term, tf = np.repeat(np.arange(n), size), terms.flatten().to_numpy(), tfs.flatten().to_numpy()
                got = impacts(weights[term], tf, m[at])
                heaviest = np.lexsort((-got, at))       # by document, heaviest term first
                first = np.full(n, -1, np.int64)
                first[at[heaviest][::-1]] = term[heaviest][::-1]
                order = np.argsort(first, kind="stable")
                place = np.empty(n, np.int64)
                place[order] = np.arange(n)
                grid = np.zeros((len(weights), -(-n // node) * node), np.int64)
                grid[term, place[at]] = got
                visit(root, _levels(grid), part.column(0).take(pa.array(order)), best)
        rows = [(ids[i], d, -s) for i in range(len(ids)) for s, _, d in best.top(i)]
        shard = TaskContext.get().partitionId() % SHARDS
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), shard, np.int32)), pa.array([r[0] for r in rows]).cast(item_type),
                                          pa.array([r[1] for r in rows]).cast(doc_type), pa.array([r[2] for r in rows], pa.int64())],
                                         ["shard", "item", "doc", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    doc_type = to_arrow_type(found.schema["doc"].dataType)
    schema = f"shard int, item {item_kind}, doc {kind}, score long"
    item_type = to_arrow_type(found.sparkSession.createDataFrame([], schema).schema["item"].dataType)
    return found.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", item_col: str = "item_id", text: str = "text",
           block: int = BLOCK) -> DataFrame:
    """(item, rank, doc, score): the k documents of the highest scores above 0 for each item, all if fewer; ranks begin at 1."""
    spark = docs.sparkSession
    held = stage(item_terms(items, item_col, text), "dualtree-items")
    item_kind, doc_kind = held.schema["item"].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    blocks = -(-held.count() // block)
    out = spark.createDataFrame([], f"shard int, item {item_kind}, doc {doc_kind}, score long")
    for number in range(blocks):
        rows = held.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()      # about `block` terms
        if not rows:
            continue
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        of: dict = {}
        for r in rows:
            of.setdefault(r["item"], []).append(vocabulary[bytes(r["term"])])
        found = stage(vectors(docs, spark.sparkContext.broadcast(vocabulary), id_col, text), "dualtree-vectors")
        documents, total = found.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        weights = np.full(len(vocabulary), 0, np.int64)
        for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():      # the block's terms
            weights[r["term"]] = weight(documents, r["count"])
        ids = sorted(of, key=lambda i: (i is not None, i))
        tree = item_tree([np.array(sorted(of[i]), np.int64) for i in ids])
        out = out.unionByName(_searched(found, spark.sparkContext.broadcast((ids, weights, tree)), documents, total, k, item_kind))
    best = [F.desc("score"), F.asc_nulls_first("doc")]
    few = out.withColumn("at", F.row_number().over(W.partitionBy("item", "shard").orderBy(*best))).filter(F.col("at") <= k)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*best))).filter(F.col("rank") <= k)
    return ranked.select("item", "rank", "doc", "score")
