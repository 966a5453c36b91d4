"""Quality classifier by compression: which of two dictionaries makes a text smaller?

One zstandard dictionary is trained from texts labelled good, one from texts labelled bad.
Every text is compressed, in short pieces, with each of them; pieces keep the dictionary in
play through a long text, where the compressor would else learn the text itself. The
difference of the two sizes over the text's bytes is the evidence, and a logistic curve in that
difference and the log of the length turns it into a calibrated score.

The dictionaries are trained on one half of a bounded sample of the labelled rows, the curve
is fitted on the other half, whose texts the dictionaries have not seen (a class of one text uses it for both). The bounds are
parameters (`SAMPLE_ROWS` and `SAMPLE_BYTES` per class); rows are taken in the order of a hash
of their id. Every sampled row takes part: where the texts of a class exceed the bytes, the
longest are held to one common length, in passages spread over the whole text, so no text uses
up the others' share. Scoring covers whole texts of every row and needs no shuffle.

Nulls count as empty; an empty text has no difference and gets the score the curve gives to
that. Labels that are null or neither 0 nor 1 are ignored. With one class missing (or none)
the score is the share of good rows among all training rows, 0.5 without any. Only the id and the text of the
scored table are read, so extra columns cannot clash; repeated rows are scored alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.common import sampled_ids, slices, stage

#: Bounds of the labelled sample, for each class.
SAMPLE_ROWS, SAMPLE_BYTES = 2_000, 8 << 20
DICT_BYTES, PIECE_BYTES, LEVEL = 131_072, 512, 3
#: A text that is too long for its share of the sample gives so many passages at most.
PASSAGES = 64


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    prior: float

    def scorer(self):
        """A function from one text (bytes) to its score; compressors are built once per worker task."""
        if not self.good or not self.bad:
            return lambda data: self.prior
        sizes, w = _sizer(self.good, self.bad), np.array(self.weights)
        return lambda data: float(_logistic(_features(np.array([sizes(data)], float)) @ w)[0])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sizer(good: bytes, bad: bytes):
    import zstandard as z

    pair = [z.ZstdCompressor(level=LEVEL, dict_data=z.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
            for d in (good, bad)]

    def sizes(data: bytes) -> tuple[int, int, int]:
        by_good = by_bad = 0
        for i in range(0, len(data), PIECE_BYTES):
            piece = data[i:i + PIECE_BYTES]
            by_good += len(pair[0].compress(piece))
            by_bad += len(pair[1].compress(piece))
        return by_good, by_bad, len(data)
    return sizes


def _features(sizes: np.ndarray) -> np.ndarray:
    n = sizes[:, 2]
    difference = 10 * (sizes[:, 1] - sizes[:, 0]) / np.maximum(n, 1)
    length = np.log1p(n)
    return np.column_stack([np.ones(len(n)), difference, length, difference * length])


def _fit(features: np.ndarray, label: np.ndarray, ridge: float = 1e-2, steps: int = 100) -> np.ndarray:
    """Logistic regression by Newton steps, each halved until the loss falls."""
    w = np.zeros(features.shape[1])

    def loss(v: np.ndarray) -> float:
        z = features @ v
        return float(np.sum(np.logaddexp(0, z) - label * z) + ridge * v @ v / 2)

    for _ in range(steps):
        p = _logistic(features @ w)
        gradient = features.T @ (label - p) - ridge * w
        step = np.linalg.solve((features * (p * (1 - p))[:, None]).T @ features + ridge * np.eye(len(w)), gradient)
        size, now = 1.0, loss(w)
        while loss(w + size * step) > now and size > 1e-6:
            size /= 2
        w = w + size * step
        if np.abs(step).max() * size < 1e-8:
            break
    return w


def common_length(lengths: list[int], size: int) -> int:
    """The largest length to which all texts can be held so that they have ``size`` bytes together."""
    left, n = size, len(lengths)
    for i, x in enumerate(sorted(lengths)):
        if x * (n - i) > left:
            return max(left // (n - i), 1)
        left -= x
    return max(lengths, default=1)


def held_to(text: str, limit: int) -> str:
    """``text``, or passages of ``limit`` bytes together, spread evenly over it and placed by a hash."""
    data = text.encode()
    if len(data) <= limit:
        return text
    parts = min(max(limit // PIECE_BYTES, 1), PASSAGES)
    width, length = len(data) // parts, max(limit // parts, 1)
    starts = (i * width + crc32(b"%d/%d" % (i, len(data))) % (width - length + 1) for i in range(parts))
    return b"".join(data[at:at + length] for at in starts).decode(errors="ignore")


def sample_labelled(docs: DataFrame, labels: DataFrame, where: Column, id_col: str, text: str, label: str,
                    rows: int, size: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``rows`` rows and about ``size`` bytes of each class, (_id, _y, _text, _n), and the classes' numbers of training rows.

    The choice is made on ids and lengths; only then are the chosen texts read, through a
    broadcast of at most ``2 * rows`` ids. ``_n`` is the size of the whole text.
    """
    marked = (labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("_id"))
              .agg(F.max(label).cast("int").alias("_y")))     # one label for an id: 1 if any row says so
    lengths = docs.filter(where).select(F.col(id_col).alias("_id"), F.octet_length(text).alias("_n")).filter("_n > 0")
    known = stage(lengths.join(marked, "_id").groupBy("_y", "_id").agg(F.max("_n").alias("_n")), "quality-labelled")
    counts = {0: 0, 1: 0} | {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    top = sampled_ids(known, "_y", "_id", rows)                 # at most 2 * rows ids
    chosen = stage(known.join(F.broadcast(top), ["_y", "_id"]).select("_id", "_y", "_n"), "quality-sample", 2 * rows)
    sizes = chosen.select("_y", "_n").collect()                 # at most 2 * rows numbers
    limit = {y: common_length([r["_n"] for r in sizes if r["_y"] == y], size) for y in (0, 1)}
    texts = docs.filter(where).select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).filter("_text <> ''")
    found = texts.join(F.broadcast(chosen.select("_id", "_y")), "_id").select("_id", "_y", "_text", F.octet_length("_text").alias("_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            short = [held_to(t, limit[y]) for t, y in zip(b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(short, pa.string()), b.column(3)], b.schema.names)

    held = found.mapInArrow(run, found.schema).groupBy("_id").agg(F.max("_y").alias("_y"), F.max(F.struct("_text", "_n")).alias("_held"))
    return held.select("_id", "_y", "_held.*"), counts


def train(docs: DataFrame, labels: DataFrame, where: Column | None = None, id_col: str = "doc_id", text: str = "text",
          label: str = "quality", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> QualityModel:
    """Dictionaries and curve from the labelled rows of ``docs`` that meet ``where``."""
    import zstandard as z

    where = F.lit(True) if where is None else where
    sample, counts = sample_labelled(docs, labels, where, id_col, text, label, rows, size)
    got = sample.orderBy(F.xxhash64("_id"), "_id").collect()    # at most 2 * rows texts and about 2 * size bytes
    by_class = {y: [(r["_text"].encode(), r["_n"]) for r in got if r["_y"] == y] for y in (0, 1)}
    prior = counts[1] / (counts[0] + counts[1]) if got else 0.5
    if not all(by_class.values()):
        return QualityModel(b"", b"", (), prior)

    def dictionary(texts: list[bytes]) -> bytes:
        pieces = [t[i:i + PIECE_BYTES] for t in texts for i in range(0, len(t), PIECE_BYTES)]
        total = sum(map(len, pieces))
        if total >= 20_000:
            try:
                return z.train_dictionary(min(DICT_BYTES, total // 8), pieces).as_bytes()
            except z.ZstdError:     # too few or too uniform pieces to train on: use passages of all texts
                pass
        limit = common_length([len(t) for t in texts], DICT_BYTES)
        return b"".join(held_to(t.decode(), limit).encode() for t in texts)

    half = {y: (v[: -(-len(v) // 2)], v[len(v) // 2:] if len(v) == 1 else v[-(-len(v) // 2):]) for y, v in by_class.items()}     # one text serves for both
    good, bad = (dictionary([t for t, _ in half[y][0]]) for y in (1, 0))
    sizes = _sizer(good, bad)
    held = [(np.array(sizes(t), float) * (whole / max(len(t), 1)), y) for y in (0, 1) for t, whole in half[y][1]]
    weights = _fit(_features(np.array([s for s, _ in held], float)), np.array([y for _, y in held], float))
    # The classes were sampled apart; move the curve to the shares that the training rows have.
    seen = len(half[1][1]) / len(held)
    weights[0] += math.log(prior / (1 - prior)) - math.log(seen / (1 - seen))
    return QualityModel(good, bad, tuple(map(float, weights)), prior)


def score(df: DataFrame, model: QualityModel, text: str = "text", column: str = "score") -> DataFrame:
    """``df`` with a double column ``column``; other columns pass through unchanged."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)     # two dictionaries of at most DICT_BYTES
    schema = T.StructType([*df.schema.fields, T.StructField(column, T.DoubleType())])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = shared.value.scorer()
        for b in slices(batches, at):
            scores = [one((t or "").encode()) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, column])

    return df.mapInArrow(run, schema)
