"""Chat formatting by columnar byte assembly.

A turn becomes ``<turn>ROLE newline TEXT</turn> newline``. In role and text ``&`` becomes ``&amp;`` and
``<`` becomes ``&lt;`` (in the role a newline becomes ``&#10;``), so the control strings cannot occur inside
them and the way back is exact. The loss mask covers the escaped texts of assistant turns.

Rows are sorted by conversation, turn, role and text over range partitions, so a very long
conversation spreads over many tasks, also where its turns are null or repeated; the borders
look at the first `BORDER` characters of a text only. Each task assembles its rows by columns: numpy computes the lengths of all
segments (marks, roles, texts), their cumulative offsets and scatter indices, and copies
headers and contents into one preallocated buffer, which becomes an Arrow string column of
conversation parts. Parts are numbered (shard, part) in order; a conversation is
the concatenation of its parts. A slice of `SLICE` bytes of text bounds a task's memory; a longer text is a slice
of its own and takes a few times its bytes (escaped it has to fit one cell, 2 GB).

Reading back parses the formatted parts in order with running digests, so a conversation of any
length needs constant memory; its bytes go through one task, as a digest of a whole is a
sequential matter.

Null roles and texts count as empty; null turns come first; rows with the same turn are
ordered by role and text; repeated rows are turns of their own; a null conv_id is a
conversation. An empty table gives an empty result. Only the four columns are read, so
extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import slices, utf8

OPEN, MIDDLE, CLOSE = b"<turn>", b"\n", b"</turn>\n"
SLICE = 1 << 20
#: Segments above so many bytes are copied as a whole; index arrays take sixteen times the bytes that they copy.
LONG = 4_096
BORDER = 1_000
PARTS = "conv_id long, shard int, part long, formatted string, loss array<struct<start:int,length:int>>"


def _escaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(texts.cast(pa.large_string()), "&", "&amp;"), "<", "&lt;")


def unescaped(text: str) -> str:
    return text.replace("&#10;", "\n").replace("&lt;", "<").replace("&amp;", "&")


def _content(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, start and length of each string."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    return data, offsets[:-1], np.diff(offsets)


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copy data[start[i] : start[i] + length[i]] to out[at[i]:]: long segments one by one, all short ones at once by index arrays."""
    for i in np.flatnonzero(length > LONG):
        out[at[i]: at[i] + length[i]] = data[start[i]: start[i] + length[i]]
    short = length <= LONG
    at, start, length = at[short], start[short], length[short]
    total = int(length.sum())
    if total:
        run = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(at, length) + run] = data[np.repeat(start, length) + run]


def assemble(conv: np.ndarray, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, list[list[dict]]]:
    """Format rows (sorted; ``conv`` numbers their conversations): a string, the first row and the loss spans of each part."""
    n = len(conv)
    is_loss = pc.equal(roles, "assistant").to_numpy(zero_copy_only=False)
    role, role_at, role_n = _content(pc.replace_substring(_escaped(roles), "\n", "&#10;"))
    text, text_at, text_n = _content(_escaped(texts))
    marks = np.frombuffer(OPEN + MIDDLE + CLOSE, np.uint8)
    length = np.empty((n, 5), np.int64)
    length[:, 0], length[:, 2], length[:, 4] = len(OPEN), len(MIDDLE), len(CLOSE)
    length[:, 1], length[:, 3] = role_n, text_n
    ends = np.cumsum(length.ravel())
    begin = (ends - length.ravel()).reshape(n, 5)
    out = np.empty(int(ends[-1]), np.uint8)
    for k, offset in ((0, 0), (2, len(OPEN)), (4, len(OPEN) + len(MIDDLE))):
        _scatter(out, begin[:, k], marks, np.full(n, offset), length[:, k])
    _scatter(out, begin[:, 1], role, role_at, role_n)
    _scatter(out, begin[:, 3], text, text_at, text_n)
    first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    offsets = np.r_[begin[first, 0], len(out)].astype(np.int32)
    parts = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(out))
    spans: list[list[dict]] = [[] for _ in first]
    for i in np.flatnonzero(is_loss):
        p = int(np.searchsorted(first, i, "right") - 1)
        spans[p].append({"start": int(begin[i, 3] - offsets[p]), "length": int(text_n[i])})
    return parts, first, spans


def format_conversations(rows: DataFrame) -> DataFrame:
    """Conversation parts (`PARTS`) of rows (conv_id, turn, role, text)."""
    rows = rows.select(F.col("conv_id").cast("long"), "turn", utf8("role").alias("role"), utf8("text").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    # A beginning sorts as its text does, and texts of one beginning stay in one partition: shards follow the order.
    spread = rows.repartitionByRange(*order[:3], F.substring("text", 1, BORDER)).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        for b in slices(batches, 3, SLICE):
            ids = b.column(0)
            conv = pc.rank(ids, tiebreaker="dense", null_placement="at_start").to_numpy()
            parts, first, spans = assemble(conv, b.column(2), b.column(3))
            k = len(first)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(first)), pa.array(np.full(k, shard, np.int32)), pa.array(np.arange(number, number + k)), parts,
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))],
                ["conv_id", "shard", "part", "formatted", "loss"])
            number += k

    return spread.mapInArrow(run, PARTS)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted part."""
    opening, closing = OPEN.decode(), CLOSE.decode()
    for turn in formatted.split(closing)[:-1]:
        role, text = turn.removeprefix(opening).split("\n", 1)
        yield unescaped(role), unescaped(text)


def read_back(parts: DataFrame) -> DataFrame:
    """One row for each conversation, from its parts in order: turns, loss text and size, with digests."""
    ordered = parts.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "shard", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, started = None, False
        n = chars = loss_chars = 0
        turns = loss = None
        done: list[tuple] = []

        def row() -> tuple:
            return now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], names)

        for b in slices(batches, 3):
            for conv, formatted, spans in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if not started or conv != now:
                    if started:
                        done.append(row())
                    now, started, n, chars, loss_chars = conv, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                chars += len(formatted)
                for role, text in parse(formatted):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                data = formatted.encode()
                for s in spans:
                    text = unescaped(data[s["start"]: s["start"] + s["length"]].decode())
                    loss_chars += len(text)
                    loss.update(text.encode())
            if len(done) >= 1000:
                yield batch()
                done.clear()
        if started:
            done.append(row())
            yield batch()

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
