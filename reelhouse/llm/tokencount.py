"""Token counts: Arrow batches of texts go to the tokenizer, only lengths come back.

Batches are balanced by bytes (`common.slices`), and a long text is cut at *safe
boundaries*, so that no call gets an unbounded string. A boundary is safe when the counts
of the two sides add up to the count of the whole:

* The model marks a space as U+2581 and puts one such mark before a text. A merge joins
  neighbouring symbols only if the joined piece is in the vocabulary. If no piece has a mark
  after another character, no merge crosses from a non-space character into a space, and the
  two sides merge independently. The space itself is dropped from the right side, as the
  mark that is put before every text stands for it.
* This is checked against the vocabulary when the model is loaded; a model with such a piece,
  with another normaliser, or without that leading mark is never cut.

Nulls and empty texts count zero bytes and zero tokens. Repeated rows and ties are
independent rows. An empty table gives an empty result. Only the id and the text are read, so
extra columns cannot clash.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import byte_lengths, slices

#: Texts above this many characters are cut at the next safe boundary.
PIECE_CHARS = 32_768

_CUT = re.compile("[^ ▁](?= .)", re.S)


@functools.cache
def piece_model(path: str):
    """The model (once per worker process) and whether texts may be cut for it."""
    import sentencepiece as sp
    from sentencepiece import sentencepiece_model_pb2 as pb

    with open(path, "rb") as f:
        spec = pb.ModelProto.FromString(f.read())
    inner = re.compile("[^▁]▁")
    norm = spec.normalizer_spec
    safe = (norm.name == "identity" and not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces
            and not norm.remove_extra_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix
            and not any(inner.search(p.piece) for p in spec.pieces))
    return sp.SentencePieceProcessor(model_file=path), bool(safe)


def cut(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """The text in pieces of about ``limit`` characters whose counts add up to its count."""
    out, start = [], 0
    while len(text) - start > limit:
        m = _CUT.search(text, start + limit - 1)
        if not m:
            break
        out.append(text[start:m.end()])
        start = m.end() + 1          # the space at m.end() becomes the mark put before the next piece
    out.append(text[start:])
    return out


def piece_counts(path: str) -> Callable[[list[str]], np.ndarray]:
    """A function from texts to token counts by a sentencepiece model file."""
    def count(texts: list[str]) -> np.ndarray:
        model, safe = piece_model(path)
        parts: list[str] = []
        first = np.empty(len(texts), np.int64)
        for i, t in enumerate(texts):
            first[i] = len(parts)
            if safe and len(t) > PIECE_CHARS:
                parts.extend(cut(t))
            else:
                parts.append(t)
        got = np.fromiter(map(len, model.encode(parts, num_threads=1)), np.int64, len(parts))
        return np.add.reduceat(got, first) if len(texts) else got
    return count


def json_counts(path: str) -> Callable[[list[str]], np.ndarray]:
    """A function from texts to token counts by a tokenizers JSON file (texts are not cut)."""
    def count(texts: list[str]) -> np.ndarray:
        model = _json_model(path)
        return np.array([len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)], np.int64)
    return count


@functools.cache
def _json_model(path: str):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return model


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """(``id_col``, n_bytes, n_tokens) for each row of ``df``; whole texts, no special tokens added."""
    count = piece_counts(model_path) if model_path.endswith(".model") else json_counts(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(byte_lengths(b.column(1))), pa.array(count(texts))], [id_col, "n_bytes", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    text = F.col(text) if isinstance(text, str) else text
    return df.select(F.col(id_col), text.alias("_text")).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
