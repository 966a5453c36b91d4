"""Language identification, word first, with back-off to character n-grams.

A word that the model knows scores, for each language, the log of its smoothed relative
frequency there. An unknown word falls back to its character n-grams (with marks for its
begin and end), the longest first: the first length with a known n-gram gives the mean of their
scores; with none, the next shorter length is tried. The scores of all words of the whole
text add up with the log of each language's share of the training rows. The highest wins,
ties go to the language that sorts first. `score` is its posterior probability, where the
log-likelihood is divided by the root of the number of words, as words of one text are not
independent.

Training counts words and n-grams in Spark over a bounded sample of labelled rows: `ROWS_PER_LANG` rows of each
language by a hash of the id, with about `BYTES_PER_LANG` of text (above `LANGS` languages, all share what `LANGS` have; the longest
texts are then held to one common length, in passages spread over them). Every language, word and n-gram of that sample is in the model, so only the
sample bounds it. The table holds the counts that are not 0. The languages' shares come from all training rows.

Texts are scored in Arrow slices: the distinct words of a slice are looked up once, the unknown ones are all backed off
in one pass, and the sums are taken over the pairs of text and word.

Null texts and texts without a letter give `und` with score 0. Rows with a null language are
never trained on. Without any training row every text is `und`. Very long texts are read whole, each in one task. Empty tables give empty
results. Repeated rows are independent; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.common import sampled_ids, slices, stage
from reelhouse.llm.quality import common_length, held_to

#: Bounds of the labelled sample for each language; `LANGS` languages have the bytes in full, more share as much.
ROWS_PER_LANG, BYTES_PER_LANG, LANGS = 2_000, 8 << 20, 16
#: The longest n-grams.
LONGEST = 4
UNKNOWN = "und"
#: Cells of the table that are added up at once.
CELLS = 1 << 21
#: Bytes of text that are scored at once.
SLICE = 4 << 20


def _ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that begin at ``begin`` and have ``n`` members, one after the other."""
    return np.arange(n.sum()) + np.repeat(begin - np.cumsum(n) + n, n)


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    prior: np.ndarray
    words: dict[str, int]                 # row of the table
    grams: tuple[dict[str, int], ...]     # by length - 1
    unseen: np.ndarray                    # by length (0: words): log probabilities of a known term in languages without it
    begin: np.ndarray                     # row i of the table is begin[i]:begin[i + 1] of the next two
    langs_of: np.ndarray                  # the languages that have the term
    above: np.ndarray                     # its log probability there, less that of `unseen`

    def backed_off(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For unknown words: the n-grams' length that scores each (-1: none), and cells (word, language, above `unseen`) by word."""
        size = np.full(len(words), -1, np.int64)
        rows: list[int] = []
        owners: list[int] = []
        left = list(range(len(words)))
        for n in range(LONGEST, 0, -1):
            known, after = self.grams[n - 1].get, []
            for k in left:
                marked = f"<{words[k]}>"
                own = [r for i in range(len(marked) - n + 1) if (r := known(marked[i:i + n])) is not None]
                if own:
                    size[k] = n
                    rows += own
                    owners += [k] * len(own)
                else:
                    after.append(k)
            left = after
        at, owner = np.array(rows, np.int64), np.array(owners, np.int64)
        weight = 1 / np.maximum(np.bincount(owner, minlength=len(words)), 1)[owner]
        n = self.begin[at + 1] - self.begin[at]
        cells = _ranges(self.begin[at], n)
        keys, inverse = np.unique(np.repeat(owner, n) * len(self.langs) + self.langs_of[cells], return_inverse=True)
        return size, keys // len(self.langs), keys % len(self.langs), np.bincount(inverse, self.above[cells] * np.repeat(weight, n), len(keys))

    def scorer(self):
        """A function from a list of texts to their languages and scores."""
        import regex

        letters = regex.compile(r"\p{L}+").findall
        n_langs = len(self.langs)
        unseen = np.vstack([self.unseen, np.zeros(n_langs)]) if n_langs else None      # the last row is for size -1

        def many(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
            found = [letters(t.lower()) if t else [] for t in texts]
            sizes = np.array([len(f) for f in found], np.int64)
            if not n_langs or not sizes.sum():
                return [UNKNOWN] * len(texts), np.zeros(len(texts))
            coded = pa.array(chain.from_iterable(found), pa.large_string()).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            keys, times = np.unique(np.repeat(np.arange(len(texts)), sizes) * len(distinct) + coded.indices.to_numpy(), return_counts=True)
            text, word = keys // len(distinct), keys % len(distinct)

            # One row of cells for each distinct word: the table's own, or those of its n-grams.
            row = np.array([self.words.get(w, -1) for w in distinct], np.int64)
            strange = np.flatnonzero(row < 0)
            size, owner, lang, value = self.backed_off([distinct[k] for k in strange])
            length = np.zeros(len(distinct), np.int64)
            length[strange] = size
            begin = np.where(row < 0, 0, self.begin[row])
            n = np.where(row < 0, 0, self.begin[row + 1] - self.begin[row])
            begin[strange] = len(self.langs_of) + np.searchsorted(owner, np.arange(len(strange)))
            n[strange] = np.bincount(owner, minlength=len(strange))
            langs_of, above = (np.concatenate([self.langs_of, lang]), np.concatenate([self.above, value])) if len(strange) else (self.langs_of, self.above)

            total = np.bincount(text * (LONGEST + 2) + length[word] % (LONGEST + 2), times, len(texts) * (LONGEST + 2)).reshape(-1, LONGEST + 2) @ unseen
            cost = np.cumsum(n[word])
            cuts = np.searchsorted(cost, np.arange(0, cost[-1] + CELLS, CELLS), "left") if cost[-1] else [0]
            for a, z in zip(cuts, [*cuts[1:], len(word)], strict=True):
                w = word[a:z]
                cells = _ranges(begin[w], n[w])
                at = np.repeat(text[a:z], n[w]) * n_langs + langs_of[cells]
                total += np.bincount(at, above[cells] * np.repeat(times[a:z], n[w]), total.size).reshape(total.shape)
            total = self.prior + total / np.sqrt(np.maximum(sizes, 1))[:, None]
            best = total.argmax(axis=1)
            score = 1 / np.exp(total - total[np.arange(len(texts)), best][:, None]).sum(axis=1)
            return [self.langs[b] if k else UNKNOWN for b, k in zip(best, sizes, strict=True)], np.where(sizes > 0, score, 0.0)
        return many


def _words(text: Column) -> Column:
    return F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1))


def train(docs: DataFrame, where: Column | None = None, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          rows: int = ROWS_PER_LANG, size: int = BYTES_PER_LANG) -> LanguageModel:
    """Learn from the rows of ``docs`` that meet ``where`` and have a language."""
    usable = F.col(lang).isNotNull() & F.col(text).isNotNull()
    if where is not None:
        usable = usable & where
    labelled = docs.filter(usable)
    shares = labelled.groupBy(F.col(lang).alias("lang")).count().collect()
    langs = tuple(sorted(r["lang"] for r in shares))
    if not langs:
        return LanguageModel((), np.zeros(0), {}, ({},) * LONGEST, *[np.zeros(0)] * 4)
    at = {x: i for i, x in enumerate(langs)}
    prior = np.zeros(len(langs))
    for r in shares:
        prior[at[r["lang"]]] = np.log(r["count"])
    prior -= np.logaddexp.reduce(prior)

    named = labelled.select(F.col(lang).alias("_lang"), F.col(id_col).alias("_id"))
    ids = sampled_ids(named, "_lang", "_id", rows).drop("rank")            # at most rows * languages
    ids = F.broadcast(ids) if len(langs) <= 64 else ids                    # of more, the join is left to Spark's size check
    texts = labelled.select(F.col(id_col).alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    counts = counted(held(texts.join(ids, ["_id", "_lang"]), size * LANGS // max(len(langs), LANGS)))
    entries = counts.toArrow()                   # the terms of the sample

    index: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    cells, n_rows = [], 0      # freed on return; the model holds arrays and the dictionaries
    for language, length, term, n in zip(*(entries.column(i).to_pylist() for i in range(4)), strict=True):
        row = index[length].get(term)
        if row is None:
            row = index[length][term] = n_rows
            n_rows += 1
        cells.append((row, at[language], n))
    size_of = np.zeros(n_rows, np.int64)
    for length, own in enumerate(index):
        size_of[np.fromiter(own.values(), np.int64, len(own))] = length
    row, col, n = np.array(sorted(cells), np.int64).reshape(-1, 3).T
    total = np.bincount(size_of[row] * len(langs) + col, n, (LONGEST + 1) * len(langs)).reshape(LONGEST + 1, len(langs))
    base = total + 0.5 * (np.bincount(size_of, minlength=LONGEST + 1)[:, None] + 1)
    begin = np.searchsorted(row, np.arange(n_rows + 1))
    return LanguageModel(langs, prior, index[0], tuple(index[1:]), np.log(0.5 / base), begin, col, np.log((n + 0.5) / 0.5))


def held(sample: DataFrame, size: int) -> DataFrame:
    """``sample`` (_id, _lang, _text), where the longest texts of a language are held to one length if all exceed ``size`` bytes."""
    lengths: dict[str, list[int]] = {}
    for r in sample.select("_lang", F.octet_length("_text").alias("n")).collect():        # at most rows * languages numbers
        lengths.setdefault(r["_lang"], []).append(r["n"])
    limit = {x: common_length(n, size) for x, n in lengths.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            short = [held_to(t, limit[x]) for x, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(short, b.column(2).type)], b.schema.names)

    rows = sample.select("_id", "_lang", "_text")
    return rows.mapInArrow(run, rows.schema)


def counted(sample: DataFrame) -> DataFrame:
    """(_lang, size, term, n): the words (size 0) and the n-grams of marked words in ``sample`` (_lang, _text)."""
    words = stage(sample.select("_lang", _words(F.col("_text")).alias("term")).groupBy("_lang", "term").agg(F.count("*").alias("n")), "langid-words")
    marked = words.select("_lang", "n", F.concat(F.lit("<"), "term", F.lit(">")).alias("w"))
    grams = marked.select("_lang", "n", "w", F.explode(F.sequence(F.lit(1), F.lit(LONGEST))).alias("size")).filter(F.length("w") >= F.col("size"))
    grams = grams.select("_lang", "size", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("w") - F.col("size") + 1), lambda i: F.substring(F.col("w"), i, F.col("size")))).alias("term"))
    grams = grams.groupBy("_lang", "size", "term").agg(F.sum("n").alias("n"))
    return words.select("_lang", F.lit(0).alias("size"), "term", "n").unionByName(grams)


def identify(df: DataFrame, model: LanguageModel, text: str = "text", columns: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``df`` with the language and the score of each whole text; other columns pass through."""
    shared = df.sparkSession.sparkContext.broadcast(model)     # bounded, see train()
    schema = T.StructType([*df.schema.fields, T.StructField(columns[0], T.StringType()), T.StructField(columns[1], T.DoubleType())])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = shared.value.scorer()
        for b in slices(batches, at, SLICE):
            langs, scores = many(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores)], [*b.schema.names, *columns])

    return df.mapInArrow(run, schema)
