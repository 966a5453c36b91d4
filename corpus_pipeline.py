"""The corpus pipeline: language ID, quality, exact dedup, SimHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``. ``run`` writes each stage's rows as Parquet under the shared
checkpoint folder and reads them again, so that a lost executor never costs more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import exact_dedup, langid, packing, quality, simhash
from reelhouse.llm.common import free_name, stage, table, utf8
from reelhouse.llm.queries import PREDICT_GOOD, SIMHASH_BITS, SIMHASH_WORDS

#: A language is rejected below this posterior; `und` (no letter) is always rejected.
LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letter, or no learned language likely enough."""
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    got = langid.identify(docs, langid.train(docs), columns=(pred, score))
    return got.filter((F.col(pred) != langid.UNKNOWN) & (F.col(score) >= LANGUAGE_SCORE)).drop(pred, score)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier, trained on the labelled ones among them, calls bad."""
    column = free_name(docs, "quality_score")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")), column=column)
    return scored.filter(F.col(column) >= PREDICT_GOOD).drop(column)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each normalised text."""
    return exact_dedup.deduplicate(docs, exact_dedup.new_index(spark, exact_dedup.buckets_for(docs.count())))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked fingerprints."""
    return simhash.keep_one(docs, SIMHASH_WORDS, SIMHASH_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every remaining document (byte-level, with an end mark) in a bucket, a batch and a slot."""
    return packing.pack(docs, F.octet_length(utf8("text")) + 1)


STAGES = [("language_id", language), ("quality", good_quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("packing", pack)]

#: No SQL: the classifiers, the fingerprints and the packing are not expressible; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
