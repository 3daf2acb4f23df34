"""The corpus pipeline: quality votes, toxicity, near-duplicates, benchmark contamination and
mixing, each stage over all rows that the one before kept.

Models learn from the labelled documents of the input folder, whatever earlier stages removed;
they are applied to the stage's own rows. All stages but the last return the columns of
``documents``; the last returns one row per document with its domain posterior, sampling rate
and number of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txengine.llm import bin_sketch, edit_pieces, hashed_ftrl, quality_votes, soft_mixing
from txengine.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_votes.keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return hashed_ftrl.keep_clean(docs, hashed_ftrl.fit_toxicity(known, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words to a shingle and similarity 0.8."""
    return bin_sketch.keep_one(docs, bin_sketch.SketchOptions(shingle=5))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return edit_pieces.keep_unseen(docs, table(spark, sf_dir, "benchmark"))


#: Shares of all tokens, far from what the stages before leave.
MIX = soft_mixing.MixOptions(weights={"clean": 0.9, "low": 0.06, "toxic": 0.04})


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", soft_mixing.domain_of_labels().alias("domain"))
    model = soft_mixing.fit_domains(table(spark, sf_dir, "documents"), labels, MIX)
    return soft_mixing.mix(docs, model, MIX)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]
# Models are trained and components are closed transitively: no SQL form; tests/llm compares
# every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
