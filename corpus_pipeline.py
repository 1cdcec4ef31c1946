"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before has written and writes its own rows as a table in the
shared folder, so a lost executor costs the tasks it ran and not the stages before. All but
the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import dartminhash, mixing, packing, pseudonyms, quality
from pulse.llm.common import table
from pulse.llm.queries import KEY, THRESHOLD, tokenizer_path
from pulse.session import cut


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    name = "score_"
    while name in docs.columns:
        name += "_"
    return quality.score(docs, model, name=name).where(F.col(name) >= THRESHOLD).drop(name) if model else docs


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies stays."""
    return dartminhash.near_dedup(docs)


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms of the same format, and so of the same length or nearly."""
    changed = pseudonyms.pseudonymise(docs, KEY, spans=None)
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, with the words it takes."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path(), 1024)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("PII", pii_pseudonyms),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# Learned scores, near copies, tokens and keyed pseudonyms are beyond SQL; tests/llm holds each stage against
# a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
