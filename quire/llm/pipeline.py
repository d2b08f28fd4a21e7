"""A corpus pipeline of five of the training-data operators.

Language ID drops what is in no learned language; line dedup drops lines that
many documents share; the n-gram Jaccard join leaves one document of each group
of near copies; mixing draws documents to the target weights of the domains; BPE
encodes what is left.

Defined cases, for ``run`` and each stage: an empty table gives an empty one with
the same columns; extra columns are carried along, whatever their names; rows
that repeat stay or go together, but for the third stage, which leaves one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, jaccard_join, language_id, line_dedup, mixing
from .common import cut, ensure_checkpoint_dir, narrow, read, remove, rows_of, unused, word_bpe_path

#: A document whose words fit the learned languages less well is rejected.
LEAST_FIT = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in learned languages, one or several: a letter at least, and words that fit them.

    Null and empty texts have no letter and go; a null doc_id is kept.
    """
    own = docs
    for c in docs.columns:
        if c.lower() in ("lang_pred", "score", "fit"):
            own = own.withColumnRenamed(c, f"__carried {c}")
    found = language_id.labelled(own).filter((F.col("lang_pred") != "und") & (F.col("fit") >= LEAST_FIT))
    return found.select(*[F.col(f"`{x}`").alias(c) for x, c in zip(own.columns, docs.columns)])


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others share; ``n_chars`` follows the text.

    A null text becomes ''; a null doc_id keeps its lines.
    """
    own = docs
    for c in docs.columns:
        if c.lower() in ("n_lines", "n_dropped"):
            own = own.withColumnRenamed(c, f"__carried {c}")
    out = line_dedup.dedup_lines(own)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{x}`").alias(c) for x, c in zip(own.columns, docs.columns)])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group at a Jaccard similarity of 0.8 of five-word shingles.

    Of rows that repeat a doc_id, which are one group, the one with the
    largest text in order stays (of equal texts, any).  Rows without a doc_id and texts
    without words link with nothing and stay.
    """
    groups = cut(jaccard_join.near_duplicates(docs, n=5, threshold=(4, 5)).filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows")))
    kept = rows_of(docs, narrow(cut(groups.select("doc_id"))), "doc_id")
    several = narrow(cut(groups.filter("rows > 1").select("doc_id")))
    if not several.isEmpty():
        text, nth = F.coalesce(F.col("text"), F.lit("")), unused(docs, "text")
        again = rows_of(kept, several, "doc_id")
        # Equal rows are one before the texts of a doc_id meet.
        again = again.withColumn(nth, text).groupBy("doc_id").agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.col(nth)).alias(nth))
        kept = kept.join(several, "doc_id", "left_anti").select(*docs.columns).union(again.select(*[F.col(nth)[c].alias(c) for c in docs.columns]))
    return kept.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of the labelled domains, none more than once; nulls are as in ``mixing.mix``."""
    return mixing.mix(docs, read(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents' ids and decoded texts; a null text is as an empty one."""
    return bpe.encode_documents(docs, word_bpe_path(), full=False)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("ngram_jaccard", drop_near_copies),
    ("source_mixing", mix_domains),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet in the shared folder and read again.

    A stage's folder goes once the next one is written; the last one stays, as the result reads it.
    """
    docs = read(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
