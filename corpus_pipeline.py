"""Corpus pipeline: quality rules, near-duplicates, repeated passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept.  All but the last return the columns of their input, whatever
these are, besides ``doc_id`` and ``text``; the last returns token pieces with
their places in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.llm import phrases
from snapfold.llm.common import stage, table
from snapfold.llm.decisions import document_stats, learn_rules
from snapfold.llm.packing import packed_documents
from snapfold.llm.simhash import near_duplicates


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the rest of the row in one column, so that no operator's column can clash with one of the input."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*rest).alias("row"))


def _unpacked(packed: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` again, the text from the column named."""
    return packed.select(*[F.col(text).alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned decision list rejects."""
    measured = stage(document_stats(_packed(docs)), "pipeline-stats")
    rules = learn_rules(measured, table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return _unpacked(measured.where(~failed & rules.keep()), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, that of the smallest id."""
    return _unpacked(near_duplicates(_packed(docs)).where("representative"), docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that begin earlier in the corpus."""
    return _unpacked(phrases.remove_repeats(_packed(docs), joined=False), docs, "kept_text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of 2048."""
    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_copies),
    ("substring dedup", repeated_passages),
    ("best-fit packing", packing),
]

#: No stage but the first is SQL's kind of work; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
