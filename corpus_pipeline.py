"""A training corpus from raw documents: five stages, each written and read again before the next.

Rows keep the columns of ``documents``; the last stage adds ``copies``, how
often the mix takes a document. Every stage takes nulls in any column, empty
and very long texts, ties, repeated rows, further columns of any name, and an
empty table, which stays empty. What becomes of them is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpulse.llm import decontam, mixing, near, quality, secrets
from outpulse.llm.registry import table
from outpulse.session import store


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from this stage's own input, does not reject.

    Null and empty texts are judged by their statistics like others, repeated
    rows alike. Without labelled documents nothing is rejected.
    """
    measured = store(quality.measure(docs.select("doc_id", "text")), "pipeline-measured")
    model = quality.fit(measured, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group, the one with the smallest id.

    Of repeated rows one stays. Null ids come last, null texts count as empty,
    and texts without words are near nothing but their equals.
    """
    return near.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark item.

    Null and empty texts overlap nothing and stay. Rows equal in doc_id and
    text stay or go together. An empty benchmark drops nothing.
    """
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("rid").alias("_rid")).distinct()
    rows = docs.withColumn("_rid", F.xxhash64("doc_id", "text")).join(store(found, "pipeline-contaminated"), "_rid", "left_anti")
    return rows.select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` is that of the new text.

    A null text stays null and its ``n_chars`` becomes null. Repeated rows change alike.
    """
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how often.

    A null source is a source of its own; sources without words are not taken.
    Rows equal in doc_id and text go together. A column ``copies`` is replaced.
    """
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: Quality, near-duplicates and overlaps are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
