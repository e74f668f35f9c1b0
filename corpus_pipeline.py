"""The corpus pipeline: documents in, a mixed training set out.

STAGES run in order, each on what the stage before it kept; a stage's output is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanspark.llm import decontaminate, langid, line_dedup, mixing, near_dedup
from gleanspark.llm.common import materialize, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows whose language is accepted; the dictionaries are learned from ``docs``."""
    answers = langid.identify(docs, langid.fit(docs), keep=True)
    return answers.filter("accepted").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts; a text that has nothing left goes."""
    kept = line_dedup.line_dedup(docs, keep=True, passage_words=50)
    return kept.filter("n_removed_lines = 0 or length(text) > 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id."""
    verdicts = near_dedup.near_dedup(docs)
    gone = verdicts.filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate_docs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn pieces of the mix, one row per document, reading and block."""
    return mixing.mix(docs).filter("block is not null")


STAGES = [("language_id", identify_language), ("line_dedup", dedup_lines),
          ("near_dedup", drop_near_copies), ("decontamination", decontaminate_docs),
          ("mixing", mix_sources)]

#: Compression, hashing of lines and sampling are not SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
