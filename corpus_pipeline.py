"""The corpus pipeline: documents in, packed training sequences out.

Five stages, each one of the llm operators over all that the stage before it
kept; between stages lies a Parquet table.  All but the last return the
columns of ``documents``.

Defined results: a null or empty text fails the quality rules; rows of null
id are judged like others, and of near duplicates the smallest id that isn't
null stays; repeated rows are near duplicates, one stays; very long texts are
treated whole; an empty table gives an empty result; further columns, those
named like an operator's own included, pass every stage but the last;
``n_chars`` may be missing or null.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import secret_ledger
from starmart.llm.common import freed, read_table, written
from starmart.llm.decontaminate import decontaminated
from starmart.llm.jaccard_join import first_of_each
from starmart.llm.packing import packed
from starmart.llm.quality_rules import keep_unrepetitive
from starmart.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repetitive documents go."""
    return keep_unrepetitive(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the document with the smallest id stays."""
    return first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark items go."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; ``n_chars``, if it is there,
    follows."""
    clean = secret_ledger.redacted(docs, secret_ledger.update_ledger(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packed(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("jaccard_join", jaccard_join),
          ("decontamination", decontamination), ("secret_scans", secret_scans), ("packing", packing)]

#: Token ids aren't expressible in SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        freed(spark)  # its shuffles don't stand beside the next stage's
    return STAGES[-1][1](spark, docs, sf_dir)
