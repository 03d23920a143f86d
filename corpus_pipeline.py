"""A training corpus from ``documents``: language, near-duplicates, benchmark copies, mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result to the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketlens.llm import decontaminate, language, mixing, neardup, tokens
from ticketlens.llm.common import save, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told (operator 3)."""
    return language.keep_identified(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 1)."""
    return neardup.keep_one_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item (operator 10)."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them (operator 4)."""
    return mixing.mixed_rows(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back (operator 2)."""
    return tokens.token_table(docs)


STAGES = [
    ("language", identified),
    ("near-duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("mix", mixed),
    ("tokens", token_files),
]

# the mix and the tokens have no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
