"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on every row that the stage
before it kept, and returns a DataFrame; its rows are written as Parquet and
read again as the next stage's ``docs``.

Every stage but the last returns the columns of its input, and keeps columns
that it does not know as they are, whatever their names.  Cases:

* NULL and empty texts: not toxic; rejected by the quality rules.
* NULL ids: kept as rows of their own; of a group of copies, a row with an id
  stays before one without.
* Repeated rows: judged alike; the near-dedup keeps one of them.
* Very long texts: every stage judges them whole; packing cuts them.
* An empty table: no rows, in every stage.
* Empty, tiny or one-sided labels: no model, and no document is toxic.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import line_dedup, packing, quality_rules, simhash, toxicity
from ledgerline.llm.common import read, written


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; all of them
    where the labels allow no model."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return quality_rules.clean(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share; emptied ones go."""
    return line_dedup.drop_emptied(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in windows of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("quality rules", good_quality),
    ("line dedup", without_boilerplate),
    ("SimHash near-dedup", without_copies),
    ("packing", packed),
]

# Classifier scores and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
