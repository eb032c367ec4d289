"""A corpus pipeline: quality rules, near duplicates, secrets, mixing to target weights, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes each stage's result as Parquet below the
shared folder and reads it again as the next stage's documents, so that a lost executor costs one stage's work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import snapwatch
from snapwatch.llm import mixing, packing, quality, secret_scan, simhash
from snapwatch.llm.tables import read
from snapwatch.session import work_dir

# Tasks carry the code they need, so that executors do not have to have the package installed.
cloudpickle.register_pickle_by_value(snapwatch)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a quality rule go.

    NULL and empty texts have no words, so they go too; repeated rows are judged alike; no rows give no rows.
    """
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Texts without words are one group. Rows without doc_id can't be named and stay; of the rows of one doc_id the first by
    its values stays. No rows give no rows.
    """
    return simhash.keep_one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark and ``n_chars`` is counted anew; all documents stay.

    NULL texts stay NULL; repeated rows are changed alike; no rows give no rows.
    """
    return secret_scan.redact_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: some documents go, some come twice.

    A NULL source is a source of its own. Documents without words are taken by no mix and go. Of repeated rows as many are
    taken as the target needs. No rows give no rows.
    """
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of packed sequences, with their token ids.

    NULL and empty texts have the end mark alone; repeated rows are packed each; a NULL doc_id stays NULL; no rows give no
    rows.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixture),
    ("packing", sequences),
]

# Fingerprints, tokens and the fitted mix can't be expressed in SQL; tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows. Columns beside those of documents pass all stages but the last."""
    docs, folder = read(spark, sf_dir, "documents"), work_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
