"""Training-data pipeline over ``documents``: each stage applies one operator of ``tidemark.llm``.

Stages take (spark, docs, sf_dir) and return a DataFrame that is written as
Parquet and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ship_package, staged, table
from tidemark.llm.decontaminate import clean_documents
from tidemark.llm.lang_id import fit, known_language
from tidemark.llm.near_dedup import near_dedup
from tidemark.llm.packing import pack_documents
from tidemark.llm.suffix_dedup import suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells; texts without letters, empty and null
    texts go.  A corpus without labelled text stays as it is.  Rows with repeated or null
    ids are judged by their own texts; no rows give no rows."""
    ship_package(spark)
    return known_language(docs, fit(docs), *COLUMNS[1:]).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (five-word shingles, similarity 0.8): the least id.

    Rows are told apart by a key of their own, so of repeated rows one stays, and rows
    that share an id are judged by their own texts.  Rows without an id all stay.
    """
    ship_package(spark)
    rows = staged(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    known = rows.filter("doc_id IS NOT NULL")
    groups = near_dedup(known.select(F.col("row").alias("doc_id"), "text"), 5, 80)
    groups = groups.select(F.col("doc_id").alias("row"), "component_id")
    first = (known.select("row", "doc_id").join(groups, "row").groupBy("component_id")
             .agg(F.min(F.struct("doc_id", "row")).alias("first")).select("first.row"))
    first = staged(first, "first-of-groups", release=True)
    kept = known.join(first, "row", "left_semi").unionByName(rows.filter("doc_id IS NULL"))
    return kept.select(*COLUMNS)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that occur elsewhere; documents
    of which nothing is left go."""
    ship_package(spark)
    out = suffix_dedup(docs, 200, "lang", "source")
    out = out.filter("n_bytes = 0 OR kept_text <> ''")
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                      F.length("kept_text").cast("long").alias("n_chars"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``, not with other values either.  Null and
    empty texts and an empty benchmark leak nothing; no rows give no rows."""
    ship_package(spark)
    return clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their places in sequences of 1,024 tokens.  Null and
    empty texts are a piece with the end id alone; no rows give no rows."""
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", remove_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: The stages' models, signatures and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name, release=True)
    return docs
