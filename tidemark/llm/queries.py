"""Registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.alignment import op13
from tidemark.llm.collocations import op12
from tidemark.llm.common import ship_package, table
from tidemark.llm.decontaminate import op6
from tidemark.llm.fingerprints import op3
from tidemark.llm.lang_id import op1
from tidemark.llm.licenses import op7
from tidemark.llm.near_dedup import op4
from tidemark.llm.packing import op2
from tidemark.llm.quality import op5
from tidemark.llm.sharding import op10
from tidemark.llm.substring_dedup import op8
from tidemark.llm.suffix_dedup import op9
from tidemark.llm.token_files import op11


def _on_documents(fn: Callable[[SparkSession, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, table(spark, sf_dir, "documents"))

    run.__doc__ = fn.__doc__
    return run


def _on_tables(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": _on_documents(op1),
    "op2_best_fit_packing": _on_documents(op2),
    "op3_fingerprints": _on_documents(op3),
    "op4_near_dedup": _on_documents(op4),
    "op5_quality": _on_tables(op5),
    "op6_decontamination": _on_tables(op6),
    "op7_license_scan": _on_documents(op7),
    "op8_substring_dedup": _on_documents(op8),
    "op9_suffix_dedup": _on_documents(op9),
    "op10_sharding": _on_documents(op10),
    "op11_token_files": _on_documents(op11),
    "op12_collocations": _on_documents(op12),
    "op13_token_alignment": _on_documents(op13),
}
