"""Corpus pipeline: from documents to packed sequences.

Each stage takes all that the one before kept and applies one operator; its output is written
as Parquet and read again by the next.  All stages but the last return the columns of
``documents``.  Fitted parts (bucket weights, toxicity model) are fitted on the stage's own input.

Defined cases: null, empty and blank texts fail the quality rules' word count, so they go in the first stage;
repeated rows are near-duplicates, of which one stays; an empty table passes every stage and gives no
pieces; columns beside ``doc_id`` and ``text`` pass all stages but the last as they are (``n_chars``
follows a shortened text).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelcraft.llm import line_dedup, quality_llr, simhash_grid, slack_packing, toxicity_channel
from panelcraft.llm.common import documents, labels
from panelcraft.session import dropped, written

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    trusted = quality_llr.trusted_sample(labels(spark, sf_dir))
    return quality_llr.keep(docs, quality_llr.bucket_weights(docs, trusted))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    return toxicity_channel.keep(docs, toxicity_channel.train(docs, labels(spark, sf_dir)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash_grid.keep_one(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    return line_dedup.strip(docs, whole_lines=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return slack_packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("best-fit packing", packing),
]

#: hashed weights, a fitted model and a tokenizer are not SQL: tests hold the rows against plain Python
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        if last is not None:
            dropped(last)                   # its successor is written
        last = docs
    return docs
