"""The corpus pipeline: language, near copies, benchmark passages, mixture, token files.

Each stage takes what its predecessor kept, as rows of `documents`, and all but the last
return such rows. The last one encodes them in the order in which the mixture left them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradevigil.llm import langid, mixing, simhash, tokenfile, winnow
from tradevigil.llm.registry import vocabulary
from tradevigil.llm.store import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language with some certainty, go."""
    return langid.recognised(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: fingerprints over 4-word shingles, linked at 4 bits or fewer."""
    return simhash.one_per_group(docs, shingle=4, threshold=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return winnow.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to their source's rate, and all are shuffled."""
    return mixing.shuffled(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the input files' rows, and what they give back per row."""
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    part = F.regexp_extract(file, r"part-(\d+)", 1)
    placed = docs.select("doc_id", "text", part.cast("bigint").alias("_part"), file.alias("_file"), row.alias("_row"))
    return tokenfile.report(placed, vocabulary(), order=["_part", "_file", "_row"])


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_files", token_files),
]

#: Language models, XXH64 and the tokenizer have no SQL form; tests use plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
