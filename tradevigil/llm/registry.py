"""Queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradevigil.llm import centroids, divergence, langid, licences, maintext, mixing, ordermin, personal, simhash, tokenfile, toxicity, warc, winnow
from tradevigil.llm.store import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def vocabulary() -> str:
    """Path of the public vocabulary that `op8_token_files` uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query
def op1_order_minhash(spark, sf_dir):
    return ordermin.report(table(spark, sf_dir, "documents"))


@_query
def op2_warc_reassembly(spark, sf_dir):
    return warc.report(table(spark, sf_dir, "pages"))


@_query
def op3_decontamination(spark, sf_dir):
    return winnow.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op4_license_scan(spark, sf_dir):
    return licences.report(table(spark, sf_dir, "documents"))


@_query
def op5_toxicity(spark, sf_dir):
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op6_language_id(spark, sf_dir):
    return langid.report(table(spark, sf_dir, "documents"))


@_query
def op7_main_text(spark, sf_dir):
    return maintext.report(table(spark, sf_dir, "pages"))


@_query
def op8_token_files(spark, sf_dir):
    return tokenfile.report(table(spark, sf_dir, "documents"), vocabulary())


@_query
def op9_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op10_source_mixing(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


@_query
def op11_centroid_clustering(spark, sf_dir):
    return centroids.report(table(spark, sf_dir, "embeddings"))


@_query
def op12_personal_data(spark, sf_dir):
    return personal.report(table(spark, sf_dir, "documents"))


@_query
def op13_source_divergence(spark, sf_dir):
    return divergence.report(table(spark, sf_dir, "documents"))


ORACLE_SQL = {
    "op2_warc_reassembly": warc.REPORT_SQL,
    "op3_decontamination": winnow.REPORT_SQL,
    "op10_source_mixing": mixing.REPORT_SQL,
    "op11_centroid_clustering": centroids.REPORT_SQL,
    "op13_source_divergence": divergence.REPORT_SQL,
}
