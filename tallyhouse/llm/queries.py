"""The registered text queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import (
    bpe, bytespans, centroids, decontaminate, fingerprint, hard_negatives, lattice_lm, ngram_join, passages, pii, token_counts, toxicity,
    warc)
from tallyhouse.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(name: str):
    def keep(function):
        QUERIES[name] = function
        return function
    return keep


# The piece vocabulary of op7 and op11.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# The rank file of op8; the operators take its path and pattern as parameters.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@_query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op2_ngram_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(table(spark, sf_dir, "documents"))


@_query("op3_passages")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(table(spark, sf_dir, "documents"))


@_query("op4_fingerprint")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


@_query("op5_bytespans")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytespans.report(table(spark, sf_dir, "documents"))


@_query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@_query("op7_lattice_lm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.report(table(spark, sf_dir, "documents"), PIECES)


@_query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


@_query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op10_warc")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


@_query("op11_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents"), PIECES)


@_query("op12_hard_negatives")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.report(table(spark, sf_dir, "embeddings"))


@_query("op13_centroids")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))
