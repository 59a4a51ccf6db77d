"""A corpus pipeline of five stages: language ID, line dedup, near-dedup, decontamination, mixing.

All stages take tables with nulls in any column, repeated rows, and no rows (then they give none); rows that repeat are documents of
their own, and columns beyond those of documents stay. Their order is fixed, so near-dedup sees what line dedup has left: copies whose
lines are all gone are no longer there to be found.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curaspark.llm import common, decontaminate, langid, lines, minhash, mixing

#: Scratch tables of the stage that ran last.
_last: list[str] = []


def _stage(f: Callable[[DataFrame, SparkSession, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage's output is written before the next stage begins, which may therefore discard the scratch tables behind it."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.prepare(spark)
        common.discard(spark, [p for p in _last if p in common.written()])
        before = set(common.written())
        out = f(docs, spark, sf_dir)
        _last[:] = [p for p in common.written() if p not in before]
        return out

    run_stage.__name__, run_stage.__doc__ = f.__name__, f.__doc__
    return run_stage


@_stage
def known_language(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts, empty ones, those without a letter and those of a low score go. Of equal texts all
    stay or all go. Where no row that trains has a lang, every text with a letter stays."""
    return langid.keep_known(docs)


@_stage
def unrepeated_lines(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line equals or nearly equals, by doc_id (null first); n_chars is counted anew. Null and empty
    texts stay; of repeated rows the first keeps its lines, and a document that loses lines and has no words left goes."""
    return lines.deduplicate(docs)


@_stage
def one_of_each_group(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id (null is largest), of equal ones the first row. Texts without
    words (null, empty) are alone and stay."""
    return minhash.deduplicate(docs)


@_stage
def without_benchmark(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark; n_chars is counted anew where one was cut. Null and empty texts stay, an empty
    benchmark cuts nothing, and a document that is cut and has no words left goes."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def mixed_sources(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of sources by weight, a row for each copy taken, with its number from 0 (copy). Null sources are one source; texts without
    words are taken as often as their place in the mix says, and count nothing."""
    return mixing.mix(docs)


STAGES = [
    ("language ID", known_language),
    ("line dedup", unrepeated_lines),
    ("near-dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("source mix", mixed_sources),
]

#: Training a network and signatures have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir, each stage's output written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.materialize(docs)
    return docs
