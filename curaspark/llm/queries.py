"""One query for each corpus operator, over whole tables, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, common, decontaminate, embeddings, langid, licenses, lines, minhash, mixing, secrets, warc
from .oracles import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return common.prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mixture(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep_text=False)
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, _table(spark, sf_dir, "benchmark"), keep_text=False)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    items = F.array_sort(F.array_distinct(F.col("hits.item")))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embeddings.near_duplicates(vectors).select("vec_id", "n_links", "component_id", "kept")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # A store of its own for each run, so its ledger is empty at first; a job that runs again and again would keep its store.
    findings = secrets.scan_into(docs, common.scratch_dir(spark))
    rows = secrets.by_path(docs, findings, keep=["doc_id"])
    base = [r.kind for r in secrets.RULES if r.base]

    def joined(f) -> Column:
        return F.array_join(F.transform(f, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *[count(k) for k in base],
        F.sha2(joined(F.filter("findings", lambda x: x["kind"].isin(*base))), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )


def op5_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(_table(spark, sf_dir, "conversations"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed_lines"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs, keep_text=False).select("doc_id", "held_out", "lang_pred", "score")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archive_and_read(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.classes(docs, keep_text=False).select("doc_id", "class_id", "class_size", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_benchmark_decontamination,
        op3_embedding_near_dedup,
        op4_secret_scan,
        op5_chat_perspectives,
        op6_line_dedup,
        op7_language_id,
        op8_license_scan,
        op9_warc_revisits,
        op10_minhash_near_dedup,
    )
}
ORACLES: dict[str, str] = {k: v for k, v in SQL.items() if k in QUERIES}
