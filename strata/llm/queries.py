"""The registered queries of this subpackage and, where SQL can express one,
its DuckDB SQL. Each applies its operator to the whole of its tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (alignment, decontaminate, embedding_dedup, lexical, licenses, ngram_lm,
                        packing, secret_scan, simhash, token_counts, toxicity, url_filter, warc)
from strata.llm.common import shared_path
from strata.llm.oracle import ORACLE_SQL  # noqa: F401 (read by the driver's entry)
from strata.session import ensure_defaults

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

# The rules of the registered URL query, (verdict, host/path).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ensure_defaults(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


def source_owner() -> tuple[Column, Column]:
    """Owner and repository of a document: its source, and the source's part
    in one language."""
    return F.col("source"), F.concat("source", F.lit("/"), "lang")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(_read(spark, sf_dir, "documents"),
                                         _read(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.95)
    return near.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), vocabulary())


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    path = shared_path(spark, "warc")
    manifest = warc.write(pages, path)
    return warc.read(manifest, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"),
                                    cut=0.7)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_read(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), vocabulary())


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_read(spark, sf_dir, "documents"), *source_owner())
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.OWNED.name)

    def of(kind: secret_scan.Kind) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind.name)).cast("long")

    def shown(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counts(name: str) -> Column:  # of each span's value, in the order of the spans
        return F.array_join(F.transform("spans", lambda s: s[name].cast("string")), ",")

    return found.select(
        "doc_id", of(secret_scan.ASSIGN).alias("n_assign"), of(secret_scan.ACCESS).alias("n_access"),
        of(secret_scan.HEX).alias("n_hex"), F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"),
        shown("spans").alias("spans"), counts("n_owners").alias("owners"),
        counts("n_repositories").alias("repositories"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_read(spark, sf_dir, "documents"), size=3, distance=2)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_read(spark, sf_dir, "documents"), vocabulary(), public_tokenizers.path(PIECES))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.held_out_scores(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_url_filter": op6_url_filter,
    "op7_license_scan": op7_license_scan,
    "op8_packing": op8_packing,
    "op9_secret_scan": op9_secret_scan,
    "op10_simhash": op10_simhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_language_model": op13_language_model,
}
