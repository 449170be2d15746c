"""Corpus preparation: stages applied to ``documents`` one after another.

Every stage gets what its predecessor kept, as a table that was written and
read again, and all but the last return the columns of ``documents``:

1. toxicity: rows that the classifier flags, by their language's threshold, go;
2. SimHash near-duplicates: one document of each group stays;
3. benchmark decontamination: contaminated documents go;
4. secret scans: every secret is masked in the text, no document goes;
5. packing: documents in training sequences, one row per piece.

Nulls, empty and very long texts, repeated rows, empty tables and further
columns are treated as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, packing, secret_scan, simhash, toxicity
from strata.llm.common import keep
from strata.llm.queries import source_owner, vocabulary
from strata.session import ensure_defaults


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), cut=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, size=3, distance=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, *source_owner())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

# The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_defaults(spark)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = keep(stage(spark, rows, sf_dir), name)
    return rows
