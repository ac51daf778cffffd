"""From raw documents to token ids: rules, near-duplicates, secrets, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the
last return the columns of ``documents``. Nulls, empty texts and repeated rows are handled as
the operators state it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, mixing, quality_rules, secret_scan, simhash
from tidemark.llm.queries import tokenizer_path
from tidemark.session import stage


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, where there is one, as the text has it now."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars"))
    return docs.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go, and frequent lines of the host from the others' texts."""
    return _counted(quality_rules.cleaned(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: fingerprints within 3 bits, then five-word similarity of 0.8 or more."""
    return simhash.one_of_each_group(docs, similarity=0.8)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; no document goes, ``n_chars`` follows the text."""
    return _counted(secret_scan.redacted(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mix of equal source weights."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, its slot in the mix, and digests of the ids and of the text decoded from them.

    A table on disk has no order, so the slot says it: training reads the documents by ``slot``. It is a function of
    ids and sources, the same as in the stage before. Rows that share an id share its first slot; those without have none.
    """
    path = tokenizer_path("byte_bpe_50k.json")
    digests = bpe.token_digest(bpe.decode(bpe.encode(docs, path), path), "ids")
    slots = mixing.mixture(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("slot").alias("slot"))
    return digests.join(slots.hint("merge"), "doc_id", "left")


STAGES = [
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mix),
    ("tokens", tokens),
]

#: XXH64 fingerprints and BPE merges are beyond SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, apply) in enumerate(STAGES):
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
