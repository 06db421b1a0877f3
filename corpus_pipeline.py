"""Corpus preparation: five stages over the documents table.

Each stage gets what its predecessor kept, as a stored table, and its decisions
take effect: rejected documents go, secrets are replaced.  All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.llm import bpe, decontaminate, near_dups, neighbours, secrets
from velotide.llm.common import prepare, saved
from velotide.llm.queries import table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose labelled neighbours vote against them."""
    prepare(spark)
    model = neighbours.fit(docs, table(spark, sf_dir, "labels"))
    return neighbours.score(docs, model).where("score >= 0.5").select("doc.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    prepare(spark)
    return near_dups.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold an item of the benchmark."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live secrets replaced; n_chars follows the text."""
    prepare(spark)
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their token ids; these replace columns of the same names."""
    prepare(spark)
    rows = bpe.encode(docs, tokenizer_path())
    kept = [F.col("doc")[c].alias(c) for c in docs.columns if c not in ("ids", "n_tokens")]
    return rows.select(*kept, "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("bpe_encoding", tokens),
]

#: The classifier is fitted, which SQL can't say; the tests hold the pipeline
#: against a plain version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole documents table."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
