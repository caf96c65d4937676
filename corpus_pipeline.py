"""From raw documents to token ids: five stages, each a table of the one before.

Every stage reads all rows its predecessor kept and returns the columns of documents,
the last one its ids. ``run`` writes each stage's table to the shared folder, so a lost
executor never costs more than the stage it is in.

Defined results: null and empty texts pass every stage (a null one stays null up to the
last, which gives it no ids); repeated rows are one near-duplicate group, so one of them
stays; rows without an id are told apart by their texts; an empty table gives empty tables;
columns of ``documents`` beside its own are kept through all stages but the last, whatever
their names. Texts are never cut, so memory grows with the longest one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spintally.llm import bpe, decontaminate, pii, simhash, toxicity
from spintally.session import run_dir

RANKS = "byte_bpe_multi_50k.tiktoken"


def packed(docs: DataFrame) -> DataFrame:
    """``text``, and all other columns in one, so that no name clashes with an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("text", F.struct(*others).alias("others"))


def unpacked(made: DataFrame, names: list[str]) -> DataFrame:
    return made.select(*[F.col(c if c == "text" else f"others.`{c}`") for c in names])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(packed(docs), model, keep=("text", "others"))
    return unpacked(scored.filter(~F.col("rejected")), docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    return simhash.deduplicated(docs, shingle=4, max_bits=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminated(docs, benchmark)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and ``n_chars`` adjusted."""
    clean = pii.redact(packed(docs), pii.fit(docs), keep=("others",))
    return unpacked(clean, docs.columns).withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked against the bytes they decode to."""
    path = public_tokenizers.path(RANKS)
    keep = ("doc_id", "lang", "source", "text")
    ids = bpe.encode(docs, path, public_tokenizers.PATTERN, keep=keep)
    back = bpe.decode(ids, path, keep=(*keep, "n_tokens", "ids"))
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return back.select("doc_id", "lang", "source", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("byte_bpe", encoded),
]

#: SQL cannot express the models; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = run_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{target}/{name}")
        docs = spark.read.parquet(f"{target}/{name}")
    return docs
