"""From raw documents to packed training sequences, as five stages.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` has the columns of
``documents``, and returns a frame that is stored and read again as the next
one's ``docs``. All but the last keep the columns. Null texts, null keys, empty
tables and repeated rows go as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import hyperminhash, langmodel, mixing, packing, toxicity
from tidemark.plans.catalog import query
from tidemark.session import written

#: SQL cannot express the two models; tests compare the stages with brute force.
ORACLE_SQL = None
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _remainder() -> Column:
    """0 for the documents that are held out of every training."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half; the model learns from the labels of the rows not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(_remainder() != 0)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.filter("score < 0.5").select("row.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is one of those labelled; the models learn from rows not held out."""
    model = langmodel.train(docs.filter(_remainder() != 0))
    return langmodel.identify(docs, model).filter("not rejected").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id.

    Of several rows with that id the one of the smallest text digest stays, so
    reruns agree. Rows without an id have no group; of those with equal texts one
    stays.
    """
    found = written(hyperminhash.near_duplicates(docs.filter("doc_id is not null")).filter("kept").select("doc_id"))
    # The ids grow with the documents, so they are never broadcast.
    kept = docs.join(found.distinct().hint("merge"), "doc_id", "left_semi").select(docs.columns)
    if not found.groupBy("doc_id").count().filter("count > 1").isEmpty():
        kept = _first_rows(kept, ["doc_id"])
    nameless = docs.filter("doc_id is null")
    return kept if nameless.isEmpty() else kept.unionByName(_first_rows(nameless, ["text"]))


def _first_rows(docs: DataFrame, keys: list[str]) -> DataFrame:
    """For each key the row of the smallest digest of its text, and of all its columns where texts are equal."""
    order = [F.sha2(F.col(c).cast("string").cast("binary"), 256) for c in ["text", *docs.columns]]
    rows = docs.withColumn("_row", F.struct(F.array(*order).alias("_digests"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_kept")))
    first = rows.groupBy(*keys).agg(F.min_by("_row._kept", "_row._digests").alias("_kept"))
    return first.select("_kept.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixing.mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
