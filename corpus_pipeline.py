"""The corpus pipeline: toxic documents out, near copies out, personal data masked, sources mixed, packed.

Every stage takes all rows its predecessor kept and is written before the next reads it. Stages take tables with
null keys and texts, repeated rows, no rows, and further columns; all but the last return the columns they got.
"""

from __future__ import annotations

import public_tokenizers as TOKENIZERS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import packing, private, queries, shingle_join, toxicity
from sheaf.llm.common import col
from sheaf.session import settle, shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.3, by a model of the labelled ones that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, held_out=queries.held_out)
    scored = toxicity.score(docs, model, name="_toxicity")
    return scored.where("_toxicity < 0.3").select(*[col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, five words and 0.8, the row of least key, nulls last.

    Rows are linked by a number of their own that is written with them once, not by their keys: rows that share a key
    or have none are compared as any others, and only copies go. A row without words is a copy of nothing.
    """
    row = "_row" + "_" * max(map(len, docs.columns))
    numbered = settle(docs.withColumn(row, F.monotonically_increasing_id()))
    linked = shingle_join.shingle_links(numbered, key=row, width=5, num=80, den=100)
    copies = settle(linked.where(F.col("component_id") != F.col(row)).select(row, F.col("component_id").alias("_group")))
    members = copies.union(copies.select(F.col("_group").alias(row), "_group").distinct())
    keyed = settle(numbered.select(row, "doc_id").join(shingle_join.of_small(settle(members)), row))
    least = keyed.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).alias("least"))
    gone = settle(keyed.join(least, "_group").where(F.col(row) != F.col("least")[row]).select(row))
    return numbered.join(shingle_join.of_small(gone), row, "left_anti").select(*[col(c) for c in docs.columns])


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts replaced by the name of its kind; ``n_chars`` is counted anew where a text changed."""
    masked = private.find_private(docs, redacted="text", spans="_spans")
    changed = F.size("_spans") > 0
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(*[col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics have their target weights."""
    return queries.mixed(docs).select(*[col(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    packed = packing.pack_documents(docs, TOKENIZERS.path("byte_bpe_50k.json"), TOKENIZERS.PATTERN)
    return queries.piece_digests(packed)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("pii", mask_private),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Training a model and tokenising have no SQL form; the tests compare with a plain version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
