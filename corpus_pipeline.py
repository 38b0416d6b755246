"""Cleaning of a document collection: each stage takes documents and returns documents.

run(spark, sf_dir) applies the stages in order to the documents table; each stage's rows are written and read again
before the next one starts, so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine doesn't reject; it learns from the labels that aren't held out."""
    from lociweave.llm import quality as machine

    model = machine.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return machine.score(docs, model, keep=tuple(docs.columns), name="_machine_score").where("_machine_score >= 0.5").select(docs.columns)


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a number that tells their rows apart by id and text, whether null or repeated."""
    return docs.withColumn("_row_key", F.xxhash64(F.col("doc_id"), F.col("doc_id").isNull(), F.col("text"), F.col("text").isNull()))


def _by_key(keyed: DataFrame) -> DataFrame:
    """The texts under their number in place of the id."""
    return keyed.select(F.col("_row_key").alias("doc_id"), "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id, null last. Rows are told apart by id and text; of equal ones, one stays."""
    from lociweave.llm import minmax
    from lociweave.operators.membership import split_by
    from lociweave.session import cut_lineage

    keyed = _keyed(docs)
    groups = minmax.near_duplicates(_by_key(keyed), width=5, percent=80).select(F.col("doc_id").alias("_row_key"), "component_id").distinct()
    rows = keyed.groupBy("_row_key").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    placed = cut_lineage(rows.join(groups, "_row_key").withColumn("place", F.struct(F.col("id").isNull(), "id", "_row_key")))
    first = placed.groupBy("component_id").agg(F.min("place").alias("first"))
    others = cut_lineage(placed.join(first, "component_id").where("place != first").select("_row_key"))
    repeated = placed.where("n > 1").select("_row_key")
    near, far = split_by(keyed, others.unionByName(repeated), "_row_key")  # rows that surely stay as they are aren't moved
    left = near.join(others, "_row_key", "left_anti")
    once = left.join(repeated, "_row_key", "left_anti")
    return far.unionByName(once).unionByName(left.join(repeated, "_row_key", "left_semi").dropDuplicates(["_row_key"])).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; rows are told apart by id and text."""
    from lociweave.llm import decontaminate
    from lociweave.operators.membership import split_by
    from lociweave.session import cut_lineage

    keyed = _keyed(docs)
    found = cut_lineage(decontaminate.contaminated(_by_key(keyed), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
                        .select(F.col("doc_id").alias("_row_key")).distinct())
    near, far = split_by(keyed, found, "_row_key")
    return far.unionByName(near.join(found, "_row_key", "left_anti")).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a mark in place of each span of personal data; n_chars follows the text."""
    from lociweave.llm import pii

    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    found = pii.find(docs.select("text", F.struct(*others).alias("_row")), pii.train(docs), keep=("_row",), masked=True)
    return found.select("_row.*", F.col("masked").alias("text"), F.length("masked").cast("long").alias("n_chars")).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, with the digest of what they decode to."""
    import public_tokenizers

    from lociweave.llm import bpe

    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))
    return coded.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Trained models and alignment scores aren't expressible in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def _shared(spark: SparkSession) -> str:
    """A new folder for one run, in the one that the cluster shares."""
    from lociweave.session import cut_lineage

    cut_lineage(spark.range(0))  # names a folder where the session has none
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = _shared(spark)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
