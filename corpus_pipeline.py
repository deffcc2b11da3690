"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, documents with
benchmark passages go, personal data becomes pseudonyms, and texts become token ids.

Every stage reads what the one before has written and works on all of it. A run that is given the folder of one that
died goes on after the last stage that was written whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickspark.llm import bpe, decontamination, ngram_join, pii, toxicity
from pickspark.llm.common import exists, remove, shared_dir, ship_package, table, text_or_empty
from pickspark.llm.queries import BYTE_BPE, PII_KEY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.judged(docs, table(spark, sf_dir, "labels")).where(~F.col("is_toxic")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, Jaccard similarity 0.8 or more; the smallest id of a group stays."""
    ship_package(spark)
    return ngram_join.one_of_each(docs, words=5, num=80, den=100).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str, key: bytes = PII_KEY) -> DataFrame:
    """Whoever has the key can undo the pseudonyms: a deployment passes its own to ``run``."""
    ship_package(spark)
    return pii.pseudonymise(docs, key).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, their digest and that of the decoded text, which equals the digest of the text."""
    ship_package(spark)
    trip = bpe.round_trip(docs.select("doc_id", text_or_empty().alias("text")), BYTE_BPE)
    return trip.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("bpe", encode),
]

#: Learned models and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None, key: bytes = PII_KEY) -> DataFrame:
    """All stages over ``documents``, each written to ``folder`` (by default a new one in the shared folder) and read
    again; what a stage has used up is deleted. Stages that the folder has whole are not run again."""
    docs = table(spark, sf_dir, "documents")
    root = folder or f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    paths = [f"{root}/{name}" for name, _ in STAGES]
    done = max((i for i, path in enumerate(paths) if exists(spark, f"{path}/_SUCCESS")), default=-1)
    if done >= 0:
        docs = spark.read.parquet(paths[done])
    for i, (_, stage) in enumerate(STAGES):
        if i <= done:
            continue
        out = stage(spark, docs, sf_dir, key) if stage is hide_personal_data else stage(spark, docs, sf_dir)
        out.write.mode("overwrite").option("compression", "zstd").parquet(paths[i])
        docs = spark.read.schema(out.schema).parquet(paths[i])
        if i:
            remove(spark, paths[i - 1])
    return docs
