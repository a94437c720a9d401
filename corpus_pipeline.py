"""A training corpus from ``documents``: toxicity, near-duplicates, secrets, mix, packing.

Each stage is one call of an operator; it takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's input.  All but
the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import mixing, packing, secrets, simhash, toxicity
from tidelake.llm.common import discard, shared_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these documents' labels, calls toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, name="_score").where(F.col("_score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the least doc_id: SimHash groups and MinHash bands name candidates, the sets of shingles decide."""
    return simhash.dedup(docs).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return secrets.redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, range-sorted by training position; where a source's target falls, in part."""
    return mixing.stream(mixing.mix(docs)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces with their places in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express the classifier, the fingerprints and the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    before = None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = f"{shared_dir(spark)}/tables/pipeline-{name}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before is not None:
                discard(before)
            before = docs
    return docs
