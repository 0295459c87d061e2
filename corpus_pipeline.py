"""A training corpus from documents: toxic texts out, near-duplicates out, secrets masked, sources mixed, packed.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as
the next one's documents. All but the last keep the columns of documents.

* toxicity: rows whose text scores 0.3 or more go; the model reads labelled rows of the stage.
* near_duplicates: of each class the row with the smallest doc_id stays; texts without words stay.
* secrets: secret parts of texts are masked; no row goes.
* mixing: each row is repeated as often as the mix takes it; texts without words are not taken.
* packing: pieces of the documents in sequences of 1024 ids.

Null texts count as empty; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, neardup, packing, secrets, toxicity
from tidemark.llm.common import durable, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_copies), ("secrets", mask_secrets),
          ("mixing", mix_sources), ("packing", pack_sequences)]
#: SQL can express neither the classifier nor the signatures; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the table of documents."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
