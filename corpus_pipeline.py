"""A training corpus from documents: five stages, each one operator of wakeline.llm.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of documents;
each stage's rows are written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import bpe, decontaminate, pii, simhash, toxicity
from wakeline.llm.shared import new_folder, ship_package, table
from wakeline.sources import files

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not call toxic."""
    ship_package(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints (at most two bits)."""
    ship_package(spark)
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    ship_package(spark)
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    ship_package(spark)
    return pii.without_personal_data(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids and the text these decode to."""
    ship_package(spark)
    coded = bpe.encode_and_decode(docs, TOKENIZER)
    return coded.select(
        "row.doc_id", "row.lang", "row.source",
        F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("pii", redact),
    ("bpe", tokenize),
]

#: The classifier, the fingerprints and the tokenizer have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token table of all documents that the stages keep."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last is not None:
            files.remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
