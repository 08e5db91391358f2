"""The corpus pipeline: from raw documents to packed sequences.

Each stage calls one operator of ``basketry.llm`` on all that the stage before
kept, and its decisions take effect: low-quality documents go, one document of
each group of near copies stays, contaminated documents go, live-looking
secrets are masked, and what is left is packed.  All stages but the last return
the columns of ``documents``.

Nulls and empty texts: a text without words is scored like any other, links with
nothing, is never contaminated, holds no secret, and is packed as its end token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import common, decontaminate, ngram_join, packing, quality_mil, secret_scan
from basketry.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier scores 0.5 or more."""
    labels = common.read_table(spark, sf_dir, "labels")
    net = quality_mil.learn(docs, labels.filter(common.id_crc(F.col("doc_id"), 3) != 1))
    return quality_mil.keep_good(docs, net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the shingle join (4 words, Jaccard 0.85)."""
    return ngram_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the benchmark's windows cover less than a twentieth."""
    return decontaminate.drop_contaminated(docs, common.read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets masked."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminated),
          ("secrets", secrets), ("packing", packed)]

#: The stages train a model, find components and pack, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of each are materialised for the next."""
    docs = common.read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
