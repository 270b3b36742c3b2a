"""Corpus preparation, stage by stage, over the documents table.

Every stage takes (spark, docs, sf_dir) and returns a table; each result is written once and
read back as the next stage's input. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm import bpe, jaccard, mixing, quality, rules
from shoreline.llm.base import stored, table
from shoreline.session import shared_folder

TOKENIZER = "word_bpe_49k.json"
#: Share of tokens that mixing keeps.
MIXED_SHARE = 0.5


def whole_row(docs: DataFrame) -> list:
    """All columns of a row in one, so that their names meet no others."""
    return [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for good."""
    return quality.classify(docs, table(spark, sf_dir, "labels"), whole_row(docs)).filter("kept").select("_row.*")


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    return rules.judge_quality(docs, whole_row(docs)).filter("kept").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group: the one whose id names it. Rows without id stay.

    Of several rows with the id of a group one stays, the smallest.
    """
    groups = jaccard.linked_groups(docs)
    left = stored(groups.filter("component_id <> doc_id").select("doc_id").distinct(), "copies")
    single = stored(groups.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeats")
    kept = docs.join(left, "doc_id", "left_anti").select(*docs.columns)
    if single.isEmpty():
        return kept
    repeated = kept.join(single, "doc_id", "left_semi").select("doc_id", F.struct(*docs.columns).alias("_row"))
    first = repeated.groupBy("doc_id").agg(F.min("_row").alias("_row")).select("_row.*").select(*docs.columns)
    return kept.join(single, "doc_id", "left_anti").select(*docs.columns).unionByName(first)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics meet their target weights."""
    return mixing.mix(docs, whole_row(docs), keep=MIXED_SHARE).filter("_mix_selected").select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the remaining documents."""
    return bpe.encode_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality classifier", classify), ("quality rules", apply_rules), ("n-gram Jaccard join", drop_near_copies),
          ("source mixing", mix_sources), ("BPE encoding", encode)]

#: Model fits and sampled documents have no SQL form; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written once and read back as the next input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
