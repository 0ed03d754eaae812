"""Corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept,
and is written as Parquet before the next one reads it. All but the last return the
columns of documents. For near-dedup a document is its id and text: repeated rows are one,
rows with one id (or none) and different texts are several, of which a group keeps the one with the
smallest id (a null id last), then the smallest text hash. Null and empty texts pass all stages unless
a classifier rejects them. An empty table stays one; without labels of both kinds a classifier rejects nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclimate.llm.common import small_side, stored, table
from gridclimate.llm.decontaminate import SMALL_ROWS, contamination
from gridclimate.llm.linear import scores
from gridclimate.llm.near_dedup import near_duplicates
from gridclimate.llm.packing import pack
from gridclimate.llm.quality_model import cells_of as word_cells_of
from gridclimate.llm.quality_model import quality_model
from gridclimate.llm.toxicity import cells_of as char_cells_of
from gridclimate.llm.toxicity import toxicity_model

#: Words of a shingle of the near-dedup stage.
SHINGLE = 5
VERDICT = "__verdict"
#: Bytes of words whose token ids a worker remembers: few, since its executor holds memory of the stages before.
KEPT_BYTES = 24 << 20


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return scores(docs, model, char_cells_of, docs.columns, VERDICT).where(F.col(VERDICT) < 0.5).drop(VERDICT)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; all, if there are no labels to learn from."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    if not model[1].any():
        return docs
    return scores(docs, model, word_cells_of, docs.columns, VERDICT).where(F.col(VERDICT) >= 0.5).drop(VERDICT)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, once."""
    # equal rows share a key, all others have one of their own
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    judged = near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text"), SHINGLE)
    members = stored(judged.select(F.col("doc_id").alias("__key"), F.col("component_id").alias("__group")).distinct(), "members")
    several = members.groupBy("__group").agg(F.count("*").alias("__n")).where("__n > 1").select("__group")
    grouped = stored(members.join(several, "__group"), "grouped")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"))
    named = keyed.select("__key", order.alias("__order")).join(grouped, "__key")
    stays = named.groupBy("__group").agg(F.min_by("__key", "__order").alias("__key"))
    gone = stored(grouped.select("__key").join(stays.select("__key"), "__key", "left_anti").select(F.col("__key").alias("__gone")), "gone")
    left = keyed.join(small_side(gone, SMALL_ROWS), F.col("__key") == F.col("__gone"), "left_anti")
    again = stored(keyed.groupBy("__key").count().where("count > 1").select(F.col("__key").alias("__again")), "again")
    if not again.head(1):
        return left.drop("__key")
    again = small_side(again, SMALL_ROWS)
    repeated = left.join(again, F.col("__key") == F.col("__again"), "left_semi").dropDuplicates(["__key"])
    return left.join(again, F.col("__key") == F.col("__again"), "left_anti").unionByName(repeated).drop("__key")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that passages of the benchmark do not contaminate."""
    judged = contamination(docs, table(spark, sf_dir, "benchmark"))
    gone = stored(judged.where("contaminated").select(F.col("row_hash").alias("__hash")).distinct(), "contaminated")
    return docs.join(small_side(gone, SMALL_ROWS), F.xxhash64("doc_id", "text") == F.col("__hash"), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with token ids, in sequences of up to 2048 tokens."""
    return pack(docs, kept=KEPT_BYTES)


STAGES = [
    ("toxicity", without_toxic),
    ("quality classifier", of_quality),
    ("near-dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: The classifiers, the curve and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
