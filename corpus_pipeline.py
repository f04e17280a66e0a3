"""From raw documents to packed training sequences; each stage is one operator of `emberline.llm`.

A stage takes what its predecessor kept and returns the columns of documents again; the last one
returns the pieces of the training sequences. What a stage decides shows in its rows: rejected
documents and copies are gone, repeated passages are cut out of texts, and the mix repeats, cuts or
leaves out texts so that sources meet their targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm import mixing, near_dedup, packing, quality_rules, substring_dedup
from emberline.llm.lookup import parted
from emberline.llm.queries import vocabulary
from emberline.llm.tables import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold the base rules and look like the trusted ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.rate(docs, labels, COLUMNS).where("kept").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; a repeated row (same id and text) stays once.

    Only documents that may go are moved; the others stay where they are read."""
    found = stored(near_dedup.near_duplicates(docs).groupBy("doc_id").agg(F.max(~F.col("kept")).alias("__gone"), F.count("*").alias("__rows"))
                   .where("doc_id is not null and (__gone or __rows > 1)").select("doc_id", "__gone"), "gone")
    stay, others = parted(docs.select(*COLUMNS), found)
    judged = others.join(found.hint("shuffle_hash"), "doc_id", "left").where("not coalesce(__gone, false)")
    return stay.unionByName(judged.select(*COLUMNS).dropDuplicates(["doc_id", "text"]))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur again anywhere; a text that has none stays as it is."""
    cut = substring_dedup.remove_repeats(docs, COLUMNS, with_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return (cut.withColumn("text", text)
            .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as the mix takes them."""
    return mixing.apply(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality rules", quality),
    ("near duplicates", one_of_each_group),
    ("substring dedup", without_repeats),
    ("source mixing", mixed),
    ("packing", packed),
]

#: Not expressible: hashed n-gram scores and tokenizer ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's result is written and read again, as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
