"""A corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnweave.llm import line_dedup, minhash, mixing, packing, quality_rules
from tarnweave.llm.text import WORD
from tarnweave.session import read_table, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "word_bpe_49k.json"


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go.

    Null, empty and short texts fail the base rules and go; equal rows stay or go together. Other
    columns than those of documents go; without rows or labels the stage gives what is left."""
    judged = quality_rules.quality_rules(
        docs, read_table(spark, sf_dir, "labels"), carry=tuple(c for c in COLUMNS if c != "doc_id")
    )
    return judged.where("kept").select(*COLUMNS)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, and so do documents of which nothing is left.

    Null texts and those of one line stay as they are; equal rows get equal texts, the first of
    equal texts under other ids stays."""
    left = line_dedup.remove_repeated_chunks(docs.select(*COLUMNS))
    return (
        left.where("n_removed_lines = 0 or n_removed_lines < n_lines")
        .withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))
        .select(*COLUMNS)
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id stays (null first).

    Rows are told apart by id and text: an id's other, unrelated texts stay, and of rows equal in
    both one does. Null and blank texts are no duplicates of anything: all of them stay."""
    said = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = docs.where(said).select(*COLUMNS, F.xxhash64("doc_id", "text").alias("key"))
    groups = minhash.near_duplicates(rows, id_col="key").select("key", "component_id")
    firsts = rows.select("key", "doc_id").join(groups, "key").groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    kept = firsts.select(F.col("first.key").alias("key"))
    once = Window.partitionBy("key").orderBy("key")
    first = rows.join(kept.hint("merge"), "key").withColumn("copy", F.row_number().over(once)).where("copy = 1")
    return first.select(*COLUMNS).unionByName(docs.where(~said).select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; texts without a word are never taken."""
    return mixing.repeat(docs, mixing.mix(docs)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, repeated rows each their own: its place in a sequence.
    Null and empty texts are one token."""
    return packing.pack(docs, packing.PackParams(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality rules", reject_low_quality),
    ("line dedup", remove_repeated_lines),
    ("minhash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Hashes and greedy combination have no form in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scratch(spark) as keep:  # what a stage stores on its way goes with it
            docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
