"""The queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnweave.llm import sql
from tarnweave.llm.chat import formatted
from tarnweave.llm.curve import CurveParams, pack_along_curve
from tarnweave.llm.embedding_dedup import near_vectors
from tarnweave.llm.hard_negatives import hard_negatives
from tarnweave.llm.html_extract import extract
from tarnweave.llm.line_dedup import remove_repeated_chunks
from tarnweave.llm.minhash import MinHashParams, near_duplicates
from tarnweave.llm.mixing import mix
from tarnweave.llm.packing import PackParams, pack
from tarnweave.llm.phrases import collocations
from tarnweave.llm.pii import replace_pii
from tarnweave.llm.quality_rules import quality_rules
from tarnweave.llm.sharding import shard
from tarnweave.session import read_table

TOKENIZER = "word_bpe_49k.json"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_chunks(docs)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), PackParams(public_tokenizers.path(TOKENIZER)))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = MinHashParams(width=3, percent=85, bands=24, rows=5)
    return near_duplicates(read_table(spark, sf_dir, "documents"), params)


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(read_table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select(mixed["mix_id"].alias("doc_id"), "size", "source_size", "target", "taken")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read_table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    fixed = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return formatted(rows.union(fixed))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_along_curve(read_table(spark, sf_dir, "documents"), CurveParams(public_tokenizers.path(TOKENIZER)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), label=shifted)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_quality_rules, op2_line_dedup, op3_best_fit_packing, op4_embedding_near_dedup, op5_minhash_near_dedup,
        op6_pii_surrogates, op7_source_mixing, op8_sharding, op9_chat_formatting, op10_html_extraction,
        op11_curve_packing, op12_hard_negatives, op13_phrase_collocations,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_embedding_near_dedup": sql.NEAR_VECTORS,
        "op5_minhash_near_dedup": sql.NEAR_DUPLICATES,
        "op7_source_mixing": sql.MIX,
        "op9_chat_formatting": sql.FORMATTED,
        "op12_hard_negatives": sql.HARD_NEGATIVES,
        "op13_phrase_collocations": sql.COLLOCATIONS,
    }
