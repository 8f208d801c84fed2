"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsight.llm.alignment import align
from tripsight.llm.common import held_out_remainder, read_table
from tripsight.llm.curriculum import curriculum
from tripsight.llm.decontamination import contamination
from tripsight.llm.exact_dedup import exact_dedup
from tripsight.llm.hard_negatives import mine
from tripsight.llm.html_extract import extract_pages
from tripsight.llm.licenses import scan_licenses, train_licenses
from tripsight.llm.minhash import near_dedup
from tripsight.llm.packing import pack, piece_digests
from tripsight.llm.quality import score_quality, train_quality
from tripsight.llm.substring_dedup import substring_dedup
from tripsight.llm.token_counts import count_tokens
from tripsight.llm.toxicity import score_toxicity, train_toxicity


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs, train_licenses(docs))


def op2_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
            .withColumn("over_limit", F.col("n_tokens") > 512))


def op4_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.col("kept_sha").alias("kept_sha256"))


def op5_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = train_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, lexicon, ["doc_id"]).select(
        "doc_id", F.coalesce(held_out_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("_toxicity").alias("score"), (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"),
        F.col("_toxic_words").alias("toxic_words"))


def op6_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(held_out_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("_quality_score").alias("score"), (F.col("_quality_score") >= 0.7).cast("int").alias("predicted"))


def op7_patricia_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_smith_waterman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                         read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op9_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return piece_digests(pack(docs, public_tokenizers.path("word_bpe_49k.json")))


def op10_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = curriculum(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mix.select("doc_id", "size", "source_size", "target", "taken",
                      F.get("positions", F.lit(0)).alias("first_position"))


def op12_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model")).drop("groups")


def op13_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"),
                                                          F.col("embedding").alias("vec"))
    return mine(rows, F.col("id") % 100 == 0).drop("positive_rank")


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_minhash_bayes, op3_token_counts, op4_phrase_automata, op5_toxicity_lexicon, op6_quality_fm,
    op7_patricia_dedup, op8_smith_waterman, op9_mixture_packing, op10_text_density, op11_curriculum,
    op12_galloping_alignment, op13_tree_negatives)}
