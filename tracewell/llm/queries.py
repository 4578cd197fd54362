"""Registered queries of the large-scale text operators: thin calls with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import block_search, bpe_trie, contamination, hard_negatives, jaccard_join, license_scan, line_dedup, lm_scoring, mixing, oracles, quality_rules, rans_files, spelling, substring_dedup
from tracewell.llm.common import shared_dir, stage, table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents that every label of theirs calls good and not toxic."""
    marks = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    # By a merge at every size: labels grow with the documents.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").join(marks.hint("merge"), "doc_id", "left")
    return lm_scoring.cross_entropy_difference(docs, F.col("good")).drop("good")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(table(spark, sf_dir, "documents"))


def op5_rans_files(spark: SparkSession, sf_dir: str, tokenizer: str = public_tokenizers.path("byte_bpe_50k.json")) -> DataFrame:
    path = f"{shared_dir(spark)}/tracewell/token-files-{uuid.uuid4().hex}"
    rans_files.write(table(spark, sf_dir, "documents"), path, tokenizer, end_id=0)
    rows = rans_files.read(spark, path)
    sized = rows.select("part", "block", "doc_id", "offset", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return sized.join(rans_files.starts(rans_files.read_index(spark, path)), ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def op6_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    lined = pages.select("page_id", line_dedup.url_host(F.col("url")).alias("host"), line_dedup.html_lines(F.col("html")).alias("lines"))
    done = line_dedup.line_dedup(lined, once=True, small=True)
    return done.select("page_id", "host", F.size("lines").cast("bigint").alias("n_lines"), "n_dropped", F.sha2(F.array_join("kept_lines", "\n"), 256).alias("kept_sha256"))


def op8_bpe_trie(spark: SparkSession, sf_dir: str, tokenizer: str = public_tokenizers.path("word_bpe_49k.json")) -> DataFrame:
    coded = bpe_trie.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer).drop("text")
    done = bpe_trie.decode(coded, tokenizer)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return done.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = stage(quality_rules.metrics(docs).drop("text"), "metrics")
    cutoffs = stage(quality_rules.thresholds(measured, table(spark, sf_dir, "labels")), "cutoffs")
    judged = quality_rules.judge(measured, cutoffs)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some labels are moved on by one, so that positives and negatives lie close together."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95, scale=256)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.words(docs, least_symbols=6, least_n=5, drop_every=199), ratio=5)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_substring_dedup, op3_lm_difference, op4_jaccard_join, op5_rans_files, op6_block_search, op7_line_dedup, op8_bpe_trie, op9_quality_rules, op10_license_scan, op11_hard_negatives, op12_spelling_variants, op13_decontaminate)}
ORACLES = oracles.ORACLES
