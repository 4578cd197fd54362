"""From raw documents to a tokenized mixture: five stages, each a Spark job over all that the one before kept.

Every stage takes an empty table to an empty one, keeps rows of a null or repeated doc_id, and leaves
columns beyond those of documents alone, whatever their names, up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import bpe_trie, jaccard_join, line_dedup, mixing, quality_rules
from tracewell.llm.common import stage, table

#: Tokenizer file of the last stage.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, whose cutoffs the labels of the corpus bound.

    Null and empty texts have too few words and go; a null lang is a stratum of its own; equal rows are judged alike.
    """
    return quality_rules.quality_filter(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; n_chars follows the text.

    Copies of a text count once, whatever a source's size; near copies count apart, since telling their classes takes more than
    DataFrame functions (line_dedup.dedup_texts(classes=...) does it). A null source is one source, a null text stays null
    with a null n_chars; a very long text is judged line by line like any other.
    """
    done = line_dedup.dedup_texts(docs, host="source", once=True, small=True, null_site=True)
    return done.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the least doc_id, of each class of similar documents.

    Texts without words (null, empty, blank) all stay; rows that share the class's doc_id stay together; a null doc_id is the largest.
    """
    return jaccard_join.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for.

    A null source is a source of its own; texts without words are drawn by their source's share; equal rows are taken equally often.
    """
    return mixing.repeat(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source of every document with its ids and the text they decode to; null and empty texts have none and ''."""
    coded = bpe_trie.decode(bpe_trie.encode(docs.select("doc_id", "lang", "source", "text"), TOKENIZER).drop("text"), TOKENIZER)
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids", "decoded")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir; each result is a table in the shared folder before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Chance, minima of hashes and a trie of tokens are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None
