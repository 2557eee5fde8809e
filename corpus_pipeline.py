"""The corpus pipeline over ``documents``.

Each stage takes what the one before kept. All but the last return the columns of
``documents`` as they came; their decisions are the rows they leave out:

1. language: documents without a recognised language go (no letters, or a mixture in
   which no language reaches half).
2. quality: documents that fail the base rule, or lie too far from their language, go.
3. near_duplicates: of each group of near copies (five-word shingles, similarity of
   0.8 or more) the document with the smallest doc_id stays.
4. packing: what is left is tokenized and packed into sequences, a row per piece.

Rows repeating a doc_id with another text, and rows without one, are documents of their
own; of rows alike in both one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import common, divergence, hyperminhash, langid, packing, tokens

# The least share the leading language of a kept document has.
LEADING_SHARE = 0.5
NEAR = hyperminhash.Rule(words=5, percent=80)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: learns from the labelled documents, judges every text."""
    judged = langid.predict(docs.select(*COLUMNS), langid.learn(docs), COLUMNS)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.element_at("shares", 1) >= LEADING_SHARE)
    return judged.where(known).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules against the references of the documents that reached this stage."""
    judged = divergence.judge(docs.select(*COLUMNS), divergence.references(docs), COLUMNS)
    return judged.where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    A row is named by its id and 128 bits of its text, so different texts under one id
    and texts without an id are documents of their own.
    """
    named = docs.select(*COLUMNS).withColumns({"_a": F.xxhash64("text"), "_b": F.xxhash64("text", F.lit(1))})
    found = hyperminhash.near_groups(named, NEAR, ["_a", "_b"]).where("first").select("doc_id", "_a", "_b")
    # texts without a word are alone, each row of them
    name = [F.struct(F.coalesce("doc_id", F.col("_a")).alias("id"), F.col("doc_id").isNull().alias("none"), "_a", "_b").alias("_name")]
    kept = found.select(*name).distinct()
    return named.select("*", *name).join(kept, "_name", "left_semi").dropDuplicates(["_name"]).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    definition = tokens.definition_of(public_tokenizers.path("word_bpe_49k.json"))
    placed = packing.pack(packing.stored_pieces(docs, definition, literal=False))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("packing", pack)]

# Mixtures, divergences and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
