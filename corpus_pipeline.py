"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again before the next stage. All
but the last return the columns of the documents. Edge cases are those of the operators; rows are known by their id and a
hash of their text, so that rows without an id or with a repeated one are judged each by its own text, and a document of which nothing
is left stays with an empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import near_dup, packing, quality, suffix_dedup
from lakeops.llm.common import table
from lakeops.sources.staging import stage

#: Fewest words of a repeated passage: over 50, however few bytes they have. 400 bytes, as op2 takes, are 60 words or more in most languages.
PASSAGE_WORDS = 51


def text_tag() -> Column:
    """Hash of the text, as the operators make it."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def packed(docs: DataFrame) -> Column:
    """The whole row as one column, which names used inside can't clash with."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def with_keys(docs: DataFrame) -> DataFrame:
    """``_key``, ``text``, ``_tag`` and ``_row`` of the documents, and ``_again``: other rows may have that key and text.

    The key is the id if no other text has it, else a hash of id and text beyond usual ids, so that those come first.
    """
    keyed = docs.select(packed(docs), "text", F.col("doc_id").cast("long").alias("_key"), text_tag().alias("_tag"))
    repeated = keyed.groupBy("_key").agg(F.count("*").alias("_n"), (F.min("_tag") < F.max("_tag")).alias("_unlike")).where("_n > 1 AND _key IS NOT NULL")
    repeated = stage(repeated.select(F.col("_key").alias("_repeated"), "_unlike"), "repeated-ids")
    hashed = F.xxhash64("_key", "_tag").bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    alone = F.col("_key").isNotNull() & ~F.coalesce("_unlike", F.lit(False))
    joined = keyed.join(repeated, F.col("_key") == F.col("_repeated"), "left")
    return joined.select(
        "_row", "text", "_tag", F.when(alone, F.col("_key")).otherwise(hashed).alias("_key"), (F.col("_key").isNull() | F.col("_repeated").isNotNull()).alias("_again")
    )


def one_of_each(keyed: DataFrame) -> DataFrame:
    """The rows, of equal keys and texts one: the one whose columns have the smallest hash."""
    least = F.min_by("_row", F.xxhash64("_row")).alias("_row")
    again = keyed.where("_again").groupBy("_key", "_tag").agg(least)
    return keyed.where("NOT _again").select("_row").unionByName(again.select("_row")).select("_row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    verdicts = quality.quality_rules(docs, table(spark, sf_dir, "labels")).where("NOT kept")
    gone = verdicts.select(F.col("doc_id").alias("_gone"), F.col("stratum").alias("_stratum"), F.col("text_tag").alias("_tag")).distinct()
    # equal texts can be judged unlike in two strata
    rows = docs.select(packed(docs), F.col("doc_id").cast("long").alias("_id"), text_tag().alias("_hash"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"))
    same = F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_hash") == F.col("_tag")) & (F.col("_lang") == F.col("_stratum"))
    return rows.join(gone, same, "left_anti").select("_row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, similarity from 0.8. Texts without words are no copies of one another, but for equal ones under one id or none."""
    keyed = with_keys(docs)
    verdicts = near_dup.near_duplicates(keyed, words=5, percent=80, id_col="_key").where("NOT kept")
    kept = keyed.join(verdicts.select(F.col("doc_id").alias("_gone")).distinct(), F.col("_key") == F.col("_gone"), "left_anti")
    # copies under one id, or without one, are one document to near_duplicates: without this, all of them would lose their text as repeats
    return one_of_each(kept)


def with_texts(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """The documents with the texts that the removal of repeats left."""
    left = cut.where("n_removed > 0").dropDuplicates(["doc_id", "text_tag"])
    changed = left.select(F.col("doc_id").alias("_id"), "text_tag", "kept_text")
    rows = docs.select(packed(docs), F.col("doc_id").cast("long").alias("_doc"), text_tag().alias("_tag"))
    joined = rows.join(changed, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_tag") == F.col("text_tag")), "left")
    cut_row = F.col("_row").withField("text", F.col("kept_text")).withField("n_chars", F.char_length("kept_text").cast("long"))
    return joined.select(F.when(F.col("kept_text").isNotNull(), cut_row).otherwise(F.col("_row")).alias("_row")).select("_row.*")


def repeated_words_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ``PASSAGE_WORDS`` words that are found elsewhere."""
    return with_texts(docs, suffix_dedup.remove_repeats(docs, with_text=True, words=PASSAGE_WORDS))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that 400-byte strings found elsewhere cover, which may hold few words or none."""
    return with_texts(docs, suffix_dedup.remove_repeats(docs, with_text=True))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_words", repeated_words_stage),
    ("repeated_passages", repeated_passage_stage),
    ("packing", packing_stage),
]

#: The stages hash and tokenize, which SQL can't express; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
