"""The corpus pipeline: rules, near duplicates, repeats, benchmark passages, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import bpe, decontam, near_dup, quality_rules, suffix_dedup
from tradelake.llm.scratch import Scratch
from tradelake.llm.ship import ship_package

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SHINGLE = 5
PERCENT = 80
# A repeat goes from this many words on; so many have 255 bytes, at four letters each.
PASSAGE_WORDS = 51
PASSAGE_BYTES = 5 * PASSAGE_WORDS
PASSAGE_PREFIX = 150


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules. Null, empty and very short texts do not."""
    judged = quality_rules.apply_rules(docs, into="_quality")
    return judged.filter("_quality.kept").select(_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id, or any if none has one.

    Groups are judged row by row, so rows that share an id, or have none, stay or go by their texts.
    Of blank texts, which are in no group, one stays of rows that repeat an id and a text.
    """
    ship_package(spark)
    stay = near_dup.leading_rows(docs, shingle=SHINGLE, percent=PERCENT)
    return stay.dropDuplicates(["doc_id", "text"])


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that also stand elsewhere; characters stay whole.

    Strings of `PASSAGE_BYTES` are looked for; runs of them with fewer than `PASSAGE_WORDS` words stay, unless
    they have 400 bytes.
    """
    ship_package(spark)
    cut = suffix_dedup.remove_repeats(
        docs, length=PASSAGE_BYTES, prefix=PASSAGE_PREFIX, whole_chars=True, least_words=PASSAGE_WORDS
    )
    text = F.col("kept").cast("string")
    new = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return cut.select(
        [new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item, judged row by row whatever their ids.

    What a row holds depends on its text alone, so the verdict comes back by the text's hash.
    """
    ship_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.unhex(F.sha2(text, 256))
    found = decontam.find_contamination(
        docs.select(key.alias("key"), text.alias("text")), items, id_column="key"
    )
    hit = found.filter("n_hit > 0").select(F.col("id").alias("_hit")).distinct()
    return docs.join(hit, key == hit["_hit"], "left_anti")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (little-endian unsigned 32-bit), and whether they decode to it."""
    ship_package(spark)
    found = bpe.encode_checked(docs, RANKS, public_tokenizers.PATTERN)
    others = [F.col(f"row.`{c}`") for c in docs.columns if c != "text"]
    return found.select(*others, "text", "n_tokens", "ids", "round_trip")


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", repeats),
    ("decontamination", decontaminate),
    ("bpe", tokenize),
]

# The last stages have no equivalent in SQL; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet in the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, path = scratch.table(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = path
    return docs
