"""The stages a corpus goes through, each on all that its predecessor kept.

Every stage takes and returns the columns of documents (the last one returns pieces),
loses no row but those it rejects, and treats a null or empty text as an empty
document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.decontam import find_leaks
from foliospark.llm.jaccard import link_similar
from foliospark.llm.langid import UNKNOWN, fit, identify
from foliospark.llm.linededup import dedup_lines
from foliospark.llm.packing import pack
from foliospark.llm.tables import narrow, sized
from foliospark.plans.scratch import written

ORACLE_SQL = None  # language models and tokenizers are beyond SQL

MIN_DOCS = 10
SHINGLE, PERCENT = 5, 80
TOKENIZER = "byte_bpe_50k.json"
#: A text with a word: the n-gram join links all others with nothing.
_SOME_WORD = "[^\\x20\\x09-\\x0D]"


def _learnable() -> Column:
    """Rows that a model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2, F.lit(True))


def _carried(docs: DataFrame, *more: Column) -> DataFrame:
    """The text, beside all other columns in one: no name of a stage can meet one of theirs."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(others.alias("own"), "text", *more)


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, in their order, from rows that carry them."""
    return rows.select(*[F.col("text") if c == "text" else F.col("own")[c].alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters and those of no known language go, however many known ones a document has.

    Of no known language is a text that a background model of n-grams explains better.
    """
    model = fit(docs.where(_learnable()).select("text", "lang"))
    found = identify(_carried(docs, F.col("text").alias("read")), model, text="read")
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("gain") >= 0)
    return _restored(found.where(known), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go; every document stays."""
    kept = dedup_lines(_carried(docs), min_docs=MIN_DOCS).withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        n_chars = F.char_length("text").cast("long")
        kept = kept.withColumn("own", F.col("own").withField("n_chars", n_chars))
    return _restored(kept, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays.

    Documents without words are no duplicates of each other and stay.
    """
    linked = link_similar(docs.select("doc_id", "text"), size=SHINGLE, percent=PERCENT)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key")))
    stay = (
        linked.where(F.col("class_key").isNotNull())
        .groupBy("class_key", "doc_id", "text_key")
        .agg(F.count("*").alias("rows"))
        .groupBy("class_key")
        .agg(first.alias("f"), F.max("rows").alias("rows"))
        .select(F.col("f.doc_id").alias("doc"), F.col("f.text_key").alias("key"), (F.col("rows") > 1).alias("more"))
    )
    wordy = F.coalesce(F.col("text").rlike(_SOME_WORD), F.lit(False))
    keyed = _carried(docs.where(wordy), F.xxhash64("text").alias("text_key"))
    same = F.col("own.doc_id").eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("key"))
    kept = keyed.join(sized(narrow(stay, "stay")), same)
    # Only rows that may be repeated as a whole have to meet.
    repeated = kept.where("more").dropDuplicates(["doc", "text_key"])
    kept = kept.where("not more").unionByName(repeated)
    return _restored(kept, docs).unionByName(docs.where(~wordy))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = find_leaks(docs.select("doc_id", "text"), benchmark).select(
        F.col("doc_id").alias("doc"), F.col("text_key").alias("key")
    )
    keyed = _carried(docs, F.xxhash64("text").alias("text_key"))
    leaked = F.col("own.doc_id").eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("key"))
    leaks = sized(narrow(leaks.distinct(), "leaks"))
    return _restored(keyed.join(leaks, leaked, "left_anti"), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences of 2048 tokens."""
    return pack(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
