"""A training corpus from ``documents``: five stages, each written as parquet and read by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stagemart.llm.decontaminate import find_contamination
from stagemart.llm.langid import identify_languages
from stagemart.llm.minhash import near_duplicates
from stagemart.llm.packing import pack_texts
from stagemart.llm.scratch import Scratch
from stagemart.llm.secret_scan import scan_secrets
from stagemart.llm.urls import build_cascade

#: Column names that no table has.
_MARK, _ID, _LEAST = "__corpus_pipeline__", "__corpus_pipeline_id__", "__corpus_pipeline_least__"


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is of a known language; null texts and those without a letter go too.

    Learns from all labelled documents. Without any label, no language is known and all go.
    """
    found = identify_languages(docs, F.col("lang").isNotNull(), output=_MARK)
    return found.where(~F.col(_MARK)["rejected"]).drop(_MARK)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id, once if its id and text repeat.

    Of rows that have one id and several texts, that of the least digest goes by the id and each other one
    by a number made of id and digest, larger than ids are. The rows to drop are told by an exact cascade of Bloom
    filters over all of these, so no text moves for it. Of rows that repeat id and text, the one of the least hash over all columns
    stays. Rows without an id stay. Null and empty texts group with nothing; an empty table stays empty.
    """
    scratch = Scratch(spark, "dedup-stage")
    digest = F.coalesce(F.sha1(F.col("text").cast("binary")), F.lit("-"))
    several = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias(_ID)).agg(F.min(digest).alias(_LEAST), F.max(digest).alias(_MARK))
    several, seen = scratch.keep_observed(several.where(F.col(_LEAST) != F.col(_MARK)).drop(_MARK), "several", rows=F.count(F.lit(1)))
    own = F.col("doc_id").cast("long")
    if seen["rows"]:
        made = F.lit(1 << 62).bitwiseOR(F.xxhash64("doc_id", digest).bitwiseAND(F.lit((1 << 62) - 1)))
        marked = docs.join(several, F.col("doc_id") == F.col(_ID), "left")
        marked = marked.withColumn(_MARK, F.when(F.col(_LEAST).isNull() | (digest == F.col(_LEAST)), own).otherwise(made)).drop(_ID, _LEAST)
    else:
        marked = docs.withColumn(_MARK, own)
    decided = near_duplicates(marked.select(F.col(_MARK).alias("doc_id"), "text")).where("id is not null")
    decided = scratch.keep(decided.groupBy("id").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("rows")), "decided")
    cascades = build_cascade(decided.select(F.col("id").cast("string").alias("key"), (~F.col("kept")).alias("listed")), scratch)
    key = F.coalesce(F.col(_MARK).cast("string"), F.lit(""))
    kept = cascades.passed(marked, key, lambda rows, listed: rows.where(F.col(_MARK).isNull() | ~listed), scratch)
    repeated = decided.where("kept and rows > 1").select(F.col("id").alias(_ID))
    if not repeated.isEmpty():
        once = kept.join(repeated, F.col(_MARK) == F.col(_ID), "left_semi")
        order = F.xxhash64(*(F.col(f"`{name.replace('`', '``')}`") for name in docs.columns))
        once = once.withColumn(_LEAST, F.row_number().over(Window.partitionBy(_MARK).orderBy(order))).where(F.col(_LEAST) == 1).drop(_LEAST)
        kept = kept.join(repeated, F.col(_MARK) == F.col(_ID), "left_anti").unionByName(once)
    return kept.drop(_MARK)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in verbatim benchmark passages.

    Null and empty texts, which have no words, stay, as does everything where the benchmark is empty. Whole
    texts are read, however long; repeated rows are judged alike; an empty table stays empty.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, benchmark, output=_MARK).where(~F.col(_MARK)["contaminated"]).drop(_MARK)


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a secret, by pattern or by structure.

    Null and empty texts hold none and stay. Whole texts are read, however long; repeated rows are judged
    alike; an empty table stays empty.
    """
    return scan_secrets(docs, output=_MARK).where(F.col(_MARK)["n_spans"] == 0).drop(_MARK)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bin and place in it of each document, or of each piece of one longer than a bin.

    Null texts and those without words are rows of length 0. A row that repeats is packed as often as it
    is there; equal lengths are told apart by hash; an empty table gives no row.
    """
    packed = pack_texts(docs)
    return packed.select(
        F.col("id").alias("doc_id"), "piece", F.col("length").alias("n_tokens"), F.col("bin").alias("bin_id"), F.col("place").alias("bin_offset")
    )


STAGES = [
    ("language_id", keep_languages),
    ("minhash_dedup", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("secret_scan", drop_secrets),
    ("packing", pack_documents),
]

#: SQL cannot express the stages; tests/llm compares each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each does with nulls, long texts, repeats and empty tables, it says itself."""
    scratch = Scratch(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        if before is not None and name != STAGES[0][0]:
            scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
