"""From raw documents to packed sequences: language ID, near-duplicate removal, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last keep the columns of ``docs``, whatever
they are besides doc_id, text and source. ``run`` writes each stage's result as Parquet and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martmill.llm import jaccard, langid, mix, pack
from martmill.llm.ship import shipped
from martmill.session import materialise, tune

ORACLE_SQL = None  # a tokenizer and random letter vectors are beyond SQL; tests/llm holds each stage against brute force


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language: texts that are null or hold no letter go.

    The profiles are learned from the documents with a language; a text with letters is never rejected for looking
    unlike any of them, so that short and mixed clean texts stay.
    """
    shipped(spark)
    langs, vectors = langid.prototypes(docs)
    if not langs:  # nothing to tell languages by
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return langid.predict(docs, langs, vectors).where(F.col("lang_pred") != langid.UNDETERMINED).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Texts without words are no copies."""
    shipped(spark)
    rows = materialise(jaccard.labelled(docs), "pipeline-groups")
    here = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id"), F.col("mark"))
    first = rows.where(F.col("label").isNotNull()).groupBy("label").agg(F.min(here).alias("kept")).select("kept.mark").withColumn("single", F.lit(True))
    alone = rows.where(F.col("label").isNull()).select("mark").distinct().withColumn("single", F.lit(False))
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = docs.select(held, F.xxhash64("doc_id", "text").alias("mark")).join(first.unionAll(alone), "mark")
    singles = kept.where("single").dropDuplicates(["mark"])  # equal rows: one stays
    return singles.select("row.*").unionAll(kept.where("not single").select("row.*"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times."""
    plan = mix.mix(docs).where(F.col("copies") > 0).groupBy("hash").agg(F.min("copies").alias("copies"))
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    taken = docs.select(held, F.xxhash64("doc_id", "text", F.lit("mix")).alias("hash")).join(plan, "hash")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    shipped(spark)
    return pack.pack(pack.cut(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("source_mix", source_mix), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
