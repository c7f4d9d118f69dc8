"""One query per operator over the synthetic tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from onlinecast.llm import (
    bpe, chat, decontaminate, exact, extract, jaccard, langid, lattice, phrases, repeats, runs, toxicity, warc,
)
from onlinecast.llm.common import remainder_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it comes back from archives written anew."""
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs), keep=["doc_id"])
    held_out = F.coalesce(remainder_of("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the view of every participant."""
    found = chat.perspectives(table(spark, sf_dir, "conversations"))
    span = F.transform("mask", lambda m: F.concat_ws("-", m["start"], m["end"]))
    return found.withColumn("mask", F.array_join(span, ","))


def op4_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract.main_text(pages, keep=["page_id", "url"])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage in every document."""
    docs = table(spark, sf_dir, "documents")
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similar shingle sets."""
    return jaccard.linked(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 200 bytes."""
    return repeats.removal_digests(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(remainder_of("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of near-duplicate vectors with equal labels."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"])


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and whether it stays."""
    return exact.duplicates(table(spark, sf_dir, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """Every tenth document (by the hash of its id) with a tail that repeats itself."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = docs.withColumn("__h", hashed).withColumn("__g", F.expr("__h div 10"))
    docs = docs.withColumn("__words", F.when(F.col("__h") % 10 == 0, words)).withColumn("__n", F.size("__words"))
    docs = docs.withColumn("__a", F.expr("if(__n > 0, __g % __n, null)"))
    docs = docs.withColumn("__p", F.expr("1 + (__n - __a) div (3 + __g % 8)"))
    tail = F.expr("transform(__words, (w, i) -> if(i >= __a, __words[int(__a + (i - __a) % __p)], w))")
    text = F.when(F.col("__n") > 0, F.array_join(tail, " ")).otherwise(F.col("text"))
    return docs.withColumn("text", text).drop("__h", "__g", "__words", "__n", "__a", "__p")


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some of which get a periodic tail first."""
    docs = with_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return runs.run_digests(runs.periodic_runs(docs, keep=["doc_id"]))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_language": op2_language,
    "op3_perspectives": op3_perspectives,
    "op4_extract": op4_extract,
    "op5_decontaminate": op5_decontaminate,
    "op6_jaccard": op6_jaccard,
    "op7_repeats": op7_repeats,
    "op8_toxicity": op8_toxicity,
    "op9_lattice": op9_lattice,
    "op10_bpe": op10_bpe,
    "op11_exact": op11_exact,
    "op12_runs": op12_runs,
    "op13_phrases": op13_phrases,
}
