"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlas.llm import decontam, htmltext, langid, media, mixing, pii, simhash, substring, urlfilter, warc
from statlas.llm._util import scratch, table
from statlas.llm.oracles import ORACLE_SQL

__all__ = ["MIX", "ORACLE_SQL", "QUERIES", "RULES"]

Query = Callable[[SparkSession, str], DataFrame]


def _sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", _sha256(F.col("kept_text")).alias("kept_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = F.col("pii")
    counts = [pii.count(found, k).alias(f"n_{k}") for k in pii.BASE]
    return docs.select("doc_id", *counts, _sha256(pii.joined(pii.base(found))).alias("base_sha256"), pii.joined(found).alias("spans"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.load(media.store(table(spark, sf_dir, "documents")))
    size, payload = F.length("payload"), F.col("payload")
    return read.select(
        "doc_id",
        "n_bytes",
        size.cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substr(payload, size - media.UNIT + 1, F.lit(media.UNIT))).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.fit(docs.where(~F.col("held_out")).select("text", "lang"))
    return langid.identify(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


#: Target weights of the mixing query and of the pipeline.
MIX = mixing.Mix(domains={"d0": 5, "d1": 3, "d2": 2}, languages={"en": 4, "de": 2, "fr": 2, "es": 2}, share=0.5, max_epochs=3)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mixed(docs, MIX).select("doc_id", "domain", "language", "origin", "n_tokens", "copies")


#: The rules of the URL query.
RULES = [
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_substring": op2_substring,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_pii": op5_pii,
    "op6_main_text": op6_main_text,
    "op7_media": op7_media,
    "op8_language": op8_language,
    "op9_mixing": op9_mixing,
    "op10_urls": op10_urls,
}
