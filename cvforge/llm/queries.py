"""The dealt queries: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvforge.llm import fingerprint, langid, minhash, pii, suffix_dedup, toxicity
from cvforge.llm.bpe import round_trip
from cvforge.llm.collocations import collocations
from cvforge.llm.common import fold, read_table
from cvforge.llm.decontam import find_occurrences
from cvforge.llm.exact_dedup import exact_duplicates
from cvforge.llm.filter_audit import filter_interactions
from cvforge.llm.oracles import ORACLES as ALL_ORACLES
from cvforge.llm.url_filter import filter_urls
from cvforge.llm.warc import archive_round_trip

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    profiles = langid.learn(docs.where(fold(F.col("doc_id")) != 2))
    found = langid.predict(docs, profiles)
    return found.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return round_trip(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_occurrences(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.learn(docs))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind))
    rank = lambda s: F.array_position(F.array(*map(F.lit, pii.KINDS)), s["kind"])
    every = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select(
        "doc_id",
        *(count(k).cast("long").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(every).alias("spans"),
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.compare_with_edits(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.written(F.col("sketch")).alias("fingerprint"),
        fingerprint.written(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprint.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id",
        (fold(F.col("doc_id")) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_minhash, op2_langid, op3_bpe, op4_suffix_dedup, op5_decontam, op6_pii, op7_fingerprints, op8_toxicity, op9_urls, op10_warc, op11_exact_dedup, op12_collocations, op13_filter_audit)
}

ORACLES: dict[str, str] = {k: v for k, v in ALL_ORACLES.items() if k in QUERIES}
