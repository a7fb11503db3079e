"""Corpus pipeline: documents that stay, without copies, benchmark passages or personal data, as tokens.

``STAGES`` lists (name, function) in order. A function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``; all but the last
return the columns of ``docs``. ``run`` applies them to the ``documents`` table.

Null or wordless texts: language identification rejects texts without a letter. A document is
what has one doc_id; of rows with one id and text one stays, rows with one id and different
texts stay or go together. A null doc_id is kept as it is; of equal texts without ids one stays.
Columns beyond those of ``documents`` pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cvforge.llm import bpe, decontam, langid, minhash, pii
from cvforge.llm.common import fold, read_table
from cvforge.session import write_shared

#: Texts of so many letter n-grams or more go if they resemble no learned language.
ENOUGH_GRAMS = 100
#: Up to so many ids (8 bytes each) the list of dropped documents is broadcast.
SMALL = 1_000_000


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled ones outside the held-out fold."""
    learning = docs.where(fold(F.col("doc_id")) != 2)
    profiles = langid.learn(learning)
    return langid.accepted(docs, profiles, langid.least_cosines(learning, profiles, ENOUGH_GRAMS), ENOUGH_GRAMS)


def numbered(docs: DataFrame) -> Column:
    """The id of a row; one without an id has a number made of its text, beyond any id in use."""
    return F.coalesce(docs["doc_id"], F.lit(1 << 62) + F.xxhash64(docs["text"]).bitwiseAND((1 << 61) - 1))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """One row of each id and text; ids that come once, mostly all, are told first by counts alone."""
    rows = docs.withColumn("copy_number", numbered(docs))
    again = rows.groupBy("copy_number").count().where("count > 1").select("copy_number")
    again = write_shared(again, "pipeline-repeats")
    if again.isEmpty():
        return docs
    once = rows.join(again, "copy_number", "left_anti")
    repeated = rows.join(again, "copy_number", "left_semi").dropDuplicates(["copy_number", "text"])
    return write_shared(once.unionByName(repeated).select(*docs.columns), "pipeline-once")


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the least id.

    Rows alike in id and text are one row. A row without an id takes part under a number of its own.
    """
    docs = drop_repeats(docs)
    number = numbered(docs)
    judged = minhash.near_duplicates(docs.select(number.alias("doc_id"), docs["text"]), params=minhash.Params(shingle=5, percent=80, halves=16))
    judged = write_shared(judged.select(F.col("doc_id").alias("copy_id"), "kept"), "pipeline-copies")
    gone = judged.groupBy("copy_id").agg(F.max("kept").alias("kept")).where("not kept").select("copy_id")
    if gone.count() <= SMALL:
        gone = F.broadcast(gone)
    return docs.join(gone, number == gone["copy_id"], "left_anti")


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars is that of the new text."""
    return pii.redact(docs, pii.learn(docs), length_col="n_chars")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", keep_languages),
    ("near-duplicates", keep_one_of_copies),
    ("benchmark decontamination", drop_benchmarks),
    ("personal data", redact),
    ("byte-level BPE", tokenize),
]

#: SQL cannot express the learned stages; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
