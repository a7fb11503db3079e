"""Sources and sinks (S-1, S-4, S-5)."""

from __future__ import annotations

import hashlib
import json
from typing import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvforge.functions.columns import col
from cvforge.functions.fingerprints import dataset_fingerprint

SEAL = "signature string, source string, fmt string, tables array<struct<name: string, rows: bigint, fingerprint: string, link: string>>"

# Text tokens read as missing in CSV input (the usual CSV-reader defaults).
DEFAULT_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def load_table(
    spark: SparkSession,
    path: str,
    target: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    na_values: Sequence[str] = DEFAULT_NA_VALUES,
) -> DataFrame:
    """S-1: read CSV or Parquet, require the target column and move it last.

    CSV text equal to one of ``na_values`` becomes NULL. Without a schema all columns are read
    as text, and each becomes the narrowest of bigint, double and string that holds what is left.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("nullValue", "").csv(path)
        tokens = list(na_values)
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.select(*[F.when(~col(c).isin(*tokens), col(c)).alias(c) if c in text else col(c) for c in df.columns])
        if schema is None:
            df = _typed(df)
    else:
        df = reader.format(fmt).load(path)
    if target not in df.columns:
        raise ValueError(f"{path} has no column '{target}' to predict")
    return df.select(*[col(c) for c in df.columns if c != target], col(target))


def _typed(df: DataFrame) -> DataFrame:
    """Text columns as the narrowest type that every value fits; a column without values stays text."""
    fits = [F.count_if(F.trim(col(c)).try_cast(t).isNotNull()).alias(f"{t}_{i}") for i, c in enumerate(df.columns) for t in ("bigint", "double")]
    counts = df.agg(*[F.count(col(c)).alias(f"all_{i}") for i, c in enumerate(df.columns)], *fits).first()
    out = []
    for i, c in enumerate(df.columns):
        fit = next((t for t in ("bigint", "double") if counts[f"all_{i}"] and counts[f"{t}_{i}"] == counts[f"all_{i}"]), None)
        out.append(F.trim(col(c)).try_cast(fit).alias(c) if fit else col(c))
    return df.select(*out)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """S-4: write one result table (Parquet by default, CSV with a header)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def _links(signature: str, source: str, prints: Sequence[tuple[str, int, str]]) -> list[str]:
    """A digest for each table that binds it to all before it, the first one to signature and source."""
    links, last = [], hashlib.sha256(f"{signature}\n{source}".encode()).hexdigest()
    for name, rows, fingerprint in prints:
        last = hashlib.sha256(f"{last}\n{name}\n{rows}\n{fingerprint}".encode()).hexdigest()
        links.append(last)
    return links


def _stored(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path)


def seal_tables(spark: SparkSession, out_dir: str, names: Sequence[str], signature: str, source: str, fmt: str = "parquet") -> str:
    """S-5: bind the written tables ``names`` to the run's signature and the fingerprint of its input.

    ``<out_dir>/run_seal`` gets one row: signature, source, fmt, tables array<struct<name, rows,
    fingerprint, link>>. Returns the last link, which stands for the whole run.
    """
    out = out_dir.rstrip("/")
    prints = []
    for name in names:
        df = _stored(spark, f"{out}/{name}", fmt)
        prints.append((name, df.count(), dataset_fingerprint(df)))
    links = _links(signature, source, prints)
    rows = [(signature, source, fmt, [(*p, link) for p, link in zip(prints, links, strict=True)])]
    spark.createDataFrame(rows, SEAL).coalesce(1).write.mode("overwrite").parquet(f"{out}/run_seal")
    return links[-1] if links else ""


def verify_tables(spark: SparkSession, out_dir: str, signature: str | None = None) -> DataFrame:
    """(name, rows, intact) of each sealed table: whether it holds what was sealed, and the chain
    up to it is unbroken. A table that cannot be read has null rows. ``signature``: the one expected."""
    out = out_dir.rstrip("/")
    seal = spark.read.parquet(f"{out}/run_seal").first()
    known = [(t["name"], t["rows"], t["fingerprint"]) for t in seal["tables"]]
    links = _links(seal["signature"] if signature is None else signature, seal["source"], known)
    found = []
    for (name, rows, fingerprint), t, link in zip(known, seal["tables"], links, strict=True):
        try:
            df = _stored(spark, f"{out}/{name}", seal["fmt"])
            now = (df.count(), dataset_fingerprint(df))
        except PySparkException:
            now = (None, None)
        found.append((name, now[0], now == (rows, fingerprint) and link == t["link"]))
    return spark.createDataFrame(found, "name string, rows long, intact boolean")


def write_metadata(spark: SparkSession, metadata: dict, path: str) -> None:
    """S-5: run metadata as a one-row JSON document."""
    text = json.dumps(metadata, sort_keys=True, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
