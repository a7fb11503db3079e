"""WARC archives written and read back with Spark, records found by boundary-chain verification.

Writing: Spark's text writer puts one record after the other into the files of a shared
folder (its commit protocol drops what lost executors left). Among records with equal
payloads of ``min_revisit`` bytes or more, the smallest page_id is a response, the others
are revisits that refer to it.

Reading: the archives are split at every occurrence of the magic, in payloads too. Each
piece is a *candidate* record; its header's Content-Length gives the offset of its
successor. Starting from offset 0 of each file, pointer jumping keeps only the candidates
that the chain reaches: first inside each input split (one task each), then over the
splits of a file, in rounds that double the distance. A magic inside a payload is never
reached and its piece goes back to the record that holds it.

Size and digest of a response are those of the bytes read back, not of its header; a revisit
has no payload and repeats its header's. An archive is damaged if a response's bytes differ
from its header's digest or if the chain from a file's start does not end at the file's end;
``read_archives`` then fails, or with ``strict=False`` returns what the chain reaches and says
in ``intact`` which records are as written.

Null html is the empty payload. A null url leaves its header out; blanks and control characters
of a url are written as ``%20``. Rows that share page_id and payload are alike and get the
same record type. A null page_id sorts after all others. An empty table gives an empty
result; columns other than the two read do not matter.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cvforge.session import checkpoint_dir, write_shared

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(
    pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_revisit: int = 100, small: int = 1_000_000, url_col: str | None = "url"
) -> DataFrame:
    """Rows (page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to).

    Equal payloads are found on ids and digests alone. The list of revisits is broadcast if it has at
    most ``small`` rows (of about 100 bytes), so payloads need no shuffle; else both sides shuffle.
    """
    url = pages[url_col].cast("string") if url_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), url.alias("url"), F.coalesce(pages[payload_col].cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2(F.col("payload").cast("binary"), 256)})
    long_ones = rows.where(F.col("payload_bytes") >= min_revisit).select("page_id", "payload_digest")
    firsts = long_ones.groupBy(F.col("payload_digest").alias("first_digest")).agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
    again = long_ones.join(firsts, long_ones.payload_digest == firsts.first_digest).where(~F.col("page_id").eqNullSafe(F.col("first_id")))
    again = write_shared(again.select(F.col("page_id").alias("r_id"), F.col("first_digest"), "first_id").distinct(), "warc-revisits")
    if again.count() <= small:
        again = F.broadcast(again)
    joined = rows.join(again, rows.page_id.eqNullSafe(again.r_id) & (rows.payload_digest == again.first_digest), "left")
    revisit = F.col("first_digest").isNotNull()
    return joined.select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_archives(records: DataFrame, path: str, records_per_file: int = 100_000) -> None:
    """One WARC record per row of ``plan_records``, dated now; revisits carry headers only."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(""))
    header = F.concat_ws(
        "\r\n",
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "'WARC-Date: 'yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        F.when(F.col("record_type") == "revisit", F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "payload_digest"),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    lines = records.select(F.concat(F.lit(MAGIC), header, F.lit(END), body).alias("value"))
    lines.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece that follows a magic, with its place in its input split and its parsed header.

    ``at`` is the piece's magic relative to the split's first piece and ``size`` the bytes
    from magic to the next magic. Only pieces that are not whole records keep their text.
    """
    raw = spark.read.option("lineSep", MAGIC).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    head = F.substring_index("value", END, 1)
    field = lambda name, pattern: F.regexp_extract("head", f"(?:^|\r\n){name}: {pattern}(?:\r\n|$)", 1)
    pieces = raw.select(
        "file",
        "block",
        F.monotonically_increasing_id().alias("seq"),
        (F.octet_length("value") + len(MAGIC)).cast("long").alias("size"),
        "value",
        F.when(F.instr("value", END) > 0, head).alias("head"),
    ).withColumn("length", F.expr("try_cast({} as long)".format("regexp_extract(head, '(?:^|\\r\\n)Content-Length: ([0-9]+)(?:\\r\\n|$)', 1)")))
    body = F.substr("value", F.length("head") + F.lit(len(END) + 1))
    span = F.octet_length("head") + F.col("length") + F.lit(len(MAGIC) + 2 * len(END))
    payload = F.substr(body, F.lit(1), F.length(body) - len(END))
    digest = F.sha2(payload.cast("binary"), 256)
    said = field("WARC-Payload-Digest", "sha256:([0-9a-f]+)")
    revisit = field("WARC-Type", "([a-z]+)") == "revisit"
    whole = F.coalesce((F.col("size") == span) & (revisit | (digest == said)), F.lit(False))
    return pieces.select(
        "file",
        "block",
        "seq",
        "size",
        span.cast("long").alias("span"),
        F.expr("try_cast(regexp_extract(head, '(?:^|\\r\\n)WARC-Record-ID: <urn:page:(-?[0-9]+)>(?:\\r\\n|$)', 1) as long)").alias("page_id"),
        field("WARC-Type", "([a-z]+)").alias("record_type"),
        said.alias("payload_digest"),
        F.expr("try_cast(regexp_extract(head, '(?:^|\\r\\n)X-Payload-Length: ([0-9]+)(?:\\r\\n|$)', 1) as long)").alias("payload_bytes"),
        F.expr("try_cast(regexp_extract(head, '(?:^|\\r\\n)WARC-Refers-To: <urn:page:(-?[0-9]+)>(?:\\r\\n|$)', 1) as long)").alias("refers_to"),
        F.when(whole, digest).alias("read_digest"),
        F.when(whole, F.octet_length(payload).cast("long")).alias("read_bytes"),
        F.when(whole, F.sha2(F.col("value").cast("binary"), 256)).alias("text_digest"),
        F.when(~whole, F.col("value")).alias("piece"),
    )


def jump(starts: np.ndarray, nexts: np.ndarray, end: int) -> np.ndarray:
    """First offset at or beyond ``end`` (or a dead end, -1) that each start's chain reaches, by pointer doubling."""
    n = len(starts)
    spot = np.searchsorted(starts, nexts)
    inside = (spot < n) & (nexts < end) & (starts[np.minimum(spot, max(n - 1, 0))] == nexts) if n else np.zeros(0, bool)
    to = np.where(inside, spot, np.arange(n))
    while not np.array_equal(to, again := to[to]):
        to = again
    leaves = nexts[to]
    return np.where(leaves >= end, leaves, -1)


def chain_marks(starts: np.ndarray, nexts: np.ndarray, entry: int) -> np.ndarray:
    """Which starts the chain from ``entry`` reaches: marks spread along jumps that double."""
    n = len(starts)
    spot = np.searchsorted(starts, nexts)
    hit = (spot < n) & (starts[np.minimum(spot, n - 1)] == nexts)
    to = np.append(np.where(hit, spot, n), n)
    marks = np.append(starts == entry, False)
    while True:
        marks[to[np.flatnonzero(marks)]] = True
        marks[n] = False
        if np.array_equal(to, again := to[to]):
            return marks[:n]
        to = again


def _exits(table: pa.Table) -> pa.Table:
    t = table.sort_by("start")
    end = int(t["block_end"][0].as_py())
    return pa.table({"file": t["file"], "start": t["start"], "exit": jump(t["start"].to_numpy(), t["next"].to_numpy(), end)})


def _marks(left: pa.Table, right: pa.Table) -> pa.Table:
    t = left.sort_by("start")
    if t.num_rows and right.num_rows:
        marks = chain_marks(t["start"].to_numpy(), t["next"].to_numpy(), right["entry"][0].as_py())
    else:
        marks = np.zeros(t.num_rows, bool)
    return t.select(["file", "block", "seq", "start", "next"]).filter(pa.array(marks, pa.bool_()))


def reachable(index: DataFrame) -> DataFrame:
    """(file, block, seq, start, next) of the candidates that the chain from offset 0 of their file reaches.

    ``index`` has file, block, seq, block_end, start and next of every candidate. The blocks are
    the input splits of the files, so a task holds the narrow rows of one split.
    """
    links = index.where("next is not null").select("file", "block", "seq", "block_end", "start", "next")
    entries = links.where("start = 0").select(F.col("file").alias("e_file"), F.col("block").alias("e_block"), F.col("start").alias("entry"))
    if links.where("block > 0").limit(1).count():  # files of several splits: where does the chain enter each later split?
        hop = links.groupBy("file", "block").applyInArrow(_exits, "file string, start long, exit long").where("exit >= 0")
        hop = write_shared(hop, "warc-hops")
        found = hop.where("start = 0").select("file", F.col("exit").alias("at"))
        total = -1
        while (count := found.count()) > total:
            total = count
            a, b = hop.alias("a"), hop.alias("b")
            onward = found.alias("f").join(b, F.expr("f.file = b.file and f.at = b.start")).select("f.file", F.col("b.exit").alias("at"))
            found = write_shared(found.union(onward).distinct(), "warc-found")
            hop = a.join(b, F.expr("a.file = b.file and a.exit = b.start"), "left").select("a.file", "a.start", F.coalesce("b.exit", "a.exit").alias("exit"))
            hop = write_shared(hop, "warc-hops")
        later = found.alias("f").join(links.alias("l"), F.expr("f.file = l.file and f.at = l.start")).select("l.file", "l.block", "l.start")
        entries = entries.union(later)
    grouped = links.groupBy("file", "block").cogroup(entries.groupBy("e_file", "e_block"))
    return grouped.applyInArrow(_marks, "file string, block long, seq long, start long, next long")


def texts_of(spark: SparkSession, path: str, lost: DataFrame) -> DataFrame:
    """``lost`` (with ``text_digest``) and each row's ``piece``, read from the archives again by content."""
    wanted = lost.select("text_digest").distinct()
    raw = spark.read.option("lineSep", MAGIC).text(path).withColumn("text_digest", F.sha2(F.col("value").cast("binary"), 256))
    texts = raw.join(wanted, "text_digest", "left_semi").groupBy("text_digest").agg(F.any_value("value").alias("piece"))
    return lost.join(texts, "text_digest")


def read_archives(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Records of all archives under ``path``: page_id, payload_bytes, payload_digest (of the
    bytes read, for responses), record_type, refers_to, and ``intact``, whether a response's
    bytes have the digest and size that its header tells (revisits: true).

    Raises ValueError for a damaged archive unless ``strict`` is False.
    """
    pieces = write_shared(candidates(spark, path), "warc-pieces")
    sizes = pieces.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    sizes = sizes.withColumn("base", F.sum("bytes").over(W.partitionBy("file").orderBy("block")) - F.col("bytes"))
    order = W.partitionBy("file", "block").orderBy("seq")
    start = F.col("base") + F.sum("size").over(order) - F.col("size") - len(MAGIC)
    placed = (
        pieces.select("file", "block", "seq", "size", "span", "text_digest", "piece")
        .join(sizes, ["file", "block"])
        .select("file", "block", "seq", start.alias("start"), "span", (F.col("base") + F.col("bytes") - len(MAGIC)).alias("block_end"), "text_digest", "piece")
    )
    placed = write_shared(placed.withColumn("next", F.when(F.col("start") >= 0, F.col("start") + F.col("span"))), "warc-index")
    kept = reachable(placed).select("file", "block", "seq", F.col("start").alias("k_start"), F.col("next").alias("k_next"))
    records = write_shared(pieces.drop("size", "span", "piece").join(kept, ["file", "block", "seq"]), "warc-records")
    if strict:
        ends = placed.groupBy("file").agg(F.max("block_end").alias("end"))
        reached = records.groupBy("file").agg(F.max("k_next").alias("reached"))
        broken = ends.join(reached, "file", "left").where("end > 0 and not end <=> reached").select("file").first()
        if broken:
            raise ValueError(f"damaged archive: the records of {broken.file} do not end where the file ends")
    # a payload that holds a magic lies in several pieces; they are few and go back together by record
    holders = records.where("read_digest is null").select(F.col("file").alias("h_file"), F.col("k_start").alias("owner"), "k_next")
    parts = placed.where("piece is not null").select("file", "start", "piece")
    whole_ones = placed.where("text_digest is not null").select("file", "block", "seq", "start", "text_digest")
    if whole_ones.count() > records.where("text_digest is not null").count():  # whole records inside payloads
        lost = whole_ones.join(records.select("file", "block", "seq"), ["file", "block", "seq"], "left_anti")
        parts = parts.unionByName(texts_of(spark, path, lost).select("file", "start", "piece"))
    parts = parts.join(holders, F.expr("file = h_file and start >= owner and start < k_next"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "piece"))), lambda p: p["piece"]), MAGIC)
    whole = parts.groupBy("h_file", "owner").agg(joined.alias("joined"))
    cut = F.substr("joined", F.length(F.substring_index("joined", END, 1)) + F.lit(len(END) + 1))
    payload = F.substr(cut, F.lit(1), F.length(cut) - len(END))
    whole = whole.select(
        "h_file", "owner", F.sha2(payload.cast("binary"), 256).alias("joined_digest"), F.octet_length(payload).cast("long").alias("joined_bytes")
    )
    revisit = F.col("record_type") == "revisit"
    read_digest, read_bytes = F.coalesce("read_digest", "joined_digest"), F.coalesce("read_bytes", "joined_bytes")
    found = records.join(whole, F.expr("file = h_file and k_start = owner"), "left").select(
        "page_id",
        F.when(revisit, F.col("payload_bytes")).otherwise(read_bytes).alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(read_digest).alias("payload_digest"),
        "record_type",
        "refers_to",
        F.coalesce(revisit | ((read_digest == F.col("payload_digest")) & (read_bytes == F.col("payload_bytes"))), F.lit(False)).alias("intact"),
    )
    if strict:
        found = write_shared(found, "warc-found")
        bad = found.where("not intact").select("page_id").first()
        if bad:
            raise ValueError(f"damaged archive: the payload of page {bad.page_id} is not what its header tells")
    return found


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives (to a fresh shared folder unless ``path`` is given) and read them back."""
    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(plan_records(pages, id_col, payload_col), path)
    return read_archives(spark, path)
