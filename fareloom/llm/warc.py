"""WARC archives without repeated payloads.

Headers (id, digest, length) are shuffled by payload digest. The record with the smallest id of each digest becomes the
response, the others become revisit records that refer to it. Archives are written with fresh headers, a payload only
in responses. Reading back streams each archive record by record and joins revisits to their responses again.

Archives are gzip files. A record is its headers, an empty line, its block and two line ends; Spark's text writer puts
those two line ends, and its reader splits there. The pieces are put together again, and records are cut from them by
their Content-Length, so a payload may hold line ends anywhere, its own end included. A gzip file is read by one task from start to end, so records keep their order, and memory is
bounded by the largest record.

Cases: null html is an empty payload, and empty payloads count as equal. A null url becomes an empty target. Rows with
equal ids are records of their own; of equal ids with one digest, one is the response and the rest refer to its id.
Null ids are written as empty and read as null. An empty table gives an empty result. Columns other than the named
ones are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.llm.common import by_value, join_counted, shared_dir, stored, table

by_value(__name__)

#: Payloads shorter than this are never deduplicated.
LEAST_BYTES = 0
#: Records in one archive.
ARCHIVE_RECORDS = 2000
#: Time written into every record: a parameter, so that a task that runs again writes the same bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
RECORD = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
    "payload string, archive string"
)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 digest: every 5 hex digits are 4 base32 digits."""
    hexed = F.sha1(data)
    fours = [
        F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def headers(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> page_id, digest, size: what is shuffled instead of the payloads."""
    data = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        base32_sha1(data).alias("digest"),
        F.octet_length(data).cast("long").alias("size"),
    )


def originals(heads: DataFrame) -> DataFrame:
    """digest -> the response's id, and the number of records with that digest."""
    return (
        heads.filter(F.col("size") >= LEAST_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("copies"))
    )


def records(pages: DataFrame) -> DataFrame:
    """One row for each page: its fresh headers' values, and the payload where it is a response."""
    heads = stored(headers(pages), "headers")
    found = originals(heads)
    repeated = stored(found.filter("copies > 1"), "repeated-payloads")
    # Only pages whose payload is repeated and that are not the first need a decision; ids may be repeated too.
    marked = join_counted(heads, repeated, "digest", "copies", "inner").groupBy("digest", "original", "page_id").agg(
        F.count(F.lit(1)).alias("rows")
    )
    decided = marked.filter("rows > 1 OR page_id <> original OR page_id IS NULL").select(
        F.concat_ws(":", "digest", "page_id").alias("k"), "original", F.lit(True).alias("repeated")
    )
    html = F.coalesce("html", F.lit(""))
    digest = base32_sha1(F.encode(html, "UTF-8"))
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("payload"), digest.alias("digest")
    ).withColumn("k", F.concat_ws(":", "digest", "page_id"))
    joined = full.join(decided.hint("shuffle_hash"), "k", "left")
    # Of rows that share even the response's id the first is the response.
    turn = F.row_number().over(W.partitionBy("k").orderBy("url"))
    is_copy = F.col("repeated").isNotNull() & (~F.col("page_id").eqNullSafe(F.col("original")) | (turn > 1))
    return joined.withColumn("copy", is_copy).select(
        "page_id",
        "url",
        "digest",
        F.octet_length("payload").cast("long").alias("size"),
        F.when(F.col("copy"), "revisit").otherwise("response").alias("type"),
        F.when(F.col("copy"), F.col("original")).alias("refers_to"),
        F.when(~F.col("copy"), F.col("payload")).alias("payload"),
    )


def record_text(http: Column) -> Column:
    """A record without its closing line ends."""
    is_revisit = F.col("type") == "revisit"
    one_line = F.regexp_replace("url", "[\\r\\n]", "%0A")
    block = F.concat(http, F.coalesce("payload", F.lit("")))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "type"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), one_line),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.lit(">"))),
        F.when(is_revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
        F.lit(""),
        block,
    ]
    return F.concat_ws(CRLF, *lines)


def write_archives(recs: DataFrame, path: str) -> None:
    """Archives in `path`, every one with at most ARCHIVE_RECORDS records."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html;charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF + CRLF))
    (
        recs.select(record_text(http).alias("value"))
        .write.option("lineSep", CRLF + CRLF)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ARCHIVE_RECORDS)
        .text(path)
    )


def parse_record(raw: bytes) -> tuple | None:
    """A record's values once it is whole, else None."""
    head, sep, block = raw.partition(b"\r\n\r\n")
    if not sep:
        return None
    fields = dict(line.split(": ", 1) for line in head.decode().split(CRLF)[1:])
    if len(block) < int(fields["Content-Length"]):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    is_revisit = fields["WARC-Type"] == "revisit"
    number = lambda field: int(fields[field][10:-1]) if len(fields[field]) > 11 else None  # noqa: E731  <urn:page:N>
    return (
        number("WARC-Record-ID"),
        fields["WARC-Target-URI"],
        fields["WARC-Type"],
        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        None if is_revisit else len(payload),
        number("WARC-Refers-To") if is_revisit else None,
        None if is_revisit else payload.decode(),
    )


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces between double line ends, in order -> records."""
    columns = [f.split()[0] for f in RECORD.split(", ")]
    end = b"\r\n\r\n"
    rest: list[bytes] = []
    have = need = 0  # bytes in rest, and in the record it begins with (0: headers not yet whole)
    current = None

    def whole() -> None:
        # Every piece is taken to end in `end`; an archive's last one may not, which leaves one `end` over.
        if b"".join(rest) not in (b"", end):
            raise ValueError("an archive ends inside a record")

    for batch in batches:
        rows = []
        for piece, archive in zip(batch["value"], batch["archive"], strict=True):
            if archive != current:
                whole()
                rest, have, need, current = [], 0, 0, archive
            rest += [bytes(piece), end]
            have += len(piece) + 4
            while have and have >= need:
                data = b"".join(rest)
                if not need:
                    if data == end:
                        break
                    head = data.index(end)
                    if not data.startswith(b"WARC/"):
                        raise ValueError("an archive's record does not begin where the one before ends")
                    need = head + 4 + int(data[:head].rsplit(b"Content-Length: ", 1)[1]) + 4
                if have >= need:
                    rows.append((*parse_record(data[: need - 4]), archive))
                    data, need = data[need:], 0
                rest, have = [data], len(data)
        if rows:
            yield pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})
    whole()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives in `path`."""
    lines = spark.read.option("lineSep", CRLF + CRLF).text(path)
    pieces = lines.select(F.encode("value", "UTF-8").alias("value"), F.col("_metadata.file_name").alias("archive"))
    return pieces.mapInPandas(_parsed, RECORD)


def resolved(recs: DataFrame) -> DataFrame:
    """records with payload_bytes and refers_to of revisits taken from the responses, found by digest."""
    heads = stored(recs.select("page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "archive"), "resolved")
    responses = heads.filter("record_type = 'response'").select("payload_digest", F.col("page_id").alias("at"), F.col("payload_bytes").alias("size"))
    revisits = heads.filter("record_type = 'revisit'")
    counted = revisits.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("copies"))
    known = stored(responses.join(counted, "payload_digest"), "revisited")
    found = join_counted(revisits, known, "payload_digest", "copies")
    return heads.filter("record_type = 'response'").unionByName(
        found.select("page_id", "url", "record_type", "payload_digest", F.col("size").alias("payload_bytes"), F.col("at").alias("refers_to"), "archive")
    )


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to deduplicated archives, read back and resolved."""
    path = shared_dir(spark, "archives")
    write_archives(records(table(spark, sf_dir, "pages").select("page_id", "url", "html")), path)
    return resolved(read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive"
    ).drop("archive")


def oracle_sql() -> str:
    """DuckDB SQL for op3."""
    digits = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * i + 1}, 5))::INT >> {s}) & 31) + 1, 1)"
        for i in range(8)
        for s in (15, 10, 5, 0)
    )
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, {digits} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""
