"""WARC archives: writing page captures, replacing repeated payloads by revisits, reading back."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hearthwatt.llm.frames import find_package, new_path, stored

#: Fixed values of the format.
VERSION = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
DIGITS_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
LETTERS_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Captures have no date of their own here.
DATE = "2024-01-01T00:00:00Z"
ROWS_OUT = 256


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32, in 40-bit steps: ten hexadecimal digits, eight letters."""
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), DIGITS_32, LETTERS_32)


def with_payload(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.col(url_col), r"[\x00-\x20\x7F]", "").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        base32_sha1(payload).alias("digest"),
    )


def repeated_payloads(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``digest`` and ``original``, the largest page id, of payloads of ``min_bytes`` or more
    that several records have. Copies are counted within each task before the shuffle."""
    large = headers.where(F.col("bytes") >= min_bytes)
    counted = large.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    return counted.where("n > 1").select("digest", "original")


def record() -> Column:
    """One WARC record without its closing line ends; a revisit has the HTTP head only."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(RECORD_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    head = F.concat_ws(
        "\r\n",
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit(f"WARC-Record-ID: <{RECORD_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{RECORD_ID}"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), size.cast("string")),
    )
    return F.concat(F.lit(VERSION), head, F.lit(RECORD_END), block)


def write_warc(
    pages: DataFrame,
    path: str,
    min_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Write a record per row into gzipped WARC files under ``path``, each payload once.

    Of the records with equal payloads of at least ``min_bytes`` bytes the one with the largest
    id is a response, the others revisit it. Headers alone are shuffled to find these; pages
    then meet the few repeated digests, and a digest with very many pages is split by adaptive
    execution. A null payload is empty, a null URL gives no such header. Rows that repeat the
    largest id are responses all; a null id revisits, unless no row of its payload has an id:
    such rows are responses. Control characters and spaces in a URL are dropped.
    """
    captured = with_payload(pages, id_col, url_col, html_col)
    known = stored(repeated_payloads(captured.select("page_id", "bytes", "digest"), min_bytes), "digests")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    resolved = captured.join(known, "digest", "left").withColumn("refers_to", refers)
    resolved.select(record().alias("value")).write.option("lineSep", RECORD_END).option(
        "compression", "gzip"
    ).text(path)


def _parsed(text: str) -> tuple[dict[str, str], str]:
    """Headers of a record, and its block as far as the text goes."""
    head, _, rest = text.partition(RECORD_END)
    return dict(line.split(": ", 1) for line in head.split("\r\n") if ": " in line), rest


def _size(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def records(parts: Iterator[str]) -> Iterator[tuple[dict[str, str], str]]:
    """Headers and block of each record, from parts cut at every record's end that a version line
    follows. A block of many parts is put together once, when it has its stated length."""
    headers: dict[str, str] = {}
    held: list[str] = []
    missing = 0
    for part in parts:
        if held:
            part = RECORD_END + VERSION + part
        else:
            headers, part = _parsed(part.removeprefix(VERSION))
            missing = int(headers["Content-Length"])
        held.append(part)
        missing -= _size(part)
        if missing <= 0:
            block = "".join(held)
            # What is too much ends the file.
            yield headers, block.encode()[:missing].decode() if missing else block
            held = []
    if held:
        raise ValueError("an archive ends within a record")


def _row(headers: dict[str, str], block: str, with_bytes: bool) -> tuple:
    http, _, body = block.partition(RECORD_END)
    payload = body.encode()
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    size = int(http.rpartition("Content-Length: ")[2])
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    number = lambda name: int(headers[name].strip("<>").removeprefix(RECORD_ID) or -1) if name in headers else None
    page = headers["WARC-Record-ID"].strip("<>").removeprefix(RECORD_ID)
    return (
        int(page) if page else None,
        headers.get("WARC-Target-URI"),
        size,
        digest,
        kind,
        number("WARC-Refers-To"),
        payload if with_bytes and kind == "response" else None,
    )


def read_warc(spark: SparkSession, path: str, with_bytes: bool = True) -> DataFrame:
    """The records under ``path``, in columns; responses are checked against their digest.

    Files are cut where a record's end is followed by a version line. A payload may hold that
    too, so parts are put together again until a block has its stated length. A gzipped file
    is read by one task from start to end, one record at a time.
    """
    find_package(spark)
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, payload binary"
    )
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for headers, block in records(part for batch in batches for part in batch.column(0).to_pylist()):
            rows.append(_row(headers, block, with_bytes))
            if len(rows) >= ROWS_OUT:
                yield pa.RecordBatch.from_pylist([dict(zip(target.names, r, strict=True)) for r in rows], schema=target)
                rows = []
        yield pa.RecordBatch.from_pylist([dict(zip(target.names, r, strict=True)) for r in rows], schema=target)

    parts = spark.read.option("lineSep", RECORD_END + VERSION).text(path)
    return parts.select("value").mapInArrow(run, schema)


def warc_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive the pages and read the archives back: a row per record, without payloads."""
    path = new_path(pages.sparkSession, "warc")
    write_warc(pages, path, min_bytes)
    return read_warc(pages.sparkSession, path, with_bytes=False).drop("url", "payload")
