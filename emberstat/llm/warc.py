"""WARC archives without repeated payloads.

Headers (id, size and SHA-1 of the payload) are shuffled by payload digest; the
payloads are not. Of the records with equal payloads one is the original
response, the others become revisit records that refer to it. Spark's text
writer writes the archives, a gzip file for each partition, to any store that
Spark reaches: a record is one string, and the two line ends that close a record
are the writer's line separator. Reading parts the files at the version line;
a record is as long as its ``Content-Length`` says, so a payload may hold
anything. Revisits are then joined to the original responses by record id.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from datetime import datetime, timezone
from typing import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checked_broadcast, join_groups, small_batches, stage

VERSION, END = "WARC/1.1\r\n", "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, record_type string, refers_to_id string, page_id string, url string, date string, payload_bytes long, "
          "payload_digest string, payload string, intact boolean")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a text's UTF-8 bytes: 40 bits are 8 digits."""
    def digits(k: int) -> Column:
        octal = F.lpad(F.conv(F.substring(F.sha1(payload.cast("binary")), 10 * k + 1, 10), 16, 32), 8, "0")
        return F.translate(octal, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    return F.concat(*[digits(k) for k in range(4)])


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value. Line ends in a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")))


def resolve_payloads(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The revisits among ``headers`` (rid, id, size, digest, record_id): ``rid`` and ``refers_to`` (record id of the
    original: of equal payloads of at least ``least_bytes`` the one with the largest id, nulls below all, then the last in
    the input). ``headers`` are staged."""
    of = F.struct("id", "rid", "record_id")
    groups = headers.filter(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.max(of).alias("original"), F.count("*").alias("rows"))
    groups = stage(groups.filter("rows > 1").select("digest", "rows", F.col("original.rid").alias("first"), F.col("original.record_id").alias("refers_to")), "originals")
    met = join_groups(headers.filter(F.col("size") >= least_bytes).select("rid", "digest"), groups, "digest", "rows", 128)
    return met.filter("rid != first").select("rid", "refers_to")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   least_bytes: int = 0, written: datetime | None = None) -> None:
    """Write a record for each row of ``pages`` to gzip archives below ``path``.

    Payload: UTF-8 of the text, null counts as empty. Equal payloads of at least ``least_bytes`` bytes are written once,
    as a response; the others become revisits with fresh headers. Repeated rows are records of their own. A null id or URL
    leaves its header out. An empty table gives an empty folder. Other columns are not written. Revisits whose ids don't fit
    a broadcast meet the rows in a shuffle join by record number, which deals the payloads out once, evenly.
    """
    small_batches(pages.sparkSession)
    date = (written or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"))
    h = F.md5(F.concat_ws(":", F.lit(uuid.uuid4().hex), "rid"))
    record_id = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    rows = stage(rows.select("*", F.octet_length("payload").cast("long").alias("size"), base32_sha1(F.col("payload")).alias("digest"),
                             F.concat(F.lit("<urn:uuid:"), record_id, F.lit(">")).alias("record_id")), "pages")
    revisits = stage(resolve_payloads(rows.select("rid", "id", "size", "digest", "record_id"), least_bytes), "revisits")
    rows = rows.join(checked_broadcast(revisits, 96), "rid", "left")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "size", F.lit(END))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    head = F.concat(F.lit(VERSION), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), _line("WARC-Record-ID", F.col("record_id")),
                    _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("url")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
                    _line("WARC-Profile", F.when(revisit, REVISIT)), _line("WARC-Refers-To", F.col("refers_to")),
                    _line("Page-Id", F.url_encode(F.col("id").cast("string"))), _line("Content-Type", F.lit("application/http; msgtype=response")),
                    _line("Content-Length", block.cast("string")), F.lit("\r\n"), http)
    record = rows.select(F.concat(head, F.when(revisit, "").otherwise(F.col("payload"))).alias("value"))
    record.write.option("lineSep", END).option("compression", "gzip").text(path)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of archives between version lines, file by file in order, to records."""
    start, between, end = VERSION.encode(), f"{END}{VERSION}".encode(), END.encode()
    parts: list[bytes] = []  # the record that is not complete yet, from behind its version line
    have = need = 0
    for batch in batches:
        out: list[tuple] = []
        for piece in batch.column(0):
            piece = piece.as_buffer().to_pybytes()
            parts += [between, piece] if parts else [piece.removeprefix(start)]
            have += sum(len(p) for p in parts[-2:]) if len(parts) > 1 else len(parts[0])
            while parts and have >= need:
                data = b"".join(parts)
                head = data.find(end)
                if head < 0:
                    raise ValueError("a record without the end of its header")
                fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in data[:head].decode().split("\r\n"))}
                need = head + len(end) + int(fields["content-length"])
                if len(data) < need:
                    parts = [data]
                    break
                out.append(_record(fields, data[head + len(end) : need]))
                rest = data[need:]
                if not rest or rest == end:
                    parts = []
                elif rest.startswith(between):  # the payload's end looked like a part of the separator
                    parts = [rest.removeprefix(between)]
                else:
                    raise ValueError("a record longer than its Content-Length")
                have, need = sum(map(len, parts)), 0
        yield pa.RecordBatch.from_pylist(out, _SCHEMA)
    if parts:
        raise ValueError("an archive ends within a record")


_SCHEMA = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to_id", pa.string()), ("page_id", pa.string()), ("url", pa.string()),
                     ("date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.string()), ("intact", pa.bool_())])


def _record(fields: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(END.encode())
    told = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode().split("\r\n")[1:])}
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    response = fields["warc-type"] == "response"
    page = fields.get("page-id")
    return {"record_id": fields["warc-record-id"], "record_type": fields["warc-type"], "refers_to_id": fields.get("warc-refers-to"),
            "page_id": None if page is None else unquote(page.replace("+", " ")), "url": fields.get("warc-target-uri"), "date": fields["warc-date"],
            "payload_bytes": len(payload) if response else int(told["content-length"]), "payload_digest": digest, "payload": payload.decode() if response else None,
            "intact": base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest if response else None}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path`` (gzip files, so each is read by one task from its start): the columns of
    ``RECORD``. ``payload`` is null for revisits; ``payload_bytes`` and ``payload_digest`` are of the full payload; ``intact``
    tells whether a response's payload has the digest of its header. A file that breaks off raises an error."""
    small_batches(spark)
    pieces = spark.read.schema("value string").option("lineSep", f"{END}{VERSION}").text(path)
    return pieces.mapInArrow(_records, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Headers of ``read_archives`` (no payloads) with ``refers_to``: the page id of the original response of each revisit
    (null for responses, and where the original has no id or is not there)."""
    headers = stage(records.drop("payload", "date"), "records")
    revisits = headers.filter("record_type = 'revisit'")
    wanted = stage(revisits.groupBy(F.col("refers_to_id").alias("record_id")).agg(F.count("*").alias("rows")), "wanted")
    originals = headers.filter("record_type = 'response'").select("record_id", F.col("page_id").alias("refers_to"))
    known = stage(wanted.join(originals, "record_id", "left").withColumnRenamed("record_id", "refers_to_id"), "known")
    met = join_groups(revisits, known, "refers_to_id", "rows", 96).drop("rows")
    return headers.filter("record_type != 'revisit'").withColumn("refers_to", F.lit(None).cast("string")).unionByName(met)
