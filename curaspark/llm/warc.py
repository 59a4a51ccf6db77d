"""WARC archives without repeated payloads: writing, revisit resolution, reading."""

from __future__ import annotations

import hashlib
import math
import urllib.parse
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _written, materialize, repeatable, scratch_dir, with_rid

#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 1000
#: Payload bytes of an archive file on average, and records at most; smaller inputs are spread over the cores in files of at least
#: SMALL_BYTES. Files are read whole by a task, compressed.
FILE_BYTES, SMALL_BYTES, FILE_RECORDS = 64 << 20, 4 << 20, 50_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id string, record_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to_id string, payload binary"


def records(pages: DataFrame) -> DataFrame:
    """(rid, page_id, url, payload, payload_bytes, payload_digest) of pages (page_id, url, html); a null html is empty."""
    p = with_rid(repeatable(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))), "rid")
    return p.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1(F.encode("payload", "UTF-8")))


def revisits(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(rid, refers_rid, refers_to, refers_url) of the records whose payload another record holds: of equal payloads of at least
    least_bytes the largest page_id (then rid) is the original. Only headers are shuffled; a digest of very many records is counted
    by partial aggregates, and joined only if it repeats, from a table of its own, so that its rows can be split."""
    h = headers.select("rid", "page_id", "url", "payload_digest", "payload_bytes").where(F.col("payload_bytes") >= least_bytes)
    original = F.max(F.struct("page_id", "rid", "url"))
    groups = materialize(h.groupBy("payload_digest", "payload_bytes").agg(original.alias("o"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return (
        h.drop("url").join(groups, ["payload_digest", "payload_bytes"])
        .where(F.col("rid") != F.col("o.rid"))
        .select("rid", F.col("o.rid").alias("refers_rid"), F.col("o.page_id").alias("refers_to"), F.col("o.url").alias("refers_url"))
    )


def _record_id(rid) -> Column:
    h = F.md5(F.concat(F.lit("record:"), rid.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(pages: DataFrame, path: str | None = None, *, least_bytes: int = LEAST_BYTES, date: str | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Write pages as gzip-compressed WARC/1.1 files and return their folder (in the shared scratch folder by default).

    A record per row: a response with its payload, or a revisit that refers to the response of the same payload (see
    revisits). Headers are made afresh, with the SHA-1 of the payload in hex and `date` (the time of the call by default), those of
    revisits with the target and date of what they refer to. Records are dealt by row id into files of about `file_bytes` of payload.
    Spark's own writer makes the files, so any file system that Spark writes will do; CR LF CR LF after each record is its line end,
    and a file is one gzip member. Control characters and spaces in a url become %20, a page_id is written as text in URL encoding;
    a null url or page_id is left out of the headers.
    """
    spark = pages.sparkSession
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    r = records(pages)
    path = path or scratch_dir(spark)
    size = r.agg(F.sum("payload_bytes")).first()[0] or 0
    files = max(1, math.ceil(size / file_bytes), min(spark.sparkContext.defaultParallelism, math.ceil(size / SMALL_BYTES)))
    # Payloads are dealt once, together with the rows of revisits (no payload). A join would have at least spark.sql.shuffle.partitions
    # partitions, and where Spark turns it into another one while it runs, payloads would be dealt again into `files`.
    seen = revisits(r, least_bytes).select("rid", "refers_rid", "refers_url")
    dealt, record = r.unionByName(seen, allowMissingColumns=True).repartition(files, "rid"), Window.partitionBy("rid")
    joined = dealt.withColumns({c: F.max(c).over(record) for c in ("refers_rid", "refers_url")}).where("payload IS NOT NULL")
    revisit = F.col("refers_rid").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n")
    )
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))

    def uri(url: str) -> Column:
        return F.regexp_replace(url, r"[\x00-\x20\x7F]", "%20")

    def line(name: str, value) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))

    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("rid"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_rid")))),
        line("WARC-Refers-To-Target-URI", F.when(revisit, uri("refers_url"))),
        line("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("X-Page-Id", F.url_encode(F.col("page_id").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    joined.select(F.concat(head, body).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(path)
    _written.append(path)
    return path


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of the records in an uncompressed WARC stream; names are lower-cased. The stream is read record by
    record by its content lengths, so a payload may hold anything. The payload is what follows the HTTP headers."""
    held = bytearray()
    chunks = iter(chunks)

    def fill(enough) -> bool:
        while not enough():
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(lambda: b"\r\n\r\n" in held):
        end = held.index(b"\r\n\r\n")
        first, *lines = bytes(held[:end]).decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record: {first[:40]!r}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers["content-length"])
        stop = end + 4 + size + 4
        if not fill(lambda: len(held) >= stop):
            raise ValueError("the archive ends within a record")
        block = bytes(held[end + 4 : stop - 4])
        del held[:stop]
        yield headers, block.partition(b"\r\n\r\n")[2]
    if held.strip():
        raise ValueError("the archive ends within a record")


def _unzip(data: memoryview, step: int = 1 << 16) -> Iterator[bytes]:
    """The contents of gzip members, a piece at a time."""
    d = zlib.decompressobj(31)
    for at in range(0, len(data), step):
        piece = bytes(data[at : at + step])
        while piece:
            if d.eof:
                d = zlib.decompressobj(31)
            yield d.decompress(piece)
            piece = d.unused_data


def _reader(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for h, payload in parse(_unzip(memoryview(content.as_buffer()))):
                    stored = h["warc-type"] == "response"
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    if stored and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {h['warc-record-id']} doesn't match its digest")
                    page = urllib.parse.unquote_plus(h["x-page-id"]) if "x-page-id" in h else None
                    rows.append((page, h["warc-record-id"], h.get("warc-target-uri"), h["warc-type"], len(payload) if stored else None, digest, h.get("warc-refers-to"), payload if with_payload and stored else None))
                    size += len(payload) if with_payload else 200
                    if size >= 4 << 20:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    return read


def read_archives(spark, path: str, *, with_payload: bool = True) -> DataFrame:
    """The records of the archives in a folder (schema RECORD), their digests verified; what a revisit lacks is null."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_reader(with_payload), RECORD)


def resolve(recs: DataFrame, id_type: str = "string") -> DataFrame:
    """Join revisits with their originals: (page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload), payload only if
    recs has any to give. A revisit whose original is missing keeps nulls. Responses refer to nothing and are not joined but united
    with the joined revisits; both sides of that join come from the archives, so a response that very many refer to can be split."""
    page = F.col("page_id").cast(id_type)
    stored = recs.where("record_type <> 'revisit'")
    own = stored.select(page.alias("page_id"), "url", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast(id_type).alias("refers_to"), "payload")
    originals = stored.select(F.col("record_id").alias("o_id"), page.alias("o_page"), F.col("payload_bytes").alias("o_bytes"), F.col("payload").alias("o_payload"))
    joined = recs.where("record_type = 'revisit'").join(originals, F.col("refers_to_id") == F.col("o_id"), "left")
    return own.union(
        joined.select(
            page.alias("page_id"),
            "url",
            F.col("o_bytes").alias("payload_bytes"),
            "payload_digest",
            "record_type",
            F.col("o_page").alias("refers_to"),
            F.col("o_payload").alias("payload"),
        )
    )


def archive_and_read(pages: DataFrame, *, with_payload: bool = False, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """pages through archives and back: (page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload).

    A page_id may be of any type that text can be cast to and from. Null page_ids stay null and count as smallest, urls come back
    as written in the headers; rows that repeat are records of their own, of which one is the response; an empty table gives no
    rows. Other columns are not archived.
    """
    path = write_archives(pages, least_bytes=least_bytes)
    recs = materialize(read_archives(pages.sparkSession, path, with_payload=with_payload))
    return resolve(recs, pages.schema["page_id"].dataType.simpleString())
