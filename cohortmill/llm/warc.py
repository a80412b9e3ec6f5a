"""WARC: archives written and read as Spark jobs, and transactions assembled from concurrent records.

Writing: each page gives a request, a response or revisit, and a metadata record; the last two point at each other by
``WARC-Concurrent-To``. The records go through Spark's text writer, whose line separator is the blank lines that end a
record, gzip-compressed, so the job commits like any other table and works on any store. Rows per file are chosen so that a
file holds about ``ARCHIVE_BYTES``.

Identical payloads: pages are grouped by payload digest (a small aggregate of ids, never of texts); of the pages with an
equal payload of at least ``MIN_REVISIT`` bytes that with the smallest id stores it, the others are revisits. Only digests
that occur twice join back to the pages, and Spark may split a hot one.

Reading: files are read whole by ``binaryFile`` and their records are taken one after the other from the decompressing
stream by Content-Length. Requests and metadata are reduced to one row per transaction before they are joined to the
responses, so a capture is one nested row whatever its records repeat.

Defined cases: null html is an empty payload; a null page_id is written without one and never stands for others; equal rows
have equal record ids and are captures each; records without a response give a capture without one; an archive cut inside a record raises an
error.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cohortmill.llm.staging import fresh_path, prepare, staged

MIN_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record(kind: str, record_id: Column, date: str, block: Column, *headers: Column) -> Column:
    length = F.octet_length(block).cast("string")
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), record_id),
             F.lit(f"WARC-Date: {date}"), *headers, F.concat(F.lit("Content-Length: "), length)]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def _uuid(*parts: Column) -> Column:
    hexed = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\0")) for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(hexed, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def first_of_payload(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(digest, first): for payloads of at least ``min_bytes`` that occur in several rows, the smallest page id."""
    return staged(
        pages.where(F.col("bytes") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n"),
        "payloads",
    )


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   date: str = "2024-01-01T00:00:00Z", min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes the records of all pages to a new folder ``path``. The crawl date is an argument; nothing reads the clock."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    named = pages.select(
        F.col(id_col).alias("page_id"),
        F.regexp_replace(F.col(url_col).cast("string"), r"[\r\n]+", "%20").alias("url"), html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"), F.octet_length(html).alias("bytes"),
    )
    size = named.agg(F.avg("bytes").alias("mean")).first()
    rows_per_file = max(1, int(archive_bytes / ((size["mean"] or 0) + 1000)))

    firsts = first_of_payload(named, min_revisit).withColumnRenamed("digest", "first_digest")
    decided = named.join(firsts, F.col("digest") == F.col("first_digest"), "left")
    stores = F.col("first").isNull() | F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))

    target = F.concat(F.lit("WARC-Target-URI: "), "url")
    response_id = _uuid(F.lit("response"), F.col("page_id"), F.col("digest"))
    own_id = F.when(stores, response_id).otherwise(_uuid(F.lit("revisit"), F.col("page_id"), F.col("digest")))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), own_id)
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest")
    http = F.lit("Content-Type: application/http; msgtype=response")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    request = _record(
        "request", _uuid(F.lit("request"), F.col("page_id"), F.col("digest")), date,
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")), target, concurrent,
        F.lit("Content-Type: application/http; msgtype=request"))
    response = _record("response", own_id, date, F.concat(head, "html"), target, digest, http)
    revisit = _record(
        "revisit", own_id, date, head, target, digest, F.lit(f"WARC-Profile: {PROFILE}"),
        F.concat(F.lit("WARC-Refers-To: "), _uuid(F.lit("response"), F.col("first"), F.col("digest"))), http)
    metadata = _record(
        "metadata", _uuid(F.lit("metadata"), F.col("page_id"), F.col("digest")), date,
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("page-id:\r\n")),
        target, concurrent, F.lit("Content-Type: application/warc-fields"))
    value = F.concat_ws(END, request, F.when(stores, response).otherwise(revisit), metadata)
    (decided.select(value.alias("value")).write.option("maxRecordsPerFile", rows_per_file).option("lineSep", END)
     .option("compression", "gzip").text(path))


RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("concurrent_to", T.ArrayType(T.StringType())),
    T.StructField("refers_to", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType()),
])
_ARROW = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("target", pa.string()), ("date", pa.string()),
    ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
])


def records_of(content: bytes) -> Iterator[dict]:
    """The records of one archive, in order. A revisit has the size and digest its headers state."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := stream.readline():
        if not line.strip():
            continue
        headers: list[tuple[str, str]] = []
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.append((name.strip().lower(), value.strip()))
        own = dict(headers)
        size = int(own["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record {own.get('warc-record-id')} is cut off")
        payload, http, fields = block, b"", {}
        if own.get("content-type", "").startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
        elif own.get("content-type") == "application/warc-fields":
            fields = dict(re.findall(r"(?m)^([^:\r\n]+):[ \t]*(.*?)\r?$", block.decode("utf-8", "replace")))
        length, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if own["warc-type"] == "revisit":
            stated = re.search(rb"(?i)^content-length:\s*(\d+)", http, re.M)
            length = int(stated[1]) if stated else None
            digest = own.get("warc-payload-digest", "").removeprefix("sha256:") or None
            payload = None
        yield {
            "record_id": own.get("warc-record-id"), "type": own["warc-type"], "target": own.get("warc-target-uri"),
            "date": own.get("warc-date"), "concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"],
            "refers_to": own.get("warc-refers-to"), "payload_bytes": length, "payload_digest": digest,
            "fields": list(fields.items()), "payload": payload,
        }


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record (``RECORD``); without ``payloads`` only their size and digest."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for record in records_of(content.as_py()):
                    held += record["payload_bytes"] or 0
                    rows.append(record if payloads else record | {"payload": None})
                    if len(rows) == 1000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One row per capture: record_id, target, date, response (type, payload size, digest and payload, refers_to),
    requests and metadata (arrays of structs). Concurrent records name the response, or the response names them."""
    responses = records.where(F.col("type").isin("response", "revisit", "resource"))
    others = records.where(F.col("type").isin("request", "metadata"))
    # The transaction of a record: the response it names; else the response that names it; else the response of the
    # record it names; else itself.
    named = responses.select("record_id", F.explode("concurrent_to").alias("other"))
    backward = named.groupBy("other").agg(F.min("record_id").alias("of")).withColumnRenamed("other", "record_id")
    ids = responses.select(F.col("record_id").alias("of")).distinct()
    part = F.struct("record_id", "type", "target", "date", "payload_bytes", "payload_digest", "fields")
    linked = others.withColumn("link", F.explode_outer(F.when(F.size("concurrent_to") > 0, F.col("concurrent_to"))))
    direct = linked.join(ids, F.col("link") == F.col("of"), "left").select("record_id", "link", "of")
    resolved = staged(
        direct.join(backward.withColumnRenamed("of", "back"), "record_id", "left")
        .select("record_id", "link", F.coalesce("of", "back").alias("of"))
        .groupBy("record_id").agg(F.min("of").alias("of"), F.min("link").alias("link")),
        "resolved",
    )
    hop = resolved.select(F.col("record_id").alias("link"), F.col("of").alias("hop"))
    owner = staged(
        resolved.join(hop, "link", "left").select("record_id", F.coalesce("of", "hop", "link", "record_id").alias("capture")),
        "owners",
    )
    grouped = (
        others.join(owner, "record_id").withColumn("part", part.dropFields("fields").withField("fields", F.map_entries("fields")))
        .groupBy("capture").agg(
            F.sort_array(F.collect_set(F.when(F.col("type") == "request", F.col("part")))).alias("requests"),
            F.sort_array(F.collect_set(F.when(F.col("type") == "metadata", F.col("part")))).alias("metadata"),
        )
    )
    nested = responses.select(
        F.col("record_id").alias("capture"), "target", "date",
        F.struct("type", "payload_bytes", "payload_digest", "refers_to", "payload").alias("response"),
    )
    return nested.join(grouped, "capture", "full").withColumnRenamed("capture", "record_id")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               payloads: bool = False) -> DataFrame:
    """The captures of archives written from ``pages``, with the page id that their metadata states."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col)
    captures = transactions(staged(read_archives(spark, path, payloads), "records"))
    fields = F.map_from_entries(F.element_at("metadata", 1)["fields"])
    stated = F.when(fields["page-id"] != "", fields["page-id"])
    return captures.withColumn("page_id", stated.cast(pages.schema[id_col].dataType))
