"""WARC archives: writing captures, reading records back, assembling transactions.

A capture is a request, a response (or a revisit of an equal earlier payload) and a
metadata record; the request and the metadata name the response in WARC-Concurrent-To.

Writing: every record becomes one string and Spark's text writer, with the blank lines
that end a record as its line separator and gzip as its codec, writes the archives. A
payload goes through one shuffle at most, that of the join with the list of revisits.

Reading: the text reader cuts a gzip archive, in order and in one task, at the same
separator; payloads may hold it too, so a parser in the task puts the cuts back and goes
by Content-Length alone. It holds one record at a time. A transaction is then joined from
its records by identifier, and revisits look up the response they refer to.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from edgelog.llm import shared

VERSION = "WARC/1.1"
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
#: Payloads from this many bytes on are stored once.
REVISIT_BYTES = 1000
#: Records in one archive file at most.
FILE_RECORDS = 20_000
#: Fixed value of the standard: the profile of a revisit of an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The tables hold no time of capture; all records carry this one.
CAPTURED = "2024-01-01T00:00:00Z"

RECORD = "kind string, id string, concurrent_to string, refers_to string, uri string, page_id string, payload_digest string, payload_bytes long, payload binary"


def _uuid(kind: str, *parts: Column) -> Column:
    """A stable identifier made of a digest of what the record stands for."""
    h = F.sha2(F.concat_ws("\x00", F.lit(kind), *parts).cast("binary"), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _clean(value: Column) -> Column:
    """A header value on one line; line breaks in it become percent codes."""
    return F.replace(F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record(fields: list[tuple[str, Column]], body: Column) -> Column:
    """Header lines and body, without the blank lines that end a record."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields]
    size = F.octet_length(body).cast("string")
    return F.concat(F.lit(VERSION + CRLF), *lines, F.lit("Content-Length: "), size, F.lit(CRLF + CRLF), body)


def captures(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload`` and what tells equal payloads: digests and size."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    held = pages.select("page_id", "url", payload.alias("payload"))
    return held.select(
        "*", F.sha1(F.col("payload").cast("binary")).alias("sha1"), F.sha2(F.col("payload").cast("binary"), 256).alias("sha256"),
        F.octet_length("payload").cast("long").alias("size"),
    )


def kept_payloads(found: DataFrame) -> DataFrame:
    """``sha256, kept_id, kept_url`` of payloads that several captures share and one of them stores."""
    large = found.filter((F.col("size") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).groupBy("sha1", "sha256", "size")
    kept = F.max(F.struct("page_id", "url")).alias("kept")
    return large.agg(kept, F.count("*").alias("n")).filter("n > 1").select("sha256", F.col("kept.page_id").alias("kept_id"), F.col("kept.url").alias("kept_url"))


def write(pages: DataFrame, folder: str) -> None:
    """Archives of ``pages`` (``page_id, url, html``) as gzip files in ``folder``.

    Null html is an empty payload, a null url an empty one. Of equal payloads of at least
    ``REVISIT_BYTES`` bytes, the largest ``page_id`` is stored as a response, the others as
    revisits of it. Rows that repeat that id are responses as well; rows without an id
    are responses and are never referred to. An empty table leaves a folder without records.
    """
    found = captures(pages)
    known = shared.stored(kept_payloads(found), "payloads")
    placed = found.join(known, "sha256", "left")
    page, url = F.coalesce(F.col("page_id").cast("string"), F.lit("")), _clean(F.col("url"))
    this = (page, url, F.col("sha256"))
    revisit = F.col("page_id").isNotNull() & (F.col("page_id") != F.col("kept_id"))
    base = [("WARC-Date", F.lit(CAPTURED)), ("WARC-Target-URI", url), ("X-Page-Id", page)]
    of_this = [*base, ("WARC-Concurrent-To", _uuid("response", *this))]
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}")
    main = [
        ("WARC-Record-ID", _uuid("response", *this)), *base, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
    ]
    refers_to = _uuid("response", F.col("kept_id").cast("string"), _clean(F.col("kept_url")), F.col("sha256"))
    response = _record([("WARC-Type", F.lit("response")), *main], F.concat(http, F.col("payload")))
    again = _record([("WARC-Type", F.lit("revisit")), *main, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", refers_to)], http)
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uuid("request", *this)), *of_this, ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), url, F.lit(f" HTTP/1.1{CRLF}{CRLF}")),
    )
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uuid("metadata", *this)), *of_this, ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("payload-bytes: "), F.col("size").cast("string"), F.lit(CRLF)),
    )
    records = placed.select(F.explode(F.array(request, F.when(revisit, again).otherwise(response), metadata)).alias("value"))
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(folder)


class Parser:
    """Records from the bytes of one archive, fed in any cuts."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.held = 0
        self.wanted = 1  # bytes below which looking again is useless

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.parts.append(data)
        self.held += len(data)
        if self.held < self.wanted:
            return
        whole, at = b"".join(self.parts), 0
        while True:
            while whole.startswith(b"\r\n", at):
                at += 2
            head = whole.find(b"\r\n\r\n", at)
            if head < 0:
                self.wanted = len(whole) - at + 1
                break
            fields = self._fields(whole[at:head])
            end = head + 4 + int(fields["content-length"])
            if len(whole) < end:
                self.wanted = end - at
                break
            yield fields, whole[head + 4 : end]
            at = end
        self.parts, self.held = [whole[at:]], len(whole) - at

    @staticmethod
    def _fields(head: bytes) -> dict[str, str]:
        lines = head.decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record starts with {lines[0][:40]!r}")
        return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}

    def end(self) -> None:
        if b"".join(self.parts).strip(b"\r\n"):
            raise ValueError("an archive ends inside a record")


def _row(fields: dict[str, str], body: bytes) -> tuple:
    kind = fields.get("warc-type", "")
    payload: bytes | None = None
    if kind == "response":
        payload = body.partition(b"\r\n\r\n")[2]
    elif kind == "metadata":
        payload = body
    digest = fields.get("warc-payload-digest", "").partition(":")[2] or None
    size = len(payload) if kind == "response" else None
    return (
        kind, fields.get("warc-record-id"), fields.get("warc-concurrent-to"), fields.get("warc-refers-to"),
        fields.get("warc-target-uri"), fields.get("x-page-id"), digest, size, payload,
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all gzip archives in ``folder``: columns of ``RECORD``.

    A revisit has no payload of its own. A file that ends inside a record, or holds
    anything but records, is an error and not passed over.
    """
    pieces = spark.read.option("lineSep", RECORD_END).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"),
    )
    arrow = to_arrow_schema(T.StructType.fromDDL(RECORD))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, parser = None, Parser()
        for batch in batches:
            rows = []
            for name, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name != file:
                    parser.end()
                    file, parser = name, Parser()
                rows += [_row(*record) for record in parser.feed(piece.as_py() + RECORD_END.encode())]
            columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        parser.end()

    return pieces.mapInArrow(parse, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One row per capture: ``id`` and the nested records ``request``, ``response``, ``metadata``.

    Requests and metadata join the response or revisit they are concurrent to. A response
    without one keeps a null there; a request or metadata whose response is missing gives
    no capture. Captures that repeat a record stay apart as often as they are written.
    """
    parts = F.struct("id", "uri", "page_id", "payload")
    sides = records.filter(F.col("kind").isin("request", "metadata")).groupBy(F.col("concurrent_to").alias("of"))
    sides = sides.agg(
        F.first(F.when(F.col("kind") == "request", parts), ignorenulls=True).alias("request"),
        F.first(F.when(F.col("kind") == "metadata", parts), ignorenulls=True).alias("metadata"),
    )
    main = records.filter(F.col("kind").isin("response", "revisit"))
    response = F.struct("kind", "id", "uri", "page_id", "refers_to", "payload_digest", "payload_bytes", "payload").alias("response")
    return main.select("id", response).join(sides, F.col("id") == F.col("of"), "left").select("id", "request", "response", "metadata")


def resolved(captured: DataFrame) -> DataFrame:
    """``transactions`` with ``source``: the stored response of each capture, its own or the one a revisit names."""
    revisits = captured.filter("response.kind = 'revisit'").withColumn("wanted", F.col("response.refers_to"))
    asked = revisits.select("wanted").distinct()
    own = captured.filter("response.kind = 'response'")
    named = own.join(asked, F.col("id") == F.col("wanted"), "left_semi").groupBy("id").agg(F.first("response").alias("source"))
    # written, so that the join's sides are plain shuffles and a response with many revisits can be split
    named = shared.stored(named.withColumnRenamed("id", "wanted"), "named")
    found = revisits.join(named, "wanted", "left").drop("wanted")
    return found.unionByName(own.withColumn("source", F.col("response")))


def report(pages: DataFrame) -> DataFrame:
    """Write the archives, read them back, and tell every page's payload and record."""
    folder, kind = shared.scratch(pages.sparkSession, "warc"), pages.schema["page_id"].dataType.simpleString()
    write(pages.select("page_id", "url", "html"), folder)
    # payloads are digested where they are read: only identifiers and sizes are joined
    read_back = read(pages.sparkSession, folder).withColumn("payload_digest", F.when(F.col("kind") == "response", F.sha1("payload")).otherwise(F.col("payload_digest")))
    records = shared.stored(read_back.withColumn("payload", F.lit(None).cast("binary")), "records")
    page = lambda of: F.when(F.col(f"{of}.page_id") != "", F.col(f"{of}.page_id")).cast(kind)
    return resolved(transactions(records)).select(
        page("response").alias("page_id"), F.col("source.payload_bytes").alias("payload_bytes"),
        F.col("source.payload_digest").alias("payload_digest"), F.col("response.kind").alias("record_type"),
        F.when(F.col("response.kind") == "revisit", page("source")).alias("refers_to"),
    )
