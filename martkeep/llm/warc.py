"""WARC archives: records written by Spark's text writer, read back and joined to captures."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeep.llm.common import staged

VERSION = b"WARC/1.1"
CRLF = b"\r\n"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROWS_PER_FILE = 4000  # captures per archive, at most
FILE_BYTES = 256 << 20  # payload per archive, at most, but for a single larger one
LARGE = FILE_BYTES // ROWS_PER_FILE  # larger payloads go to archives of their own
PIECE = 1 << 20  # bytes of an archive that are unpacked at once

RECORD_TYPE = (
    "record_id string, record_type string, concurrent_to string, refers_to string, uri string, "
    "headers map<string,string>, block_bytes long, payload_bytes long, payload_digest string, block binary"
)


def record_id(*parts: object) -> str:
    """A record's id: the same for the same parts, so that a repeated task writes the same."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, '/'.join(map(str, parts)))}>"


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, without a prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, id_: str, block: bytes, **fields: str | None) -> bytes:
    """One record but for its final two line ends, which the writer puts between rows."""
    lines = [VERSION, b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: " + id_.encode()]
    for name, value in fields.items():
        if value is not None:
            clean = "".join(" " if c in "\r\n" else c for c in value)
            lines.append(f"{name.replace('_', '-')}: {clean}".encode("utf-8", "surrogatepass"))
    lines.append(f"Content-Length: {len(block)}".encode())
    return CRLF.join(lines) + CRLF * 2 + block


def unpacked(data: bytes) -> Iterator[bytes]:
    """Pieces of an archive, plain or gzip in one member or many, as it is unpacked."""
    at, member = 0, None
    while at < len(data) or member is not None:
        if member is None:
            if data[at : at + 2] != b"\x1f\x8b":
                yield from (data[i : i + PIECE] for i in range(at, len(data), PIECE))
                return
            member = zlib.decompressobj(31)
        piece = data[at : at + PIECE] if not member.unconsumed_tail else b""
        at += len(piece)
        packed = member.unconsumed_tail + piece
        out = member.decompress(packed, PIECE)
        if out:
            yield out
        if member.eof:
            at -= len(member.unused_data)
            member = None
        elif not packed and not out:
            raise ValueError("a gzip member is cut off")


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive.

    Records are found by Content-Length, so blocks may hold anything. Archives may be
    plain or gzip, in one member or many; they are unpacked piece by piece, so no more than
    a record is held besides the archive itself. A damaged rest of an archive is an error.
    """
    pieces, held, at = unpacked(data), bytearray(), 0  # at: bytes of records already given

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while held[:2] == CRLF or (len(held) < 5 and more()):
            if held[:2] == CRLF:
                del held[:2]
                at += 2
        if not held:
            return
        while (end := held.find(CRLF * 2)) < 0 and held.startswith(b"WARC/") and more():
            pass
        if not held.startswith(b"WARC/") or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        headers: dict[str, str] = {}
        last = None
        for line in bytes(held[:end]).split(CRLF)[1:]:
            if line[:1] in (b" ", b"\t") and last:  # a folded header goes on
                headers[last] += " " + line.strip().decode("utf-8", "replace")
                continue
            name, _, value = line.partition(b":")
            last = name.strip().decode("ascii", "replace").lower()
            headers[last] = value.strip().decode("utf-8", "replace")
        start, stop = end + 4, end + 4 + int(headers["content-length"])
        while len(held) < stop and more():
            pass
        if len(held) < stop:
            raise ValueError(f"record at byte {at} is cut off")
        yield headers, bytes(held[start:stop])
        del held[:stop]
        at += stop


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without its HTTP headers, where it has any."""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(CRLF * 2)[2]
    return block


def http_block(payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


def digests(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``payload_bytes`` and ``payload_digest``."""

    @F.arrow_udf(T.StringType())
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([digest(t) for t in texts.cast(pa.binary()).to_pylist()], pa.string())

    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    occurrence = F.col("occurrence") if "occurrence" in pages.columns else F.lit(None).cast("long").alias("occurrence")
    return pages.select("page_id", "url", occurrence, html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), of(html).alias("payload_digest"))


def _records(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        out = []
        for page_id, url, occurrence, html, size, sha, original in zip(*(c.to_pylist() for c in batch.columns)):
            key = (page_id, occurrence, sha, repr(url))  # a NULL url is none of that name
            main = record_id("main", *key)
            uri = url or "urn:none"
            common = {"WARC_Target_URI": uri, "WARC_Date": "2024-01-01T00:00:00Z"}
            request = b"GET / HTTP/1.1" + CRLF * 2
            out.append(record("request", record_id("request", *key), request, WARC_Concurrent_To=main,
                              Content_Type="application/http;msgtype=request", **common))
            http = {"Content_Type": "application/http;msgtype=response", "WARC_Payload_Digest": f"sha1:{sha}"}
            if original is None:
                out.append(record("response", main, http_block(html), **common, **http))
            else:
                out.append(record("revisit", main, b"HTTP/1.1 200 OK" + CRLF * 2, WARC_Profile=REVISIT,
                                  WARC_Refers_To=record_id("main", original["page_id"], None, sha, repr(original["url"])), **common, **http))
            notes = f"page-id: {'' if page_id is None else page_id}\r\n".encode()
            out.append(record("metadata", record_id("metadata", *key), notes, WARC_Concurrent_To=main,
                              Content_Type="application/warc-fields", **common))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Write request, response or revisit, and metadata records of ``pages`` to ``folder``.

    Of pages with equal payloads of at least ``least`` bytes, that with the smallest
    page_id is written whole (under all its urls; the first is referred to), the others as
    revisits of it. The records go through
    Spark's text writer, whose line end is the end of a record, so files are committed like
    any table's, on any file system, as gzip archives of at most ROWS_PER_FILE captures and
    some FILE_BYTES of payload: large payloads go to archives of fewer captures.

    Every row is a capture. It is known by its page_id, url and payload; rows alike in all
    three, and rows with a NULL page_id, which are all responses, are numbered too, and the
    numbers written down.
    """
    key = ["page_id", "url", "payload_digest"]
    payload = ["payload_digest", "payload_bytes"]
    pages = pages.select("page_id", "url", "html")
    every = digests(pages)
    slim = staged(every.select("page_id", "url", *payload), "warc-digests")
    named = slim.where("page_id IS NOT NULL")
    first = named.where(F.col("payload_bytes") >= least).groupBy(*payload).agg(F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n"))
    first = staged(first.where("n > 1").drop("n"), "warc-first")
    again = staged(named.join(first, payload).where("page_id <> first.page_id").select(*key, "first").distinct(), "warc-revisits")
    repeated = staged(named.groupBy(*key).count().where("count > 1").select(*key), "warc-repeated")

    def met(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        of = keys.select(F.col("page_id").alias("of_page"), F.col("url").alias("of_url"), F.col("payload_digest").alias("of_digest"), *keys.columns[3:])
        same = (F.col("page_id") == F.col("of_page")) & F.col("url").eqNullSafe(F.col("of_url")) & (F.col("payload_digest") == F.col("of_digest"))
        return rows.join(of, same, how).drop("of_page", "of_url", "of_digest")

    once = every
    numbered = pages.where("page_id IS NULL")
    if not repeated.isEmpty():
        once = met(every, repeated, "left_anti")
        numbered = numbered.unionByName(met(every, repeated, "left_semi").select(*pages.columns))
    numbered = staged(numbered.select("page_id", "url", "html", F.monotonically_increasing_id().alias("occurrence")), "warc-numbered")
    numbered = digests(numbered)
    if not repeated.isEmpty():
        # The lowest of its number needs none: it is the one that revisits refer to.
        lowest = staged(numbered.where("page_id IS NOT NULL").groupBy(*key).agg(F.min("occurrence").alias("lowest")), "warc-lowest")
        numbered = met(numbered, lowest, "left").withColumn("occurrence", F.expr("nullif(occurrence, lowest)")).drop("lowest")
    once = once.where("page_id IS NOT NULL").select(*numbered.columns)
    placed = met(once.unionByName(numbered), again, "left")
    whole = placed.select(
        "page_id", "url", "occurrence", F.when(F.col("first").isNull(), F.encode("html", "UTF-8")).alias("html"), *reversed(payload), "first"
    )
    largest = slim.agg(F.max("payload_bytes")).first()[0] or 0
    written = F.when(F.col("first").isNull(), F.col("payload_bytes")).otherwise(0)
    for part, rows_per_file in ((written <= LARGE, ROWS_PER_FILE), (written > LARGE, max(1, min(ROWS_PER_FILE, FILE_BYTES // max(largest, 1))))):
        if rows_per_file == ROWS_PER_FILE or largest > LARGE:
            (
                whole.where(part)
                .mapInArrow(_records, "record binary")
                .select(F.col("record").cast("string").alias("value"))
                .write.mode("append")
                .option("lineSep", "\r\n\r\n")
                .option("compression", "gzip")
                .option("zlib.compress.level", "BEST_SPEED")
                .option("maxRecordsPerFile", 3 * rows_per_file)
                .text(folder)
            )


def read_archives(spark: SparkSession, folder: str, blocks: bool = True) -> DataFrame:
    """The records of all archives in ``folder``; ``blocks=False`` leaves the blocks out.

    payload_bytes and payload_digest are of the payload read, and NULL for revisits, whose
    payload is another record's. A task holds one packed archive and one record at a time.
    """

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
            ("uri", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("block_bytes", pa.int64()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("block", pa.binary()),
        ])
        for batch in rows:
            for content in batch.column(0):
                out, held = [], 0
                for headers, block in parse(content.as_py()):
                    kind = headers.get("warc-type")
                    payload = None if kind == "revisit" else payload_of(headers, block)
                    out.append({
                        "record_id": headers.get("warc-record-id"), "record_type": kind,
                        "concurrent_to": headers.get("warc-concurrent-to"), "refers_to": headers.get("warc-refers-to"),
                        "uri": headers.get("warc-target-uri"), "headers": list(headers.items()), "block_bytes": len(block),
                        "payload_bytes": None if payload is None else len(payload),
                        "payload_digest": digest(payload) if kind == "response" else None,
                        "block": block if blocks or kind == "metadata" else None,
                    })
                    held += len(block) if blocks else 0
                    if len(out) >= 2000 or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
                yield pa.RecordBatch.from_pylist(out, schema)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(read, RECORD_TYPE)


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, record_type, uri, request, main, metadata.

    A capture is a response or revisit record; request and metadata are structs of those
    records whose concurrent-to identifier names it (of several, the one of the lowest
    record_id), NULL if there is none. They are joined by that identifier, each reduced to
    one per capture first. Records of other kinds, and parts whose capture is missing, make
    no row; equal records count once. An empty archive gives none.
    """
    main = records.where("record_type IN ('response', 'revisit') AND record_id IS NOT NULL").dropDuplicates(["record_id"])

    def part(kind: str) -> DataFrame:
        of_kind = records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
        return of_kind.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.min_by(F.struct("record_id", "block_bytes", "block"), "record_id").alias(kind)
        )

    nested = F.struct("refers_to", "block_bytes", "payload_bytes", "payload_digest", "block", "headers")
    return (
        main.select("record_id", "record_type", "uri", nested.alias("main"))
        .join(part("request"), "record_id", "left")
        .join(part("metadata"), "record_id", "left")
    )


def page_report(captures: DataFrame) -> DataFrame:
    """Per capture written by :func:`write_archives`: page_id, payload_bytes, payload_digest,
    record_type and refers_to; a revisit has the payload of the response it refers to."""
    page = F.nullif(F.regexp_extract(F.col("metadata.block").cast("string"), "page-id: (-?[0-9]+)", 1), F.lit(""))
    flat = captures.select(
        F.col("record_id"), F.col("record_type"), page.cast("long").alias("page_id"), F.col("main.refers_to").alias("to"),
        F.col("main.payload_bytes").alias("payload_bytes"), F.col("main.payload_digest").alias("payload_digest"),
    )
    flat = staged(flat, "warc-captures")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    whole = flat.where("record_type = 'response'").select(*columns, F.lit(None).cast("long").alias("refers_to"))
    originals = flat.where("record_type = 'response'").select(
        F.col("record_id").alias("to"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("pb"), F.col("payload_digest").alias("pd")
    )
    again = flat.where("record_type = 'revisit'").join(originals, "to")
    return whole.unionByName(again.select("page_id", F.col("pb").alias("payload_bytes"), F.col("pd").alias("payload_digest"), "record_type", "refers_to"))
