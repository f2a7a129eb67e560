"""Legacy ARC archives converted to WARC files, and a reader of the latter.

An ARC archive opens with a ``filedesc`` record whose second line names the
version; its third line lists the fields of every record's header line.  Each
record is that header line, as many bytes as its last field declares, and a
line feed.  ``arc_records`` follows the declared lengths alone.

``convert`` makes the equivalent WARC record of each ARC record: identifier
(a UUID from the archive's name, the record's offset and its payload digest),
timestamp (ARC's 14 digits as ISO 8601), type and SHA-1 digests.  Records with
equal payloads of at least ``min_bytes`` become one response, that with the
smallest key, and revisits that name it.

Defined results: null content is an archive without records; an archive cut
short ends at its last whole record and reports the rest as ``damaged``; a null
URL is written ``-``; white space and control bytes of URLs are percent-encoded;
null payloads are empty; repeated keys keep a record each (equal payloads under
one key: one response, since each is the first); an empty table gives no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.llm import textkit as K

# The header fields of both ARC versions
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Namespace of the synthesised identifiers.
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: Records in a written WARC file.
FILE_RECORDS = 500
END = "\r\n\r\n"


def arc_archive(name: str, records: list[tuple[str, str, bytes]], version: int = 1) -> bytes:
    """An ARC archive of (url, 14-digit date, content) records."""
    fields = FIELDS[version]
    about = f"{version} 0 Archive\n{fields}\n".encode()
    head = [f"filedesc://{name}", "0.0.0.0", "20000101000000", "text/plain", *(["200", "-", "-", "0", name] if version == 2 else []), str(len(about))]
    out = [" ".join(head).encode(), b"\n", about, b"\n"]
    at = sum(map(len, out))
    for url, date, content in records:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "-"
        head = [clean, "0.0.0.0", date, "text/html", *(["200", "-", "-", str(at), name] if version == 2 else []), str(len(content))]
        part = " ".join(head).encode("utf-8", "surrogateescape") + b"\n" + content + b"\n"
        out.append(part)
        at += len(part)
    return b"".join(out)


def arc_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes | None]]:
    """(offset, header fields, content) of every record after the archive's own; content None where it is damaged."""
    at, fields = 0, None
    while at < len(data):
        if data[at:at + 1] == b"\n":  # writers differ in the line feeds between records
            at += 1
            continue
        end = data.find(b"\n", at)
        parts = data[at:end if end >= 0 else len(data)].decode("utf-8", "surrogateescape").rstrip("\r").split(" ")
        if end < 0 or not parts[-1].isdigit() or end + 1 + int(parts[-1]) > len(data):
            yield at, {}, None
            return
        body = data[end + 1:end + 1 + int(parts[-1])]
        if fields is None:
            version, names = body.split(b"\n")[:2] if body.count(b"\n") else (b"1", FIELDS[1].encode())
            fields = names.decode().split() or FIELDS[int(version.split(b" ")[0])].split()
        elif len(parts) < len(fields):
            yield at, {}, None
            return
        else:
            # the URL is what the other fields leave, should it hold blanks
            spare = len(parts) - len(fields)
            yield at, dict(zip(fields, [" ".join(parts[:spare + 1]), *parts[spare + 1:]], strict=True)), body
        at = end + 1 + int(parts[-1])


def payload_of(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload; content without a head is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = content.find(b"\r\n\r\n")
    return (content[:end + 4], content[end + 4:]) if end >= 0 else (content, b"")


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(digits: str) -> str:
    """ARC's YYYYMMDDhhmmss (shorter ones are filled up) as a WARC timestamp."""
    full = (digits + "00000101000000"[len(digits):])[:14] if digits.isdigit() else "19700101000000"
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def pages_to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "20240101000000") -> DataFrame:
    """key, archive: one archive for each page, of either version in turn, with an HTTP response around the payload."""
    K.prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in K.blocks(batch, "html"):
                out = []
                for key, url, html in zip(block["key"].to_pylist(), block["url"].to_pylist(), block["html"].to_pylist(), strict=True):
                    html = html or b""
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
                    out.append(arc_archive(f"page-{key}.arc", [((url or b"-").decode("utf-8", "surrogateescape"), date, head + html)], 1 + (key or 0) % 2))
                yield pa.RecordBatch.from_arrays([block["key"], K.binaries(out)], ["key", "archive"])

    rows = pages.select(pages[id_col].cast("long").alias("key"), pages[url_col].cast("binary").alias("url"), pages[html_col].cast("binary").alias("html"))
    return rows.mapInArrow(run, "key long, archive binary")


def convert(archives: DataFrame) -> DataFrame:
    """(key, archive) -> key, offset, url, date, record_id, payload_digest, payload_bytes, content, damaged."""
    K.prepare(archives.sparkSession)
    names = ["key", "offset", "url", "date", "record_id", "payload_digest", "payload_bytes", "content", "damaged"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in K.blocks(batch, "archive"):
                rows = []
                for key, data in zip(block["key"].to_pylist(), block["archive"].to_pylist(), strict=True):
                    for at, head, content in arc_records(data or b""):
                        payload = payload_of(content or b"")[1]
                        digest = sha1_32(payload)
                        rows.append((key, at, head.get("URL", "-").encode("utf-8", "surrogateescape").decode("utf-8", "replace"), iso_date(head.get("Archive-date", "")),
                                     str(uuid.uuid5(SPACE, f"{key}/{at}/{digest}")), digest, len(payload), content, content is None))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names)

    return archives.mapInArrow(run, "key long, offset long, url string, date string, record_id string, payload_digest string, payload_bytes long, content binary, damaged boolean")


def first_of_equal(records: DataFrame, min_bytes: int) -> DataFrame:
    """key, offset, to_key, to_id: the records that revisit another one.

    Digests that occur once drop out after a map-side combined count; a digest
    that very many records share is dealt to salted copies of its first record.
    """
    own = records.filter((F.col("payload_bytes") >= min_bytes) & ~F.col("damaged")).select("key", "offset", "record_id", "payload_digest", "payload_bytes")
    first = (own.groupBy("payload_digest", "payload_bytes").agg(F.min(F.struct("key", "offset", "record_id")).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("payload_digest", "payload_bytes", "first", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt")))
    salted = own.withColumn("salt", F.pmod(F.xxhash64("key", "offset"), F.lit(16)).cast("int"))
    again = salted.join(first, ["payload_digest", "payload_bytes", "salt"])
    # every record of the smallest key is a response, should that key be repeated
    return again.filter(~F.col("key").eqNullSafe(F.col("first.key"))).select("key", "offset", F.col("first.key").alias("to_key"), F.col("first.record_id").alias("to_id")).distinct()


def warc_text(records: DataFrame) -> Column:
    """The whole WARC record but for its end, as bytes in a string column."""
    revisit = F.col("to_id").isNotNull()
    block = F.when(revisit, F.col("http_head")).otherwise(F.col("content"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value)

    return F.concat(
        F.lit("WARC/1.1"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", F.format_string("<urn:uuid:%s>", "record_id")),
        line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))), line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("X-Archive-Key", F.coalesce(F.col("key").cast("string"), F.lit("-"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", F.format_string("<urn:uuid:%s>", "to_id")), line("X-Refers-To-Key", F.coalesce(F.col("to_key").cast("string"), F.lit("-"))),
                                 line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END), block.cast("string"))


def write_warc(records: DataFrame, path: str, min_bytes: int) -> None:
    """Gzipped WARC files of at most FILE_RECORDS records below ``path``; damaged records are left out.

    A record ends in two line breaks, which the text writer sets between rows.
    """
    again = first_of_equal(records, min_bytes).withColumnsRenamed({"key": "k", "offset": "o"})
    whole = records.filter(~F.col("damaged"))
    head = F.substring("content", F.lit(1), F.octet_length("content") - F.col("payload_bytes"))
    joined = whole.join(again, F.col("key").eqNullSafe(F.col("k")) & (F.col("offset") == F.col("o")), "left").withColumn("http_head", head)
    (joined.select(warc_text(joined).alias("value")).write.mode("overwrite").option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, by declared length."""
    at = 0
    while at < len(data):
        end = data.index(END.encode(), at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield head, data[end + 4:end + 4 + size]
        at = end + 4 + size + len(END)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """key, record_type, payload_bytes, payload_digest, refers_to, url, date of every record in the files below ``path``.

    A response's payload is measured and must have the digest that its header
    declares; a revisit stores no payload and its header speaks for it.
    """
    import gzip

    K.prepare(spark)
    names = ["key", "record_type", "payload_bytes", "payload_digest", "refers_to", "url", "date"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def number(x: str | None) -> int | None:
        return None if x in (None, "-") else int(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch["content"]:
                rows = []
                for head, block in warc_records(gzip.decompress(raw.as_buffer())):
                    declared = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(head["X-Payload-Length"])
                    if head["WARC-Type"] == "response":
                        payload = payload_of(block)[1]
                        if sha1_32(payload) != declared:
                            raise ValueError(f"payload of {head['WARC-Record-ID']} has another digest")
                        size = len(payload)
                    rows.append((number(head["X-Archive-Key"]), head["WARC-Type"], size, declared, number(head.get("X-Refers-To-Key")), head["WARC-Target-URI"], head["WARC-Date"]))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, "key long, record_type string, payload_bytes long, payload_digest string, refers_to long, url string, date string")
