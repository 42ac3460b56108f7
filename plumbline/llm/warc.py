"""Web archives: written with Spark, read back, and assembled to one nested row per capture.

``write`` makes three records of each page: a response, or a revisit where an equal payload is
already there, a request and a metadata record, the last two concurrent to the first. ``read``
gives a row per record of any archive. ``captures`` assembles transactions: request and metadata
records are joined to their response through concurrent-to identifiers, whichever of the
two names the other.

Archives are written by Spark's text sink, of which a row is a record and the line end the two
empty lines that close it. So files are committed as a whole, and a lost executor leaves no part of one.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.spread import keyed_join
from plumbline.llm.stored import Stored

#: Records of one archive file.
FILE_RECORDS = 30_000
#: Bytes that are unpacked at once, and bytes of records that are handed on together.
CHUNK_BYTES, BATCH_BYTES = 1 << 20, 4 << 20

# Names of the archive format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD_SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, concurrent_to array<string>, refers_to string, "
    "headers map<string,string>, http_headers map<string,string>, payload binary, payload_bytes long, payload_digest string"
)


def base32(hexadecimal: Column) -> Column:
    """Base32 of the 40 hexadecimal digits of a SHA-1: four letters for each five digits."""
    five = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(hexadecimal, 5 * i + 1, F.lit(5)), 16, 10).cast("int"))
    letters = F.transform(five, lambda v: F.array_join(F.array(*(
        F.substring(F.lit(BASE32), F.shiftright(v, shift).bitwiseAND(F.lit(31)) + F.lit(1), F.lit(1)) for shift in (15, 10, 5, 0))), ""))
    return F.array_join(letters, "")


def _urn(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws(" ", *parts))
    cuts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, none where the value is null."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def _one_line(text: Column) -> Column:
    """Control characters, which would end a header line, as percent escapes."""
    for code in (0, 9, 10, 11, 12, 13):
        text = F.replace(text, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return text


def _record(kind: str, fields: list[Column], block: Column) -> Column:
    head = F.concat(F.lit(f"{VERSION}\r\n"), _field("WARC-Type", F.lit(kind)), *(F.coalesce(f, F.lit("")) for f in fields))
    return F.concat(head, _field("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def records(
    pages: DataFrame, stored: Stored, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0,
) -> DataFrame:
    """(record) of all pages: the text of three archive records for each row, without the empty lines that close them.

    Of the pages with equal payloads of at least ``least_bytes`` bytes that of the smallest id is the
    response and all others are revisits, which carry the response's headers but no payload; smaller
    payloads are responses all. Of rows with the same smallest id one is the response; a null id comes after
    all others.

    A null html is an empty payload. A page without url gets no target, one without id no page-id field in its metadata.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("html"))
    rows = stored.table(rows.withColumn("row", F.monotonically_increasing_id()), codec="zstd")
    digests = stored.table(rows.select(
        "row", "page_id", F.octet_length("html").cast("long").alias("size"), F.sha1(F.col("html").cast("binary")).alias("sha1")))
    # Nulls are greater than all ids.
    own = F.struct(F.col("page_id").isNull().alias("missing"), "page_id", "row")
    first = digests.filter(F.col("size") >= least_bytes).groupBy("sha1").agg(F.min(own).alias("first")).select("sha1", F.col("first.row").alias("first_row"))
    number = F.col("row").cast("string")
    place = stored.table(keyed_join(digests.select("row", "sha1"), first, ["sha1"]).select(
        "row", base32(F.col("sha1")).alias("digest"), F.coalesce(F.col("first_row") != F.col("row"), F.lit(False)).alias("revisit"),
        _urn(F.lit("response"), number).alias("main"), _urn(F.lit("response"), F.col("first_row").cast("string")).alias("refers_to"),
        _urn(F.lit("request"), number).alias("request"), _urn(F.lit("metadata"), number).alias("notes")))
    rows = rows.join(place, "row").withColumn("url", _one_line(F.col("url")))

    main, uri = F.col("main"), _field("WARC-Target-URI", F.col("url"))
    date = _field("WARC-Date", F.lit("2024-01-01T00:00:00Z"))
    digest = _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    answer = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _field("Content-Length", F.octet_length("html").cast("string")), F.lit("\r\n"))
    http = _field("Content-Type", F.lit("application/http; msgtype=response"))
    response = _record("response", [_field("WARC-Record-ID", main), uri, date, digest, http], F.concat(answer, F.col("html")))
    again = _record("revisit", [
        _field("WARC-Record-ID", main), uri, date, digest, _field("WARC-Profile", F.lit(PROFILE)),
        _field("WARC-Refers-To", F.col("refers_to")), http], answer)
    beside = _field("WARC-Concurrent-To", main)
    path = F.coalesce(F.nullif(F.regexp_extract(F.col("url"), r"^[^:]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    host = F.coalesce(F.regexp_extract(F.col("url"), r"^[^:]*://([^/?#]*)", 1), F.lit(""))
    request = _record("request", [
        _field("WARC-Record-ID", F.col("request")), uri, date, beside, _field("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")))
    notes = _record("metadata", [
        _field("WARC-Record-ID", F.col("notes")), uri, date, beside, _field("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.coalesce(_field("page-id", F.col("page_id").cast("string")), F.lit("")), _field("row", number)))
    return rows.select(F.explode(F.array(F.when(F.col("revisit"), again).otherwise(response), request, notes)).alias("record"))


def write(record: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Write (record) as packed archive files below ``path``, a folder that does not exist yet."""
    (record.select("record").write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", file_records).text(path))


class _Stream:
    """The bytes of a file, unpacked piece by piece where they are packed (also as many members)."""

    def __init__(self, content: bytes) -> None:
        self.packed = content[:2] == b"\x1f\x8b"
        self.rest, self.buffer, self.at = memoryview(content), bytearray(), 0
        self.unpack = zlib.decompressobj(31) if self.packed else None

    def _more(self) -> bool:
        if self.at > CHUNK_BYTES:
            del self.buffer[: self.at]
            self.at = 0
        if not len(self.rest):
            return False
        piece, self.rest = self.rest[:CHUNK_BYTES], self.rest[CHUNK_BYTES:]
        if not self.packed:
            self.buffer += piece
            return True
        while len(piece):
            self.buffer += self.unpack.decompress(piece)
            piece = memoryview(self.unpack.unused_data)
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
        return True

    def head(self) -> bytes | None:
        """The next header block without its empty line; none at the end of the file."""
        while True:
            while len(self.buffer) - self.at < 4 and self._more():
                pass
            while self.buffer[self.at : self.at + 2] == b"\r\n":
                self.at += 2
            end = self.buffer.find(b"\r\n\r\n", self.at)
            if end >= 0:
                block = bytes(self.buffer[self.at : end])
                self.at = end + 4
                return block
            if not self._more():
                if self.buffer[self.at :].strip():
                    raise ValueError("the archive ends inside a record")
                return None

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        block = bytes(self.buffer[self.at : self.at + n])
        self.at += n
        return block


def _fields(lines: list[bytes]) -> list[tuple[str, str]]:
    """(name in lower case, value) of header lines; a line that begins with a blank goes on with the one before."""
    found: list[tuple[str, str]] = []
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {text.strip()}")
        elif ":" in text:
            name, value = text.split(":", 1)
            found.append((name.strip().lower(), value.strip()))
    return found


def _parsed(content: bytes) -> Iterator[dict]:
    stream = _Stream(content)
    while (head := stream.head()) is not None:
        lines = head.split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError("a record does not begin with its version")
        fields = _fields(lines[1:])
        headers = dict(reversed(fields))
        block = stream.take(int(headers.get("content-length", 0)))
        payload, http = block, None
        if headers.get("content-type", "").lower().startswith("application/http"):
            top, _, payload = block.partition(b"\r\n\r\n")
            http = dict(reversed(_fields(top.split(b"\r\n")[1:])))
        revisit = headers.get("warc-type") == "revisit"
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        size = len(payload)
        if revisit:
            # The payload is elsewhere; its size and digest are what the headers say.
            digest = headers.get("warc-payload-digest", "").removeprefix("sha1:").upper() or None
            told = (http or {}).get("content-length", "")
            payload, size = None, int(told) if told.isdigit() else None
        yield {
            "record_id": headers.get("warc-record-id"), "record_type": headers.get("warc-type"), "target_uri": headers.get("warc-target-uri"),
            "date": headers.get("warc-date"), "concurrent_to": [v for k, v in fields if k == "warc-concurrent-to"], "refers_to": headers.get("warc-refers-to"),
            "headers": list(headers.items()), "http_headers": list(http.items()) if http is not None else None,
            "payload": payload, "payload_bytes": size, "payload_digest": digest,
        }


_ARROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
    ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("headers", pa.map_(pa.string(), pa.string())),
    ("http_headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
])


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archive files at ``path``, packed or plain: its headers (names in lower case), payload,
    and the payload's size and SHA-1 digest in base32.

    A record of HTTP content has its HTTP headers apart from the payload. Of headers that repeat the first
    counts, but all concurrent-to identifiers are kept. A revisit has no payload; its size and
    digest are what its headers tell. A file that breaks off inside a record is an
    error, and so is one of more than 2 GB, Spark's limit for a cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column("content"):
                held, size = [], 0
                for record in _parsed(cell.as_py()):
                    held.append(record)
                    size += 1000 + len(record["payload"] or b"")
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, _ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, _ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def captures(records: DataFrame, stored: Stored) -> DataFrame:
    """One nested row per capture of (the columns of ``read``): capture_id, response, requests, metadata.

    ``response`` is a struct of the response or revisit record, whose identifier is ``capture_id``.
    ``requests`` and ``metadata`` are arrays of structs in order of their identifiers: the records that name
    the response as concurrent or that it names, and the metadata records so tied to one of its requests.
    Records whose response is not there come together by the first identifier that they name, with a null response;
    records that name none are captures of their own. Other kinds of records, and records without
    an identifier, are left out. Of records that repeat an identifier one is kept.
    """
    small = ["record_id", "record_type", "target_uri", "date", "headers", "http_headers", "payload", "payload_bytes", "payload_digest"]
    there = records.filter("record_id is not null")
    main = there.filter("record_type in ('response', 'revisit')").select(*small, "refers_to", "concurrent_to")
    side = _distinct(there.filter("record_type in ('request', 'metadata')").select(*small, "concurrent_to"), stored)
    main = _distinct(main, stored)
    ids = stored.table(main.select("record_id", "concurrent_to"))
    known = ids.select(F.col("record_id").alias("to"), F.col("record_id").alias("capture_id")).distinct()

    # Ties between records, whichever names the other.
    named = stored.table(side.select("record_id", "record_type", F.explode("concurrent_to").alias("to")))
    by_side = keyed_join(named, known, ["to"], "inner").select("record_id", "capture_id")
    by_main = stored.table(ids.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("record_id")))
    by_main = keyed_join(by_main, side.select("record_id").distinct(), ["record_id"], "inner")
    direct = stored.table(by_side.unionByName(by_main).groupBy("record_id").agg(F.min("capture_id").alias("capture_id")))
    # A metadata record may be tied to the request alone.
    hop = keyed_join(named, direct.withColumnsRenamed({"record_id": "to"}), ["to"], "inner").groupBy("record_id").agg(F.min("capture_id").alias("other"))
    found = direct.join(hop, "record_id", "full_outer").select("record_id", F.coalesce("capture_id", "other").alias("capture_id"))
    tied = side.join(found, "record_id", "left").withColumn(
        "capture_id", F.coalesce("capture_id", F.try_element_at("concurrent_to", F.lit(1)), "record_id"))

    def nested(kind: str, name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("record_type") == kind, F.struct(
            "record_id", "target_uri", "date", "payload", F.map_entries("headers").alias("headers"), F.map_entries("http_headers").alias("http_headers"))))).alias(name)

    beside = tied.groupBy("capture_id").agg(nested("request", "requests"), nested("metadata", "metadata"))
    one = F.struct(*small, "refers_to")
    whole = main.select(F.col("record_id").alias("capture_id"), one.alias("response"))
    return whole.join(beside, "capture_id", "full_outer").select("capture_id", "response", "requests", "metadata")


def _distinct(records: DataFrame, stored: Stored) -> DataFrame:
    """``records`` with one of those that share an identifier, that of the first date, digest and kind.

    Repeated identifiers are rare: whole records are shuffled only for them.
    """
    counts = stored.table(records.groupBy("record_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    if counts.isEmpty():
        return records
    order = Window.partitionBy("record_id").orderBy("date", "payload_digest", "record_type", "target_uri")
    again = records.join(counts, "record_id", "left_semi").withColumn("n", F.row_number().over(order)).filter("n = 1").drop("n")
    return records.join(counts, "record_id", "left_anti").unionByName(again)


def page_id() -> Column:
    """The page-id field of the first metadata record of a capture."""
    text = F.try_element_at("metadata", F.lit(1))["payload"].cast("string")
    found = F.regexp_extract(text, r"(?m)^page-id: (-?[0-9]+)\r?$", 1)
    return F.when(found != "", found.cast("long"))


def digest(captured: DataFrame, stored: Stored) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of captures that ``write`` has made."""
    rows = stored.table(captured.select(
        "capture_id", page_id().alias("page_id"), "response.payload_bytes", "response.payload_digest", "response.record_type",
        F.col("response.refers_to").alias("to"), F.size("requests").alias("n_requests")), keep=True)
    first = rows.select(F.col("capture_id").alias("to"), F.col("page_id").alias("refers_to"))
    revisits = keyed_join(rows.filter("to is not null"), first, ["to"])
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "n_requests"]
    return rows.filter("to is null").withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(revisits.select(*columns))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read these back and digest their captures; a row per page.

    An empty table gives no rows, rows that repeat are captures each, and columns other than the three named are not read.
    """
    stored, sources = Stored(pages.sparkSession), Stored(pages.sparkSession)
    path = stored.path("archive")
    write(records(pages, sources, id_col, url_col, html_col, least_bytes), path)
    sources.close()
    # Payloads of pages have been counted and digested as they were read, and go no further; nor do headers.
    beside = F.when(~F.col("record_type").isin("response", "revisit"), F.col("payload"))
    none = F.lit(None).cast("map<string,string>")
    found = stored.table(read(pages.sparkSession, path).withColumns({"payload": beside, "headers": none, "http_headers": none}))
    result = digest(captures(found, stored), stored)
    stored.close()
    return result
