"""Legacy ARC archives to WARC: records by version-specific header lines and declared lengths, both formats as text files of Spark."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .common import staged

#: Bytes of payloads in one archive file; an archive is read by one task.
ARCHIVE_BYTES = 8 << 20
#: What a record's headers count for, so that archives of small pages stay small.
HEADER_BYTES = 512
#: Fixed values of the formats: the fields of a record's header line by version of the archive.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_CRLF = b"\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(text: str | None) -> str:
    """A value that can stand between the spaces of a header line."""
    return "".join(f"%{b:02X}" if b <= 0x20 or b == 0x7F else chr(b) if b < 0x80 else f"%{b:02X}" for b in (text or "").encode()) or "-"


def _arc_header(version: str, url: str, ip: str, date: str, kind: str, length: int, **more: str) -> bytes:
    known = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": kind, "Archive-length": str(length)} | more
    return " ".join(known.get(f, "-") for f in ARC_FIELDS[version].split()).encode()


def arc_filedesc(version: str, name: str, date: str) -> bytes:
    """The record that opens an archive and states its version and fields."""
    block = f"{version} 0 haltwerk\n{ARC_FIELDS[version]}\n".encode()
    return _arc_header("1", f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(block)) + b"\n" + block


def write_arc(pages: DataFrame, path: str, date: str = "20000101000000", archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Write ``pages`` (page_id, url, html) as gzipped ARC files of about ``archive_bytes``, half of them of version 1, half of version 2.

    A record's content is an HTTP response whose headers carry the page's id and length. NULL html is an empty
    payload, a NULL id has no header, white space in a URL is percent-encoded. Returns the number of files dealt to.
    """
    total = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)).cast("long") + HEADER_BYTES)).head()[0] or 0
    files = 1 + total // archive_bytes

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = None
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                payload = html or b""
                if version is None:
                    version = "12"[zlib.crc32(repr((page_id, url)).encode()) & 1]
                    out.append(arc_filedesc(version, f"{uuid.uuid5(uuid.NAMESPACE_URL, repr((page_id, url)))}.arc", date))
                head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]
                head += [b"X-Page-Id: %d" % page_id] if page_id is not None else []
                block = _CRLF.join(head) + 2 * _CRLF + payload
                out.append(_arc_header(version, _field(url), "0.0.0.0", date, "text/html", len(block)) + b"\n" + block)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").cast("binary").alias("html"))
    # Dealt by content and place, so that equal rows are spread; ``pages`` gives the same rows in the same order when read again, as files do.
    rows = rows.repartition(files, F.xxhash64("page_id", "url", "html", F.monotonically_increasing_id()))
    _write(rows.mapInArrow(records, "value binary"), path)
    return files


def _write(records: DataFrame, path: str) -> None:
    """One line-feed ends each record; the fastest level, since archives are written once and read once."""
    records.select(F.col("value").cast("string")).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _unpacked(content: bytes) -> bytes:
    """The bytes of a file of any number of gzip members; a plain file as it is."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out) if out else content


def read_arc(data: bytes) -> Iterator[tuple[int, dict[str, str] | None, bytes]]:
    """(offset, header fields, content) of each record of one archive.

    The first record states the version, and so the fields of all later header lines; contents are cut by their declared
    length. What has no readable header, or ends early, is given with None as its header and ends the archive.
    """
    at, fields = 0, ARC_FIELDS["1"].split()
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):  # the separator
            at += 1
            continue
        end = data.find(b"\n", at)
        values = data[at : end if end >= 0 else len(data)].decode("latin-1").split(" ")
        known = ARC_FIELDS["1"].split() if values[0].startswith("filedesc:") and len(values) == 5 else fields
        length = values[-1].strip()
        if end < 0 or len(values) != len(known) or not length.isdigit() or end + 1 + int(length) > len(data):
            yield at, None, data[at:]
            return
        content = data[end + 1 : end + 1 + int(length)]
        if values[0].startswith("filedesc:"):
            fields = ARC_FIELDS.get(content[:1].decode("latin-1"), ARC_FIELDS["1"]).split()
        yield at, dict(zip(known, values, strict=True)), content
        at = end + 1 + int(length)


def _http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Header part with its blank line, header fields, payload of an HTTP message."""
    end = block.find(2 * _CRLF)
    if end < 0:
        return b"", {}, block
    fields = dict(x.decode("latin-1").split(": ", 1) for x in block[:end].split(_CRLF)[1:] if b": " in x)
    return block[: end + 4], fields, block[end + 4 :]


def _record_id(file: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{offset}')}>"


def _warc(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record without its last line feed, which the writer adds."""
    head = b"WARC/1.0\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None)
    return head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r"


def _iso(date: str) -> str:
    """A 12- or 14-digit time as WARC writes it; what is none becomes the epoch."""
    d = (date + "00")[:14] if date.isdigit() and len(date) >= 12 else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def convert_record(file: str, offset: int, header: dict[str, str] | None, content: bytes, first: tuple[str, int | None] | None) -> bytes:
    """The WARC record of an ARC record; ``first`` is (record id, page id) of the earlier record with the same payload, if any.

    filedesc becomes warcinfo, HTTP content response or, with ``first``, revisit, anything else resource; what
    could not be read becomes a metadata record with the bytes as they are.
    """
    base = [("WARC-Record-ID", _record_id(file, offset))]
    if header is None:
        return _warc([("WARC-Type", "metadata"), *base, ("WARC-Date", _iso("")), ("Content-Type", "application/octet-stream")], content)
    base.append(("WARC-Date", _iso(header["Archive-date"])))
    url = header["URL"]
    if url.startswith("filedesc:"):
        return _warc([("WARC-Type", "warcinfo"), *base, ("WARC-Filename", url[11:]), ("Content-Type", "application/warc-fields")], b"conformsTo: ARC\r\n")
    base += [("WARC-Target-URI", url), ("WARC-IP-Address", header["IP-address"]), ("WARC-Block-Digest", f"sha1:{sha1_base32(content)}")]
    head, fields, payload = _http(content)
    if not content.startswith(b"HTTP/"):
        return _warc([("WARC-Type", "resource"), *base, ("Content-Type", header["Content-type"])], content)
    base += [("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"), ("Content-Type", "application/http; msgtype=response")]
    if first is None:
        return _warc([("WARC-Type", "response"), *base], content)
    # The block of a revisit holds the HTTP headers alone; their digest is that block's.
    base = [(k, f"sha1:{sha1_base32(head)}" if k == "WARC-Block-Digest" else v) for k, v in base]
    more = [("WARC-Profile", IDENTICAL), ("WARC-Truncated", "length"), ("WARC-Refers-To", first[0]), ("X-Refers-To-Page-Id", None if first[1] is None else str(first[1]))]
    return _warc([("WARC-Type", "revisit"), *base, *more], head)


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of one archive, cut by Content-Length. Raises ValueError on a broken archive."""
    at = 0
    while at < len(data):
        end = data.find(2 * _CRLF, at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at {at}")
        fields = dict(x.decode().split(": ", 1) for x in data[at:end].split(_CRLF)[1:])
        size = int(fields["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) < size or data[end + 4 + size : end + 8 + size] != 2 * _CRLF:
            raise ValueError(f"record at {at} ends early")
        yield fields, block
        at = end + 8 + size


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.substring_index("path", "/", -1).alias("file"), "content")


def arc_index(spark: SparkSession, path: str) -> DataFrame:
    """One row for each HTTP record of the ARC files below ``path``: file, offset, page_id, payload_bytes, payload_digest."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["file", "offset", "page_id", "payload_bytes", "payload_digest"], [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                out, name = [], file.as_py()
                for offset, header, block in read_arc(_unpacked(content.as_py())):
                    if header and block.startswith(b"HTTP/"):
                        _, fields, payload = _http(block)
                        page = fields.get("X-Page-Id")
                        out.append((name, offset, None if page is None else int(page), len(payload), sha1_base32(payload)))
                columns = zip(*out, strict=True) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return _archives(spark, path).mapInArrow(index, "file string, offset long, page_id long, payload_bytes long, payload_digest string")


def convert_arc(spark: SparkSession, source: str, target: str, files: int = 1, min_bytes: int = 0) -> None:
    """Convert the ARC files below ``source`` to WARC files below ``target``.

    Of records with equal payloads of at least ``min_bytes`` that with the smallest page id (NULL last; then by file and
    offset) is a response, the others revisit it. Only digests are shuffled to find it; what a file's records refer to is
    joined to the file, whose compressed bytes travel once.
    """
    index = staged(arc_index(spark, source), "arc-index")
    place = F.struct(F.isnull("page_id").alias("unnamed"), "page_id", "file", "offset")
    firsts = index.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select("payload_digest", "first")
    later = index.where(F.col("payload_bytes") >= min_bytes).join(firsts, "payload_digest")
    later = later.where((F.col("file") != F.col("first.file")) | (F.col("offset") != F.col("first.offset")))
    # A file's list is bounded by what an archive of ARCHIVE_BYTES holds.
    refers = later.groupBy("file").agg(F.collect_list(F.struct("offset", F.col("first.file").alias("of_file"), F.col("first.offset").alias("of_offset"), F.col("first.page_id").alias("of_page"))).alias("refers"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content, refers in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                name = file.as_py()
                known = {r["offset"]: (_record_id(r["of_file"], r["of_offset"]), r["of_page"]) for r in refers.as_py() or ()}
                out = [convert_record(name, offset, header, block, known.get(offset)) for offset, header, block in read_arc(_unpacked(content.as_py()))]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    whole = _archives(spark, source).repartition(files, "file").join(refers, "file", "left").select("file", "content", "refers")
    _write(whole.mapInArrow(convert, "value binary"), target)


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """The pages of the WARC files below ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri, record_id.

    The payload of a response is measured and must have its digest; a revisit's length is what its HTTP headers declare.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "record_id"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        number = lambda x: None if x is None else int(x)
        for content in chain.from_iterable(b.column(0) for b in batches):
            out = []
            for fields, block in read_warc(_unpacked(content.as_py())):
                kind = fields["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                _, http, payload = _http(block)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and sha1_base32(payload) != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} has another digest")
                size = len(payload) if kind == "response" else int(http["Content-Length"])
                out.append((number(http.get("X-Page-Id")), size, digest, kind, number(fields.get("X-Refers-To-Page-Id")), fields["WARC-Target-URI"], fields["WARC-Record-ID"]))
            columns = zip(*out, strict=True) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, record_id string"
    return _archives(spark, path).select("content").mapInArrow(read, schema)


def pages_to_warc(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) through legacy ARC files and their WARC equivalents, read back: one row for each row.

    NULL and empty html: empty payloads, which are equal. Repeated rows: one responds, the others revisit it. Extra
    columns are ignored; an empty table gives no rows. See ``warc_records`` for the columns.
    """
    spark = pages.sparkSession
    arc, warc = work_dir(spark, "arc"), work_dir(spark, "warc")
    files = write_arc(pages, arc)
    convert_arc(spark, arc, warc, files, min_bytes)
    return warc_records(spark, warc)
