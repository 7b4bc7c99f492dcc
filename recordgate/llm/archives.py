"""Legacy archive converter: ARC files (versions 1 and 2) to WARC records, and WARC files to rows.

ARC header lines name their own fields: five in version 1, ten in version 2. Contents are cut by the
length that the line declares, never by searching for the next header. A line or head that does
not parse is a reject of its own (``archive_rejects``) and costs no other record but what it hides. WARC identifiers, dates,
types and digests are made from the ARC fields, so a second conversion gives the same records.
Archives are written and read by Spark's own text and binary sources, as gzip files of a bounded
number of records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.llm.common import left_join_by_size, materialise, shared_dir, table

RECORDS_PER_FILE = 4096
#: Payloads of fewer bytes are never made revisits.
REVISIT_BYTES = 1000

_V1 = "URL IP-address Archive-date Content-type Archive-length"
_V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
_PAYLOAD = "page_id long, url string, arc_version int, date string, mime string, status int, payload binary, payload_bytes long, payload_digest string"


def _unzip(data: bytes) -> bytes:
    """All members of a gzip file, or the bytes as they are."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out)


def _skip_lines(data: bytes, at: int) -> int:
    while at < len(data) and data[at] in b"\r\n":
        at += 1
    return at


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one ARC file; the version block is recognised by its address, the fields by their number.

    A line that is no header, or whose declared length goes beyond the file, gives {"at", "error"}.
    """
    at, version = 0, None
    while (at := _skip_lines(data, at)) < len(data):
        begin, stop = at, data.find(b"\n", at)
        stop = len(data) if stop < 0 else stop
        fields = data[at:stop].rstrip(b"\r").split(b" ")
        at = stop + 1
        # the address may hold spaces; the other fields do not
        width = 10 if (version == 2 and not fields[0].startswith(b"filedesc:")) else 5
        if len(fields) < width or not fields[-1].isdigit():
            yield {"at": begin, "error": "NO_HEADER_LINE"}
            continue
        length = int(fields[-1])
        if at + length > len(data):
            yield {"at": begin, "error": "CUT_OFF"}
            return
        body, at = data[at : at + length], at + length
        if fields[0].startswith(b"filedesc:"):
            number = body.split(b" ", 1)[0]
            version = int(number) if number.isdigit() else 1
            continue
        url = b" ".join(fields[: len(fields) - width + 1]).decode(errors="replace")
        rest = [x.decode(errors="replace") for x in fields[len(fields) - width + 1 :]]
        yield {"version": version or 1, "url": url, "ip": rest[0], "date": rest[1], "mime": rest[2], "status": int(rest[3]) if width == 10 and rest[3].isdigit() else 0, "body": body}


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(named fields, block) of each record of one WARC file, by declared lengths.

    What is no record head, or has no usable length, gives ({"at", "error"}, b""), and reading goes on at the next head.
    """
    at = 0
    while (at := _skip_lines(data, at)) < len(data):
        stop = data.find(b"\r\n\r\n", at)
        named = {}
        if stop >= 0 and data.startswith(b"WARC/", at):
            named = dict(line.split(b":", 1) for line in data[at:stop].split(b"\r\n")[1:] if b":" in line)
            named = {k.decode(errors="replace").strip().lower(): v.decode(errors="replace").strip() for k, v in named.items()}
        length = named.get("content-length", "")
        if not length.isdigit() or stop + 4 + int(length) > len(data):
            yield {"at": at, "error": "NO_RECORD_HEAD" if not named else "CUT_OFF" if length.isdigit() else "NO_LENGTH"}, b""
            at = data.find(b"\r\nWARC/", at)
            if at < 0:
                return
            continue
        yield named, data[stop + 4 : stop + 4 + int(length)]
        at = stop + 4 + int(length)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    head, sep, body = block.partition(b"\r\n\r\n")
    return (head, body) if sep and head.startswith(b"HTTP/") else (b"", block)


def _read_arc(batches):
    for b in batches:
        for content in b.column(0):
            rows = []
            for r in parse_arc(_unzip(content.as_py())):
                if "error" in r:
                    continue
                head, body = split_http(r["body"])
                page = re.search(rb"\r\nX-Page-Id: (-?\d+)", head)
                rows.append((int(page[1]) if page else None, r["url"], r["version"], r["date"], r["mime"], r["status"] or (int(head[9:12]) if head[9:12].isdigit() else 0), body, len(body), hashlib.sha1(body).hexdigest()))
                if len(rows) == 1024:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)


_ROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("arc_version", pa.int32()), ("date", pa.string()), ("mime", pa.string()), ("status", pa.int32()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_ROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROW, strict=True)], schema=_ROW)


def _with_version_blocks(version: int, per_file: int):
    """A version block before the first record of each file that the writer will cut."""
    names = _V2 if version == 2 else _V1
    body = f"{version} 0 recordgate\n{names}\n"
    first = f"filedesc://recordgate-v{version}.arc 0.0.0.0 20240101000000 text/plain" + (" 200 - - 0 recordgate.arc" if version == 2 else "")
    block = f"{first} {len(body)}\n{body}"

    def run(batches):
        n = 0
        for b in batches:
            lo = 0
            while lo < b.num_rows:
                if n % per_file == 0:
                    yield pa.RecordBatch.from_arrays([pa.array([block], b.column(0).type)], schema=b.schema)
                take = min(b.num_rows - lo, per_file - n % per_file)
                yield b.slice(lo, take)
                lo, n = lo + take, n + take

    return run


def _page_line(page_id: Column) -> Column:
    """The head's line with the page_id; none where that is null."""
    return F.coalesce(F.concat(F.lit("\r\nX-Page-Id: "), page_id.cast("string")), F.lit(""))


def _http(payload: Column, page_id: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"), _page_line(page_id), F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload)


def write_arc(pages: DataFrame, path: str, version: int, per_file: int = RECORDS_PER_FILE) -> None:
    """Write page_id, url, html as ARC files of the given version. Null html: an empty payload."""
    block = _http(F.coalesce("html", F.lit("")), F.col("page_id"))
    url = F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\s\x00-\x1f]", "%20")
    shared = [url, F.lit("192.0.2.1"), F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.coalesce(F.pmod("page_id", F.lit(31_536_000)), F.lit(0))), "yyyyMMddHHmmss"), F.lit("text/html")]
    extra = [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("recordgate.arc")] if version == 2 else []
    lines = pages.withColumn("block", block).select(F.concat(F.concat_ws(" ", *shared, *extra, F.octet_length("block").cast("string")), F.lit("\n"), F.col("block")).alias("value"))
    lines.mapInArrow(_with_version_blocks(version, per_file), "value string").write.option("maxRecordsPerFile", per_file + 1).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the ARC files below ``path``, of either version."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(_read_arc, _PAYLOAD)


def assign_types(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """record_type and refers_to: of equal payloads of at least ``least`` bytes the largest page_id answers, others revisit it; without a page_id, a response."""
    sized = records.filter(F.col("payload_bytes") >= least)
    # only digests met twice; payloads are shuffled only where these are too many to broadcast
    answers = sized.groupBy("payload_digest").agg(F.max("page_id").alias("answer"), F.count("*").alias("n")).filter("n > 1").select("payload_digest", "answer")
    known = left_join_by_size(records, materialise(answers), "payload_digest")
    again = (F.col("payload_bytes") >= least) & (F.col("page_id") < F.col("answer"))
    return known.select(*records.columns, F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("answer")).alias("refers_to"))


def record_id(page_id: Column, nameless: Column | None = None) -> Column:
    """A name-based identifier, the same at every conversion; ``nameless`` is the name where page_id is null."""
    name = page_id.cast("string") if nameless is None else F.coalesce(page_id.cast("string"), nameless)
    h = F.sha1(F.concat(F.lit("recordgate:"), name))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(F.lit("8"), part(18, 3)), part(21, 12)), F.lit(">"))


def write_warc(records: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Write rows of ``assign_types`` as WARC 1.1 files. Revisits keep the HTTP head and no payload."""
    payload = F.col("payload").cast("string")
    head = F.concat(F.lit("HTTP/1.1 "), F.col("status").cast("string"), F.lit(" OK\r\nContent-Type: "), F.col("mime"), _page_line(F.col("page_id")), F.lit("\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("record_type") == "revisit", head).otherwise(F.concat(head, payload))
    date = F.date_format(F.to_timestamp("date", "yyyyMMddHHmmss"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    end = F.lit("\r\n")
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, end)
    named = F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", record_id(F.col("page_id"), F.concat("url", F.lit(" "), "payload_digest"))),
        field("WARC-Date", date),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(F.col("refers_to").isNotNull(), F.concat(field("WARC-Refers-To", record_id(F.col("refers_to"))), field("X-Refers-To-Page", F.col("refers_to").cast("string")), field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
    )
    lines = records.withColumn("block", block).select(F.concat(named, field("Content-Length", F.octet_length("block").cast("string")), end, F.col("block"), end).alias("value"))
    lines.write.option("maxRecordsPerFile", per_file).option("lineSep", "\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _read_warc(batches):
    for b in batches:
        for content in b.column(0):
            rows = []
            for named, block in parse_warc(_unzip(content.as_py())):
                if "error" in named or any(k not in named for k in _NEEDED):
                    continue
                head, payload = split_http(block)
                page = re.search(rb"\r\nX-Page-Id: (-?\d+)", head)
                refers = named.get("x-refers-to-page")
                digest = named["warc-payload-digest"].removeprefix("sha1:")
                if named["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {named['warc-record-id']} does not match its digest")
                rows.append((int(page[1]) if page else None, named["warc-target-uri"], named["warc-type"], int(refers) if refers else None, int(named["x-payload-length"]), digest, named["warc-record-id"], named["warc-date"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [()] * len(_BACK), _BACK, strict=True)], schema=_BACK)


#: Fields that a record must have to become a row.
_NEEDED = ("warc-type", "warc-record-id", "warc-target-uri", "warc-payload-digest", "warc-date", "x-payload-length")
_BACK = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_id", pa.string()), ("warc_date", pa.string())])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files below ``path``; response payloads are checked against their digests."""
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, record_id string, warc_date string"
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(_read_warc, schema)


def archive_rejects(spark: SparkSession, path: str) -> DataFrame:
    """file, at (byte of the unpacked file), reason of what could not be read in the ARC and WARC files below ``path``."""

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = _unzip(content.as_py())
                found = [n for n, _ in parse_warc(data)] if data.startswith(b"WARC/") else parse_arc(data)
                bad = [(name, r["at"], r["error"]) for r in found if "error" in r]
                columns = zip(*bad, strict=True) if bad else [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)], ["file", "at", "reason"])

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(run, "file string, at long, reason string")


def convert_pages(pages: DataFrame) -> DataFrame:
    """``pages`` written as ARC files of both versions, converted to WARC files, and read back.

    Null html is an empty payload. Rows without a page_id cannot be referred to and become responses.
    Repeated rows give repeated records. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    base = shared_dir(spark)
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    for version in (1, 2):
        write_arc(source.filter(F.coalesce(F.pmod("page_id", F.lit(2)), F.lit(0)) == version - 1), f"{base}/arc/v{version}", version)
    write_warc(assign_types(read_arc(spark, f"{base}/arc")), f"{base}/warc")
    return read_warc(spark, f"{base}/warc")


def op2_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = convert_pages(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
