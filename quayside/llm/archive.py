"""Legacy ARC archives read by their header lines and declared lengths, and turned into WARC records.

An ARC file begins with a record about itself, which names the version and the fields of the header lines: five in version 1, ten in
version 2. Each record is a header line and as many bytes as its last field declares. A WARC record gets its identifier from the place of
the ARC record, its time from the archive date, its type from scheme and content, and its digests from block and payload.
A payload that another record has too is kept once: the others become revisits of it.

Archives are written by Spark's text writer, whose line separator is what ends a record, so a task that runs again leaves nothing half
written. They are read by Spark's text reader; a task joins the lines of a file again, one record at a time, so a file of any size needs
the memory of its largest record. Compressed files are read whole by one task. A file without compression must fit one split.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.frames import col
from quayside.llm.registry import query
from quayside.operators.lookup import lookup
from quayside.session import checkpoint, scratch_path

# The fields of a header line by version, as the archive format names them, and what WARC calls its record types and profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
RESPONSE, RESOURCE, REVISIT, WARCINFO = "response", "resource", "revisit", "warcinfo"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
#: How archives are compressed: the fastest level takes a third of the time for an eighth more bytes.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

#: What a date gives that is no date, where the archive has none either.
NO_DATE = "1970-01-01T00:00:00Z"
#: The header of a stored response that holds its page's key.
KEY_HEADER = "X-Record-Key"
#: Bytes of records handed on at a time.
BATCH_BYTES = 1 << 22


# -- writing ARC


def _first_of_file() -> Column:
    """Whether a row is the first of its task, and so of the file that the task writes."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0


def _bytes(text: Column) -> Column:
    return F.octet_length(text).cast("string")


def http_response(payload: Column, key: Column) -> Column:
    """A stored response: status line, headers, an empty line and the payload, which is empty if null."""
    payload = F.coalesce(payload, F.lit(""))
    lines = [
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), _bytes(payload)),
        F.concat(F.lit(f"{KEY_HEADER}: "), F.coalesce(key.cast("string"), F.lit("-"))),
        F.lit(CRLF),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), payload)


def write_arc(pages: DataFrame, folder: str, version: int, at: datetime, url: str = "url", payload: str = "html", key: str = "page_id") -> None:
    """Write a response per row into gzipped ARC files, one per task.

    White space and control characters in a URL become ``%20``, a null or empty URL becomes ``-``. An empty table gives files without records.
    """
    date = at.astimezone(timezone.utc).strftime("%Y%m%d%H%M%S")
    about = f"{version} 0 quayside\n{ARC_FIELDS[version]}\n"
    block = http_response(col(payload), col(key))
    address = F.regexp_replace(F.coalesce(F.nullif(col(url), F.lit("")), F.lit("-")), r"[\x00-\x20\x7f]", "%20")
    fields = [address, F.lit("0.0.0.0"), F.lit(date), F.lit("text/html")]
    about_fields = ["filedesc://quayside.arc", "0.0.0.0", date, "text/plain"]
    if version == 2:
        fields += [F.lit("200"), F.md5(block), F.lit("-"), F.lit("0"), F.lit("quayside.arc")]
        about_fields += ["200", "-", "-", "0", "quayside.arc"]
    first = " ".join([*about_fields, str(len(about))]) + "\n" + about + "\n"
    record = F.concat(F.concat_ws(" ", *fields, _bytes(block)), F.lit("\n"), block)
    pages.select(F.concat(F.when(_first_of_file(), F.lit(first)).otherwise(""), record).alias("value")).write.options(**PACKED).text(folder, lineSep="\n")


# -- reading both


class _Stream:
    """The bytes of one file, given its lines with their ends."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.rest, self.at = lines, b"", 0

    def line(self) -> bytes | None:
        """The rest of the line without its end, or None at the end of the file."""
        text = self.rest or next(self.lines, b"")
        if not text:
            return None
        line, end, self.rest = text.partition(b"\n")
        self.at += len(line) + len(end)
        return line

    def take(self, size: int) -> bytes:
        """So many bytes, fewer at the end of the file."""
        parts, lacking = [], size
        while lacking > 0:
            text = self.rest or next(self.lines, b"")
            if not text:
                break
            parts.append(text[:lacking])
            self.rest = text[lacking:]
            lacking -= len(parts[-1])
        self.at += size - lacking
        return b"".join(parts)


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _text(data: bytes) -> str:
    return data.decode("utf-8", "replace")


def http_head(block: bytes, is_http: bool = True) -> tuple[int, list[tuple[str, str]]]:
    """Where the payload of a block begins, and the HTTP headers before it, their names in lower case. A block without an HTTP status line is all payload."""
    if not is_http or not block.startswith(b"HTTP/"):
        return 0, []
    ends = [m.end() for m in (re.search(rb"\r?\n\r?\n", block),) if m]
    end = ends[0] if ends else len(block)
    found: dict[str, str] = {}
    for line in re.split(rb"\r?\n", block[:end])[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            found.setdefault(_text(name.strip()).lower(), _text(value.strip()))
    return end, list(found.items())


def _of_block(block: bytes, is_http: bool = True) -> dict:
    start, http = http_head(block, is_http)
    payload = memoryview(block)[start:]
    return {
        "http": http,
        "head_length": start,
        "payload_length": len(payload),
        "payload_digest": _digest(payload),
        "block_digest": _digest(block),
        "head_digest": _digest(block[:start]),
        "block": block,
    }


OF_BLOCK = (
    "http map<string,string>, head_length bigint, payload_length bigint, payload_digest string, "
    "block_digest string, head_digest string, block binary"
)
ARC_SCHEMA = (
    "file string, at bigint, version int, archive_date string, url string, ip string, date string, content_type string, "
    f"status string, checksum string, location string, declared bigint, error string, {OF_BLOCK}"
)
# The names of the fields of a header line and of their columns.
ARC_COLUMNS = {
    "URL": "url",
    "IP-address": "ip",
    "Archive-date": "date",
    "Content-type": "content_type",
    "Result-code": "status",
    "Checksum": "checksum",
    "Location": "location",
    "Offset": "offset",
    "Filename": "filename",
    "Archive-length": "declared",
}


def arc_header(line: bytes, fields: list[str]) -> dict | None:
    """The fields of a header line, None if it is none. A URL may hold spaces, the other fields don't."""
    parts = _text(line.rstrip(b"\r")).rsplit(" ", len(fields) - 1)
    if len(parts) != len(fields) or not parts[0]:
        return None
    values = {ARC_COLUMNS[f]: None if v in ("-", "") else v for f, v in zip(fields, parts)}
    if not re.fullmatch(r"\d{1,18}", values["declared"] or "", re.ASCII) or not re.fullmatch(r"\d{4,17}", values["date"] or "0000", re.ASCII):
        return None
    return values | {"declared": int(values["declared"])}


def arc_records(stream: _Stream) -> Iterator[dict]:
    """The records of an ARC file. Lines that are no header where one is due are one record with an error, and so is a record cut short."""
    version, fields, date, lost = None, None, None, None
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        at = stream.at - len(line) - 1
        layouts = [fields] if fields else [ARC_FIELDS[v].split() for v in ((2, 1) if line.startswith(b"filedesc:") else (1,))]
        head = next((h for f in layouts if (h := arc_header(line, f))), None)
        if head is None:
            lost = at if lost is None else lost
            continue
        if lost is not None:
            yield {"at": lost, "version": version, "archive_date": date, "error": "no header line", **_of_block(b"")}
            lost = None
        block = stream.take(head["declared"])
        if at == 0 and (head["url"] or "").startswith("filedesc:"):
            about = block.split(b"\n")
            version = int(about[0].split()[0]) if about[0][:1].isdigit() and about[0].split()[0].isdigit() else 1
            named = _text(about[1]).split() if len(about) > 1 else []
            fields = named if named and named[-1] == "Archive-length" and set(named) <= set(ARC_COLUMNS) else ARC_FIELDS.get(version, ARC_FIELDS[1]).split()
            date = head["date"]
        error = None if len(block) == head["declared"] else "cut short"
        yield {"at": at, "version": version, "archive_date": date, "error": error, **head, **_of_block(block)}
    if lost is not None:
        yield {"at": lost, "version": version, "archive_date": date, "error": "no header line", **_of_block(b"")}


WARC_SCHEMA = f"file string, at bigint, fields map<string,string>, error string, {OF_BLOCK}"


def warc_records(stream: _Stream) -> Iterator[dict]:
    """The records of a WARC file. A record is checked against its declared length and digests; what is no record is one with an error."""
    lost = None
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        at = stream.at - len(line) - 1
        if not line.startswith(b"WARC/"):
            lost = at if lost is None else lost
            continue
        if lost is not None:
            yield {"at": lost, "fields": [], "error": "no record", **_of_block(b"")}
            lost = None
        fields: dict[str, str] = {}
        while (line := stream.line()) is not None and line.strip():
            name, _, value = line.partition(b":")
            fields.setdefault(_text(name.strip()).lower(), _text(value.strip()))
        declared = fields.get("content-length", "")
        if not re.fullmatch(r"\d{1,18}", declared, re.ASCII):
            yield {"at": at, "fields": list(fields.items()), "error": "no length", **_of_block(b"")}
            continue
        block = stream.take(int(declared))
        row = {"at": at, "fields": list(fields.items()), **_of_block(block, fields.get("content-type", "").startswith("application/http"))}
        error = None
        if len(block) < int(declared):
            error = "cut short"
        elif fields.get("warc-block-digest", "sha1:" + row["block_digest"]) != "sha1:" + row["block_digest"]:
            error = "block digest differs"
        elif fields.get("warc-type") != REVISIT and fields.get("warc-payload-digest", "sha1:" + row["payload_digest"]) != "sha1:" + row["payload_digest"]:
            error = "payload digest differs"
        yield row | {"error": error}
    if lost is not None:
        yield {"at": lost, "fields": [], "error": "no record", **_of_block(b"")}


def _read(spark: SparkSession, folder: str | list[str], parse: Callable[[_Stream], Iterable[dict]], schema: str, blocks: bool) -> DataFrame:
    """The records of all files of a folder, in the order of each file."""
    kept = [f for f in re.split(r", (?=\w+ )", schema) if blocks or not f.startswith("block ")]
    names = [f.split()[0] for f in kept]
    of_map = pa.map_(pa.string(), pa.string())
    by_name = {"http": of_map, "fields": of_map, "block": pa.binary(), "version": pa.int32()}
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    arrow = pa.schema([(n, by_name.get(n) or kinds[f.split()[1]]) for n, f in zip(names, kept)])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            for file, start, value in zip(*(batch.column(n).to_pylist() for n in ("file", "start", "value"))):
                if start:
                    raise ValueError(f"{file} is cut into splits: compress it, or raise spark.sql.files.maxPartitionBytes above its size")
                yield file, value + b"\n"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for file, of_file in itertools.groupby(lines(batches), key=lambda row: row[0]):
            for row in parse(_Stream(line for _, line in of_file)):
                rows.append({"file": file, **row})
                size += 1024 + (row["head_length"] + row["payload_length"] if blocks else 0)
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], arrow.field(n).type) for n in names], schema=arrow)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], arrow.field(n).type) for n in names], schema=arrow)

    text = spark.read.option("lineSep", "\n").text(folder)
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    return text.select(*place, F.col("value").cast("binary").alias("value")).mapInArrow(step, ", ".join(kept))


def read_arc(spark: SparkSession, folder: str | list[str], blocks: bool = True) -> DataFrame:
    """The records of all ARC files of a folder: file and place, the fields of the header line (``-`` is null), the block and what it holds.

    ``error`` says what is wrong with a record: "no header line" for lines that a reader must pass over to the next header line, "cut short" for
    a record with less than its declared bytes. An empty folder gives no rows. Without ``blocks`` the block itself is left out.
    """
    return _read(spark, folder, arc_records, ARC_SCHEMA, blocks)


def read_warc(spark: SparkSession, folder: str | list[str], blocks: bool = True) -> DataFrame:
    """The records of all WARC files of a folder: file and place, all fields (names in lower case), the block and what it holds.

    ``error`` tells records that are cut short, have no length or other digests than they declare. A revisit's block has no payload.
    """
    return _read(spark, folder, warc_records, WARC_SCHEMA, blocks)


# -- converting


def warc_date(date: Column, other: Column) -> Column:
    """An archive date of 4 to 17 digits as WARC writes times, or the other date, or the first second of 1970 if neither is a date."""

    def read(digits: Column) -> Column:
        whole = F.concat(F.substring(digits, 1, 14), F.substring(F.lit("00000101000000"), F.length(digits) + 1, F.lit(14)))
        plain = F.regexp_replace(whole, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
        return F.when(digits.rlike(r"^\d{4}(\d\d){0,5}(\d{3})?$") & F.try_to_timestamp(whole, F.lit("yyyyMMddHHmmss")).isNotNull(), plain)

    return F.coalesce(read(date), read(other), F.lit(NO_DATE))


def _uuid(text: Column) -> Column:
    """A name-based identifier: the SHA-1 of the name with the version and variant bits in their places."""
    h = F.sha1(text)
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    parts = F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def convert(records: DataFrame) -> DataFrame:
    """ARC records, as read, as WARC records; those with an error stay behind.

    An archive's record about itself, its first, is of type warcinfo, a block that begins with an HTTP status line of type response, all else of type resource. The identifier
    depends on the file's name and the place in it alone, so it comes out the same when a task runs again. Repeated records have places, and so identifiers,
    of their own.
    """
    about = F.coalesce(F.col("url").startswith("filedesc:"), F.lit(False)) & (F.col("at") == 0)
    kind = F.when(about, WARCINFO).when(F.col("head_length") > 0, RESPONSE).otherwise(RESOURCE)
    name = F.substring_index("file", "/", -1)
    whole = F.col("type") == RESPONSE
    good = records.where("error is null").withColumn("type", kind)
    return good.select(
        "type",
        _uuid(F.concat_ws(" ", name, F.col("at").cast("string"))).alias("record_id"),
        warc_date(F.col("date"), F.col("archive_date")).alias("warc_date"),
        F.when(F.col("type") != WARCINFO, F.col("url")).alias("target"),
        F.nullif(F.col("ip"), F.lit("0.0.0.0")).alias("ip"),
        F.when(whole, F.lit("application/http; msgtype=response")).otherwise(F.coalesce("content_type", F.lit("application/octet-stream"))).alias("content_type"),
        *(c for c in good.columns if c in ("head_length", "payload_length", "payload_digest", "block_digest", "head_digest", "http", "block")),
    )


def _payload_key(least: int) -> Column:
    takes_part = F.col("type").isin(RESPONSE, RESOURCE) & (F.col("payload_length") >= least)
    return F.when(takes_part, F.concat_ws(":", "payload_digest", F.col("payload_length").cast("string")))


def shared_payloads(records: DataFrame, newest: Column, least: int = 0) -> DataFrame:
    """The payloads that several records have, with the record that keeps it: the one with the greatest ``newest``, of several the one with the greatest identifier.

    Records are counted before the shuffle, so a payload with any number of copies is a row per task there.
    """
    rows = records.select(_payload_key(least).alias("payload"), F.struct(newest.alias("rank"), "record_id", "target", "warc_date").alias("kept"))
    groups = rows.where("payload is not null").groupBy("payload").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    return groups.where("n > 1").select("payload", "kept.record_id", "kept.target", "kept.warc_date")


def revisit(records: DataFrame, shared: DataFrame, least: int = 0) -> DataFrame:
    """Turn records into revisits of the record that keeps their payload: without payload, but with its digest.

    ``shared`` is broadcast where its measured size is small, else joined with salted keys, so a payload of a third of all records spreads over many tasks.
    """
    named = shared.select(F.col("payload").alias("_payload"), *(F.col(c).alias(f"refers_{c}") for c in ("record_id", "target", "warc_date")))
    joined = lookup(records.withColumn("_payload", _payload_key(least)), named, ["_payload"], salt=F.xxhash64("record_id"))
    again = F.col("refers_record_id") != F.col("record_id")
    joined = joined.withColumn("type", F.when(again, F.lit(REVISIT)).otherwise(F.col("type")))
    for name in ("refers_record_id", "refers_target", "refers_warc_date"):
        joined = joined.withColumn(name, F.when(F.col("type") == REVISIT, F.col(name)))
    return joined.drop("_payload")


def write_warc(records: DataFrame, folder: str, at: datetime) -> None:
    """Write records into gzipped WARC files, one per task, each beginning with a record about the file. A file is one gzip member."""
    again, about = F.col("type") == REVISIT, F.col("type") == WARCINFO
    block = F.when(again, F.substring(F.col("block"), F.lit(1), F.col("head_length").cast("int"))).otherwise(F.col("block")).cast("string")

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    def digest(name: str) -> Column:
        return F.concat(F.lit("sha1:"), F.col(name))

    head = F.concat_ws(
        CRLF,
        F.lit(WARC_VERSION),
        field("WARC-Type", F.col("type")),
        field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Date", F.col("warc_date")),
        field("WARC-Target-URI", F.col("target")),
        field("WARC-IP-Address", F.col("ip")),
        F.when(again, field("WARC-Profile", F.lit(SAME_PAYLOAD))),
        field("WARC-Refers-To", F.col("refers_record_id")),
        field("WARC-Refers-To-Target-URI", F.col("refers_target")),
        field("WARC-Refers-To-Date", F.col("refers_warc_date")),
        field("WARC-Block-Digest", F.when(again, digest("head_digest")).otherwise(digest("block_digest"))),
        F.when(~about, field("WARC-Payload-Digest", digest("payload_digest"))),
        field("Content-Type", F.col("content_type")),
        field("Content-Length", _bytes(block)),
    )
    about_text = f"software: quayside{CRLF}format: WARC File Format 1.1{CRLF}"
    date = at.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    lines = [WARC_VERSION, f"WARC-Type: {WARCINFO}", f"WARC-Date: {date}", "Content-Type: application/warc-fields", f"Content-Length: {len(about_text)}"]
    identity = F.concat(F.lit(f"{CRLF}WARC-Record-ID: "), _uuid(F.concat(F.lit("about "), F.col("record_id"))), F.lit(CRLF * 2 + about_text + CRLF * 2))
    first = F.when(_first_of_file(), F.concat(F.lit(CRLF.join(lines)), identity)).otherwise("")
    records.select(F.concat(first, head, F.lit(CRLF * 2), block).alias("value")).write.options(**PACKED).text(folder, lineSep=CRLF * 2)


ORACLE = """
with p as (select page_id, coalesce(html, '') as h from pages),
     d as (select *, octet_length(encode(h)) as payload_bytes, sha1(h) as x, max(page_id) over (partition by h) as kept from p)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           cast((('0x' || substr(x, cast(i // 4 * 5 + 1 as bigint), 5))::bigint >> cast(15 - i % 4 * 5 as bigint)) & 31 as bigint) + 1, 1)), '') as payload_digest,
       case when page_id = kept then 'response' else 'revisit' end as record_type,
       case when page_id <> kept then kept end as refers_to
from d
"""


@query(ORACLE)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as ARC files of both versions, converted to WARC files, which are read back.

    A null page_id stays null, null html is empty. Rows of one page_id have records of their own; of those with equal payloads all but one are revisits.
    """
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folders = [scratch_path(spark, f"arc-{version}") for version in ARC_FIELDS]
    for version, folder in zip(ARC_FIELDS, folders):
        write_arc(pages.where(F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(2)) == version - 1), folder, version, at)
    key = F.expr(f"try_cast(element_at(http, '{KEY_HEADER.lower()}') as bigint)")
    # the blocks are read a second time instead of being kept beside the archives
    shared = checkpoint(shared_payloads(convert(read_arc(spark, folders, blocks=False)), key))
    folder = scratch_path(spark, "warc")
    write_warc(revisit(convert(read_arc(spark, folders)), shared), folder, at)

    def of(name: str) -> Column:
        return F.element_at("fields", name)

    read = read_warc(spark, folder, blocks=False).where(F.coalesce(of("warc-type") != WARCINFO, F.lit(True)))
    read = read.withColumn("type", F.when(F.col("error").isNotNull(), F.raise_error(F.concat_ws(": ", "file", "error"))).otherwise(of("warc-type")))
    found = checkpoint(
        read.select(
            key.alias("page_id"),
            "payload_length",
            F.substring_index(of("warc-payload-digest"), ":", -1).alias("payload_digest"),
            F.col("type").alias("record_type"),
            of("warc-record-id").alias("record_id"),
            of("warc-refers-to").alias("refers_id"),
        )
    )
    asked = found.where("refers_id is not null").select(F.col("refers_id").alias("record_id")).distinct()
    kept = found.join(asked, "record_id").select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), F.col("payload_length").alias("kept_length"))
    resolved = lookup(found, checkpoint(kept), ["refers_id"], salt=F.xxhash64("record_id"))
    length = F.when(F.col("record_type") == REVISIT, F.col("kept_length")).otherwise(F.col("payload_length"))
    return resolved.select("page_id", length.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
