"""WARC archives: a writer with revisits, and a reader that salvages what damaged archives still hold."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.llm.worker_cache import claim
from duplexa.shipping import ship

#: Bytes that one archive's records have about, before compression, unless one has more; a reading task holds one archive.
ARCHIVE_BYTES, RECORD_BYTES = 32 << 20, 512
#: Bytes of records that leave a task together.
BATCH_BYTES = 8 << 20
#: Bytes of a record's header at most.
HEADER_BYTES = 1 << 20

# Marks and names of the archive format.
MEMBER = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
END = b"\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:row:"
CONTROL = re.compile(rb"[\x00-\x08\x0a-\x1f\x7f]")
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")

RECORD = "archive string, offset long, length long, record_type string, uri string, id string, refers_to string, payload_digest string, payload_bytes long, payload binary"
GAP = "gap string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(record: bytes) -> bytes:
    made = zlib.compressobj(6, zlib.DEFLATED, 31)
    return made.compress(record) + made.flush()


def record_bytes(kind: str, block: bytes, fields: list[tuple[str, str]], date: str) -> bytes:
    """One record: version line, named fields, the block and what ends it."""
    named = [("WARC-Type", kind), ("WARC-Date", date), *fields, ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {_one_line(value)}\r\n" for name, value in named)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + END


def _one_line(value: str) -> str:
    """Control characters, which would end a field, and '%' written as %XX."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def _as_it_was(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def page_record(row_id, uri: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """A response with the payload, or a revisit with the response's head alone, which tells the payload's length."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Record-ID", f"<{ID}{'' if row_id is None else row_id}>"), ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload))]
    if uri is not None:
        fields.append(("WARC-Target-URI", uri))
    if refers_to is None:
        return record_bytes("response", head + payload, [*fields, ("Content-Type", "application/http;msgtype=response")], date)
    fields += [("WARC-Refers-To", f"<{ID}{refers_to}>"), ("WARC-Profile", REVISIT), ("Content-Type", "application/http;msgtype=response")]
    return record_bytes("revisit", head, fields, date)


def _records(date: str, compressed: bool):
    def run(batches):
        claim()
        for batch in batches:
            made, size = [], 0
            for row_id, uri, payload, refers_to in zip(*(batch.column(c).to_pylist() for c in ("id", "uri", "payload", "refers_to"))):
                record = page_record(row_id, uri, payload, refers_to, date)
                if compressed:
                    record = member(record)
                    # The writer adds a zero byte: the last of the member's length below 16 MB, padding after it beyond.
                    record = record if record[-1] else record[:-1]
                else:
                    record = record[:-1]
                made.append(record)
                size += len(record)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])
                    made, size = [], 0
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    return run


def with_references(rows: DataFrame, parts: int, least_bytes: int = 0) -> DataFrame:
    """``rows`` (id, payload, ...) with refers_to: the smallest id with the same payload, null in that row and for payloads below ``least_bytes``.

    Digests and ids alone are grouped, combined before the shuffle. Rows are dealt to
    ``parts`` by digest and a salt from their id, and joined there, with one row for each
    salt that a digest has: rows of one payload, a third of all perhaps, go everywhere.
    """
    keyed = rows.withColumns({"__digest": F.sha2("payload", 256), "__salt": F.pmod(F.xxhash64("id", "uri"), F.lit(parts))})
    first = keyed.where(F.octet_length("payload") >= least_bytes).groupBy("__digest", "__salt").agg(F.min("id").alias("__least"))
    whole = first.groupBy("__digest").agg(F.min("__least").alias("__first"), F.collect_set("__salt").alias("__salts"))
    known = whole.select("__digest", "__first", F.explode("__salts").alias("__salt"))
    found = F.when(~F.col("id").eqNullSafe(F.col("__first")), F.col("__first"))
    dealt = keyed.repartition(parts, "__digest", "__salt")
    return dealt.join(known, ["__digest", "__salt"], "left").withColumn("refers_to", found).drop("__digest", "__salt", "__first")


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    compressed: bool = True,
    least_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """A record for each row, in archives under ``path``; equal payloads are stored once and revisited.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the
    smallest id is a response, the others revisit it; rows that repeat that id are all
    responses. A row without an id revisits too, where another with its payload has one,
    and is a response otherwise. A null payload counts as empty, a null uri has no field.
    Records are members of gzip archives, or stand as they are. Executors write through
    Spark's text writer, whose commit keeps what lost tasks leave behind out; an archive
    holds about ARCHIVE_BYTES, so there are as many as the input needs. An existing folder is an error.
    """
    ship(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    size = rows.agg(F.sum(F.octet_length("payload") + RECORD_BYTES)).first()[0] or 0
    linked = with_references(rows, max(1, -(-size // ARCHIVE_BYTES)), least_bytes).select("id", "uri", "payload", "refers_to")
    made = linked.mapInArrow(_records(date, compressed), "value binary")
    made.select(F.col("value").cast("string")).write.option("lineSep", "\0" if compressed else "\n").text(path)


@dataclass
class Part:
    """What an archive holds from ``start`` to ``end``: a record's fields and block, or what was wrong with a gap."""

    start: int
    end: int
    fields: dict = field(default_factory=dict)
    block: bytes = b""
    gap: str | None = None


class Damage(Exception):
    """Why no record can be read; ``end``: where its frame ends, if that is sound and only the content is not."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def parse_record(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Fields, block and end of the record at ``at``; Damage where a check fails.

    Checked are the version line, the fields, the length, what ends the record, and the
    digests. Without a digest a record must be followed by another, a member or the end.
    """
    if not VERSION_LINE.match(data, at):
        raise Damage("no version line")
    stop = data.find(END, at, at + HEADER_BYTES)
    if stop < 0:
        raise Damage("header without an end")
    fields = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or CONTROL.search(line):
            raise Damage("a line of the header is no field")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or "warc-type" not in fields:
        raise Damage("no length or type")
    begin = stop + len(END)
    end = begin + int(length)
    if data[end : end + len(END)] != END:
        raise Damage("length does not lead to the record's end")
    after = end + len(END)
    block = data[begin:end]
    told = [(fields.get("warc-block-digest"), block)]
    if fields["warc-type"] == "response":
        told.append((fields.get("warc-payload-digest"), payload_of(fields, block)))
    checks = [_agrees(*pair) for pair in told]
    followed = after == len(data) or data.startswith((VERSION, MEMBER), after)
    if False in checks:
        raise Damage("digest differs", after if followed else None)
    if not (followed or True in checks):
        raise Damage("no record follows")
    return fields, block, after


def _agrees(digest: str | None, data: bytes) -> bool | None:
    """Whether data has the digest; None for digests in other forms than SHA-1 in base32, which are not checked."""
    kind, _, value = (digest or "").partition(":")
    return value.upper() == base32_sha1(data) if kind.lower() == "sha1" and len(value) == 32 else None


def payload_of(fields: dict, block: bytes) -> bytes:
    """What follows the head of an HTTP message; the whole block of other records."""
    if not fields.get("content-type", "").startswith("application/http"):
        return block
    return block.partition(END)[2]


def _inflate(data, at: int) -> tuple[bytes, int]:
    """A gzip member's content and end; Damage where its stream, check sum or length is wrong."""
    reader = zlib.decompressobj(31)
    out = []
    try:
        for begin in range(at, len(data), 1 << 20):
            out.append(reader.decompress(data[begin : begin + (1 << 20)]))
            if reader.eof:
                return b"".join(out), min(len(data), begin + (1 << 20)) - len(reader.unused_data)
            if begin == at and not out[0].startswith(VERSION[: len(out[0])]):
                raise Damage("member holds no record")
    except zlib.error as error:
        raise Damage(f"member does not inflate ({str(error).split(':')[0]})") from None
    raise Damage("member without an end")


def parts(data: bytes):
    """Records and gaps of an archive, in order; together they cover it, but for zero bytes that pad members.

    After a failed check, reading goes on at the next place at which a member or a version
    line begins and a record passes all checks; the bytes between are one gap. Where a
    record's frame is sound and a digest is not, its bytes alone are the gap, and nothing
    that its block may hold is taken for a record.
    """
    view = memoryview(data)
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            if data.startswith(MEMBER, at):
                inner, end = _inflate(data, at)
                found, place = [], 0
                while place < len(inner):
                    fields, block, place = parse_record(inner, place)
                    found.append((fields, block))
                if not found:
                    raise Damage("member holds no record")
            elif data.startswith(VERSION, at):
                fields, block, end = parse_record(data, at)
                found = [(fields, block)]
            elif view[at] == 0 and gap is None and at:
                at = _past_zeros(data, at)
                continue
            else:
                raise Damage("no member and no version line")
        except Damage as damage:
            if gap is None:
                gap, reason = at, str(damage)
            if damage.end is not None and data.startswith(VERSION, at):
                yield Part(gap, damage.end, gap=reason)
                at, gap = damage.end, None
                continue
            at = _next_mark(data, at + 1)
            continue
        if gap is not None:
            yield Part(gap, at, gap=reason)
            gap = None
        for fields, block in found:
            yield Part(at, end, fields, block)
        at = end
    if gap is not None:
        yield Part(gap, len(data), gap=reason)


def _past_zeros(data: bytes, at: int) -> int:
    found = re.compile(rb"\0*").match(data, at)
    return found.end()


MARK = re.compile(re.escape(MEMBER) + b"|" + re.escape(VERSION))


def _next_mark(data: bytes, at: int) -> int:
    found = MARK.search(data, at)
    return found.start() if found else len(data)


def _told_id(value: str | None) -> str | None:
    """The id in ``<urn:row:ID>``; other ids without their brackets."""
    if value is None:
        return None
    value = value.strip("<>")
    return value.removeprefix(ID) or None


def described(part: Part) -> dict:
    """A record's row but for its payload: of a revisit, the length that its response's head tells."""
    fields = part.fields
    digest = (fields.get("warc-payload-digest") or "").partition(":")[2].upper() or None
    row = {"record_type": fields["warc-type"], "uri": None if "warc-target-uri" not in fields else _as_it_was(fields["warc-target-uri"])}
    row |= {"id": _told_id(fields.get("warc-record-id")), "refers_to": _told_id(fields.get("warc-refers-to"))}
    if row["record_type"] == "revisit":
        told = re.search(rb"(?mi)^content-length:[ \t]*(\d+)\r$", part.block.partition(END)[0] + b"\r\n")
        return row | {"payload_digest": digest, "payload_bytes": int(told[1]) if told else None, "payload": None}
    payload = payload_of(fields, part.block)
    return row | {"payload_digest": base32_sha1(payload), "payload_bytes": len(payload), "payload": payload}


NAMES = [c.split()[0] for c in f"{RECORD}, {GAP}".split(", ")]
TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
SCHEMA = pa.schema([(c.split()[0], TYPES[c.split()[1]]) for c in f"{RECORD}, {GAP}".split(", ")])


def _salvage(payloads: bool):
    def run(batches):
        claim()
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, size = [], 0
                for part in parts(content.as_py() or b""):
                    row = dict.fromkeys(NAMES) | {"archive": path.as_py(), "offset": part.start, "length": part.end - part.start, "gap": part.gap}
                    if part.gap is None:
                        row |= described(part)
                        if not payloads:
                            row["payload"] = None
                    rows.append(row)
                    size += len(row["payload"] or b"") + 512
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    return run


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """What the archives under ``path`` hold, records and quarantined gaps, each with its archive, offset and length.

    A record's row tells its type, uri, id, what it revisits, its payload and the payload's
    digest and length; digests are of the bytes read. A gap's row has only its place and,
    in ``gap``, why reading failed there: the log of what was left out. Every archive is
    read whole by one task, so archives should be of a usual size (1 GB at most); files
    that hold nothing give no rows. With ``payloads`` off, payloads stay in the tasks.
    """
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_salvage(payloads), f"{RECORD}, {GAP}")


def records(found: DataFrame) -> DataFrame:
    return found.where("gap IS NULL").drop("gap")


def gaps(found: DataFrame) -> DataFrame:
    """(archive, offset, length, gap): byte ranges that no record was read from, and why."""
    return found.where("gap IS NOT NULL").select("archive", "offset", "length", "gap")
