"""WARC archives: a writer for pages and a reader that salvages damaged files.

Records are gzip members of their own, as the format advises. Spark's text sink writes them: a member is one line,
and the line separator is an empty gzip member, which readers of concatenated members skip. So the files go to any storage that Spark
can write to, under its commit protocol, and a lost executor leaves no half of a file.

The reader checks every record: the member must inflate, lengths and digests must
agree. After a failed check it searches on for the next place where a member or a version line starts a record
that passes, goes on from there, and reports the bytes between as a gap with the reason. The same search runs inside a member, which may hold many
records, and inside what a damaged one yields before its damage; there only records whose digest agrees are believed, and of a member that inflates
whole but fails its checksum, only if another of its records shows the damage.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmart.llm.common import scratch, small, stage

MIN_REVISIT = 1000
GROUP_ROWS = 200_000
FILE_BYTES = 64 << 20  # of members in a file, unless one alone is larger: a file is read as a whole
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)

_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return "urn:page:" + ("" if page_id is None else str(page_id))


def page_of(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix("urn:page:")
    return int(number) if re.fullmatch(r"-?\d+", number) else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One record, not compressed. A revisit holds the HTTP head alone, which tells the length of the payload left out."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{page_urn(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{page_urn(refers_to)}>"]
    lines += [f"WARC-Payload-Digest: {_sha1(payload)}", f"WARC-Block-Digest: {_sha1(block)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    """A record that passed all checks; ``block`` starts with an HTTP head if the payload came by HTTP."""

    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    @property
    def payload(self) -> bytes:
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block

    @property
    def payload_bytes(self) -> int:
        """Length of the full payload; of a revisit, as its HTTP head tells."""
        if self.headers.get("warc-type") == "revisit":
            told = re.search(rb"(?im)^content-length:[ \t]*(\d+)", self.block)
            return int(told[1]) if told else 0
        return len(self.payload)

    @property
    def payload_digest(self) -> str | None:
        """SHA-1 of the full payload in hexadecimal digits; of a revisit, as its header tells."""
        if self.headers.get("warc-type") != "revisit":
            return hashlib.sha1(self.payload).hexdigest()
        told = self.headers.get("warc-payload-digest", "")
        if not told.lower().startswith("sha1:"):
            return None
        value = told[5:]
        return value.lower() if len(value) == 40 else base64.b32decode(value).hex()


class Damaged(Exception):
    """A check failed."""


def _parse(data: bytes, at: int) -> tuple[Record, int]:
    """The record at ``at`` and the place behind it."""
    if not _START.match(data, at) or data[at] == 0x1F:
        raise Damaged("no version line")
    body = data.find(b"\r\n\r\n", at)
    if body < 0:
        raise Damaged("header does not end")
    headers = {}
    for line in data[at:body].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without colon")
        headers[name.strip().lower()] = value.strip()
    if not headers.get("content-length", "").isdigit():
        raise Damaged("no length")
    start = body + 4
    end = start + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("record does not end where its length says")
    found = Record(headers, data[start:end])
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest != _sha1(found.block):
        raise Damaged("block digest differs")
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and digest.startswith("sha1:") and digest != _sha1(found.payload):
        raise Damaged("payload digest differs")
    return found, end + 4


def _inflate(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``at`` yields, the place behind it, and what is wrong with it."""
    machine, parts, view, end = zlib.decompressobj(31), [], memoryview(data), at
    while not machine.eof and end < len(data):
        before = machine.copy()
        try:
            parts.append(machine.decompress(view[end : end + step]))
        except zlib.error as e:
            while step > 1:  # up to the damage, byte by byte in the end
                step = max(1, step // 16)
                try:
                    while True:
                        trial = before.copy()
                        parts.append(trial.decompress(view[end : end + step]))
                        before, end = trial, end + step
                except zlib.error:
                    continue
            return b"".join(parts), end, f"gzip: {e}"
        end += step
    if not machine.eof:
        return b"".join(parts), len(data), "member is cut off"
    return b"".join(parts), min(end, len(data)) - len(machine.unused_data), None


@dataclass
class Found:
    """A record or a gap: bytes of the file, and, inside a member with more than one of them, bytes of what it inflates to."""

    start: int
    end: int
    record: Record | None = None
    reason: str | None = None
    inner_start: int | None = None
    inner_end: int | None = None


def _plain(data: bytes, only_sure: bool) -> Iterator[Found]:
    """Records and gaps of data that is not compressed."""
    at, gap, reason = 0, None, None
    while at < len(data):
        try:
            if data[at : at + 2] == b"\r\n" and gap is None:
                at += 2
                continue
            record, end = _parse(data, at)
            if only_sure and not {"warc-block-digest", "warc-payload-digest"} & record.headers.keys():
                raise Damaged("no digest in a damaged member")
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            following = _VERSION.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield Found(gap, at, None, reason)
            gap = None
        yield Found(at, end, record)
        at = end
    if gap is not None:
        yield Found(gap, len(data), None, reason)


def salvage(data: bytes) -> Iterator[Found]:
    """Everything in an archive, in order; gaps have no record but the reason of the first failed check."""
    at, gap = 0, None
    while at < len(data):
        inside, end, wrong = [], at, None
        if data[at : at + 3] == b"\x1f\x8b\x08":
            inner, end, wrong = _inflate(data, at)
            inside = list(_plain(inner, wrong is not None))
            if wrong is not None and wrong.endswith(("data check", "length check")) and all(f.record for f in inside):
                inside = []  # the damage may be in a header, which no digest covers
            if inside and inside[-1].record is None and (wrong is not None or len(inside) == 1):
                last = inside.pop()  # what follows the last record is part of the gap that begins here
                wrong = wrong or last.reason
                inner = inner[: last.start]
        elif data[at : at + 2] == b"\r\n" and gap is None:
            end = at + 2
        else:
            try:
                record, end = _parse(data, at)
                inside, inner = [Found(at, end, record)], None
            except Damaged as e:
                wrong = str(e)
        good = any(f.record for f in inside)
        if gap is not None and (good or wrong is None):
            gap.end = at
            yield gap
            gap = None
        if good or wrong is None:
            for f in inside:
                if inner is None:
                    yield f
                elif wrong is None and len(inside) == 1:
                    yield Found(at, end, f.record, f.reason)
                else:
                    yield Found(at, end, f.record, f.reason, f.start, f.end)
        if wrong is None:
            at = end
            continue
        if gap is None:
            gap = Found(at, at, None, wrong, inside[-1].end if good else None)
        following = _START.search(data, at + 1)
        at = following.start() if following else len(data)
    if gap is not None:
        gap.end = len(data)
        yield gap


def write_archives(pages: DataFrame, path: str, level: int = 1, min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> None:
    """Write a record per row of ``pages(page_id, url, html)`` to archives in the folder ``path``.

    Of rows with equal payloads of at least ``min_revisit`` bytes the one with the largest page_id becomes a response and the others revisit
    it; if several rows share that page_id and payload, each becomes a response. A NULL page_id is smaller than any. A NULL html
    is an empty payload; a NULL url is left out of the record. Only payload digests are compared and moved, never payloads.
    A task starts another file, in a folder of its own number, when the members of one would exceed ``file_bytes``.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    known = rows.select("page_id", F.sha2("payload", 256).alias("sha"), F.octet_length("payload").alias("n")).filter(F.col("n") >= min_revisit)
    groups = known.groupBy("sha").agg(F.max("page_id").alias("best"), F.count("*").alias("rows")).filter("rows > 1").select("sha", "best")
    groups = small(stage(groups, "warc-groups"), GROUP_ROWS)
    own = rows.withColumn("_sha", F.when(F.octet_length("payload") >= min_revisit, F.sha2("payload", 256)))
    # Ids go to Python as text: pandas would turn numbers next to a NULL into floats.
    decided = own.join(groups, F.col("_sha") == F.col("sha"), "left").select(
        F.col("page_id").cast("string"), "url", "payload", F.col("best").cast("string"), (F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))).alias("revisit")
    )

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, size = 0, 0
        for batch in batches:
            ids = [None if i is None else int(i) for i in batch["page_id"]]
            best = [None if i is None else int(i) for i in batch["best"]]
            columns = zip(ids, batch["url"], batch["payload"], best, batch["revisit"], strict=True)
            packed = [gzip.compress(record(i, u, p, b, r), level, mtime=0) for i, u, p, b, r in columns]
            numbers = []
            for m in packed:
                if size and size + len(m) > file_bytes:
                    file, size = file + 1, 0
                size += len(m)
                numbers.append(file)
            yield pd.DataFrame({"m": packed, "file": numbers})

    lines = decided.mapInPandas(members, "m binary, file int").select(F.col("m").cast("string").alias("value"), "file")
    writer = lines.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
    writer.partitionBy("file").text(path)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """What the archives in ``path`` and below hold, one row per record or gap: files named ``*.warc*`` or ``*.txt*``, compressed or not.

    Columns: ``file, start, end`` (bytes of the file), ``inner_start, inner_end`` (bytes inside the inflated member, where it holds more than one
    record or a gap; for a gap after the records of a damaged member, where it begins), ``reason`` (of a gap, else NULL), ``page_id, url, record_type,
    payload_bytes, payload_digest, refers_to`` and, if wanted, ``payload`` (NULL for revisits). An empty file gives no rows. A file is
    one row of Spark's binary source, so it must stay below 2 GB and fit an executor.
    """
    schema = (
        "file string, start long, end long, inner_start long, inner_end long, reason string, page_id long, url string, record_type string, "
        "payload_bytes long, payload_digest string, refers_to long" + (", payload binary" if with_payload else "")
    )
    columns = [part.split()[0] for part in schema.split(", ")]

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, data in zip(batch["path"], batch["content"], strict=True):
                rows, size = [], 0
                for one in salvage(bytes(data)):
                    found, row = one.record, [file, one.start, one.end, one.inner_start, one.inner_end, one.reason]
                    if found is None:
                        row += [None] * (len(columns) - len(row))
                    else:
                        h, kind = found.headers, found.headers.get("warc-type")
                        row += [page_of(h.get("warc-record-id")), h.get("warc-target-uri"), kind, found.payload_bytes, found.payload_digest]
                        row.append(page_of(h.get("warc-refers-to")) if kind == "revisit" else None)
                        if with_payload:
                            row.append(None if kind == "revisit" else found.payload)
                    rows.append(row)
                    size += len(found.block) if found else 0
                    if size > 1 << 22:
                        yield pd.DataFrame(rows, columns=columns, dtype=object)
                        rows, size = [], 0
                yield pd.DataFrame(rows, columns=columns, dtype=object)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "{*.warc*,*.txt*}").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInPandas(parts, schema)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` to archives and read them back without their payloads; see :func:`write_archives`."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, with_payload=False)
