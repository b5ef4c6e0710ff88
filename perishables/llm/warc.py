"""WARC archives: a writer with revisit records, and a splittable reader of byte ranges.

Writing: every task writes its records, one gzip member each, to files of its own names below a shared
folder and returns a manifest row per file.  The manifest is a written table, so files of failed or
repeated tasks are never read.

Reading: an archive is dealt out as byte ranges without an index.  A task looks for gzip magic in its range,
takes a place for a member when the bytes there inflate to a WARC header with the needed
fields, and owns every record that starts inside its range; the last one may end beyond it.  Damaged members
are skipped by looking for the next one.

Files are reached through the file system of their address (``file:``, ``hdfs:``, ``s3:`` and so on).

Defined cases: a null payload is empty; among records of equal payload of at least ``MIN_REVISIT`` bytes all that
carry the least id are responses, others (null ids too) revisit it; a null address is left out;
line breaks in addresses are percent-encoded; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perishables.llm.common import small_batches, store
from perishables.session import scratch_path

SMALL_STEP = 16       # bytes inflated at a time of a member that is damaged
DAMAGED = "damaged"   # type of the row that stands for a member that isn't whole
MIN_REVISIT = 100
FILE_BYTES = 1 << 30     # a task goes on in a new file beyond this
SPLIT_BYTES = 16 << 20   # bytes of a reading task's range
READ_BYTES = 1 << 20
MAGIC = b"\x1f\x8b\x08"
HEAD_BYTES = 1 << 16     # read and inflated at a time while looking for a header's end
DATE = "2025-01-01T00:00:00Z"  # records are equal for equal input
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, bytes bigint, records bigint"
RECORD = ("file string, start bigint, record_id string, record_type string, refers_to string, url string, "
          "payload_bytes bigint, payload_digest string, payload binary")


# --------------------------------------------------------------------- records
def _urn(record_id: str | None) -> str:
    return f"<urn:page:{quote(record_id or '', safe='')}>"


def _from_urn(value: str | None) -> str | None:
    name = re.fullmatch(r"<urn:page:(.*)>", value or "")
    return unquote(name[1]) or None if name else None


def build_record(record_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None,
                 revisit: bool) -> bytes:
    """One gzip member.  A revisit's block is the HTTP head alone; its Content-Length is the full payload's."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _urn(record_id),
            "WARC-Date": DATE, "WARC-Target-URI": url and re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url),
            "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Refers-To": _urn(refers_to) if revisit else None,
            "WARC-Profile": PROFILE if revisit else None,
            "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    out = zlib.compressobj(5, zlib.DEFLATED, 31)
    return out.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + out.flush()


@dataclass
class Record:
    head: dict[str, str]
    block: bytes
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""

    @classmethod
    def parse(cls, raw: bytes) -> Record | None:
        """The record of an inflated member; None if it isn't whole."""
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = _header(head)
        if not fields or not fields.get("content-length", "").isdigit():
            return None
        size = int(fields["content-length"])
        if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
            return None
        record = cls(fields, rest[:size])
        if fields.get("content-type", "").startswith("application/http"):
            http, _, record.payload = record.block.partition(b"\r\n\r\n")
            record.http = _fields(http)
        else:
            record.payload = record.block
        return record


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, colon, v in (line.partition(":") for line in lines) if colon}


def _header(head: bytes) -> dict[str, str] | None:
    fields = _fields(head) if head.startswith(b"WARC/1.") else {}
    return fields if {"warc-type", "warc-record-id", "content-length"} <= fields.keys() else None


# --------------------------------------------------------------------- writing
def _open(address: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(address if "://" in address or address.startswith("file:") else f"file://{os.path.abspath(address)}")


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Writes ``records(record_id, url, payload, digest, refers_to, revisit)`` and returns the manifest of the files."""
    small_batches(records.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        out, name, size, count, done = None, "", 0, 0, []

        def close() -> None:
            out.close()
            done.append({"file": f"{folder.rstrip('/')}/{name}", "bytes": size, "records": count})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, count = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base.rstrip('/')}/{name}", compression=None)
                member = build_record(row["record_id"], row["url"], row["payload"], row["digest"], row["refers_to"], row["revisit"])
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return store(records.mapInArrow(step, MANIFEST), "warc-manifest")


# --------------------------------------------------------------------- reading
class RangeReader:
    """Records that start in [start, stop) of an open archive; ``damaged`` takes the places of members that begin as one
    but aren't whole."""

    def __init__(self, source, start: int, stop: int) -> None:
        self.source, self.at, self.stop = source, start, stop
        self.damaged: list[int] = []

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def _candidate(self) -> int | None:
        """The next place in the range with gzip magic."""
        while self.at < self.stop:
            block = self._read(self.at, min(READ_BYTES, self.stop - self.at) + len(MAGIC) - 1)
            found = block.find(MAGIC)
            if found >= 0:
                return self.at + found
            self.at += max(1, len(block) - len(MAGIC) + 1)
        return None

    def _is_record(self, at: int, step: int = HEAD_BYTES) -> bool:
        """Whether what inflates from here begins with a WARC header, however long.  ``step`` bytes are inflated at a time; what
        fails is looked at again in small steps, as damage behind the header, in the checksum say, hides it in a large one."""
        head, inflate, data, first = bytearray(), zlib.decompressobj(31), b"", at
        while not inflate.eof:
            if not data:
                data = self._read(at, HEAD_BYTES)
                at += len(data)
                if not data:
                    return False
            try:
                piece = inflate.decompress(data, step)
            except zlib.error:
                return step > SMALL_STEP and self._is_record(first, SMALL_STEP)
            data, seen = inflate.unconsumed_tail, max(0, len(head) - 3)
            head += piece
            if not b"WARC/1.".startswith(head[:7]):
                return False
            end = head.find(b"\r\n\r\n", seen)
            if end >= 0:
                return _header(bytes(head[:end])) is not None
        return False

    def _member(self, at: int) -> tuple[bytes | None, int]:
        """The inflated member (None if damaged) and where it ends."""
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            data = self._read(at, READ_BYTES)
            if not data:
                return None, at
            try:
                parts.append(inflate.decompress(data))
            except zlib.error:
                return None, at
            at += len(data)
        return b"".join(parts), at - len(inflate.unused_data)

    def __iter__(self) -> Iterator[tuple[int, Record]]:
        while (at := self._candidate()) is not None:
            self.at = at + 1
            if self._is_record(at):
                raw, end = self._member(at)
                record = raw and Record.parse(raw)
                if record:
                    self.at = end
                    yield at, record
                else:
                    self.damaged.append(at)


def read_warc(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True, damaged: bool = False) -> DataFrame:
    """Records of the archives in ``files(file, bytes)``; ``payload_bytes`` and ``payload_digest`` are of the full
    payload: measured for responses, as their heads say for revisits.  ``payload`` is null for revisits,
    and everywhere without ``payloads``.  With ``damaged`` there is also a row of type ``damaged``, with its place only, for
    each member that begins as a record but isn't whole; without, such members are left out."""
    small_batches(spark)
    # a number of its own, as ranges of few bytes of plan each hold much work
    total = files.agg(F.sum("bytes")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + total // split_bytes)
    ranges = files.filter(F.col("bytes") > 0).select("file", "bytes", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))).alias("start"))
    dealt = ranges.select("file", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("stop")) \
        .repartition(parts, "file", "start")

    def row(file: str, start: int, record: Record) -> dict:
        revisit = record.head["warc-type"] == "revisit"
        size = int(record.http.get("content-length", 0)) if revisit else len(record.payload)
        digest = (record.head.get("warc-payload-digest", "").removeprefix("sha256:") if revisit
                  else hashlib.sha256(record.payload).hexdigest())
        return {"file": file, "start": start, "record_id": _from_urn(record.head["warc-record-id"]),
                "record_type": record.head["warc-type"], "refers_to": _from_urn(record.head.get("warc-refers-to")),
                "url": record.head.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
                "payload": record.payload if payloads and not revisit else None}

    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("payload", pa.binary())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                system, path = _open(split["file"])
                rows, held = [], 0
                with system.open_input_file(path) as source:
                    reader = RangeReader(source, split["start"], split["stop"])
                    for start, record in reader:
                        rows.append(row(split["file"], start, record))
                        held += len(rows[-1]["payload"] or b"")
                        if len(rows) >= 256 or held >= 16 * READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if damaged:
                    rows += [dict.fromkeys(schema.names) | {"file": split["file"], "start": at, "record_type": DAMAGED} for at in reader.damaged]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return dealt.mapInArrow(step, RECORD)


# -------------------------------------------------------------------- operator
def read_whole(spark: SparkSession, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``manifest(file, bytes, records)`` promises; an error if one of them is damaged or missing.

    They are written once, so that what is returned is what was counted.
    """
    rows = store(read_warc(spark, manifest, payloads=payloads, damaged=True), "warc-records")
    by_file = rows.groupBy("file").agg(F.count_if(F.col("record_type") != DAMAGED).alias("found"), F.count_if(F.col("record_type") == DAMAGED).alias("broken"))
    wrong = manifest.join(by_file, "file", "left").filter((F.coalesce("found", F.lit(0)) != F.col("records")) | (F.coalesce("broken", F.lit(0)) > 0)) \
        .agg(F.count(F.lit(1)).alias("files"), F.sum(F.col("records") - F.coalesce("found", F.lit(0))).alias("lost"), F.sum("broken").alias("broken")).first()
    if wrong["files"]:
        raise ValueError(f"{wrong['files']} archive files differ from their manifest: {wrong['lost']} records lost, {wrong['broken'] or 0} damaged")
    return rows


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """What to write for each page: the record with its payload digest, and what it revisits."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id_col}`").alias("page"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    # only payloads that occur again are looked up: small unless most are copies; written, so that the join
    # can split a hot payload
    again = rows.select("page", "digest", "payload").filter(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest") \
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & F.col("first").isNotNull())
    found = rows.join(store(again.select("digest", "first"), "warc-again"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    return found.select(F.col("page").cast("string").alias("record_id"), "url", "payload", "digest",
                        F.when(revisit, F.col("first").cast("string")).alias("refers_to"), revisit.alias("revisit"))


def archive_pages(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """Writes the pages below ``folder`` (by default a new one in the shared scratch folder); the manifest."""
    return write_warc(page_records(pages, **columns), folder or scratch_path(pages.sparkSession, "warc"))
