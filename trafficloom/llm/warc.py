"""Web archives: a writer with revisit records and a reader that splits files by byte range.

Writing. Payloads are grouped by digest; of equal ones, the row with the largest id becomes
the response and the others revisit it. Each task writes its rows as files of one gzip
member per record and moves a file to its name when it is whole, so a task that runs again
leaves the same files. A stored manifest lists the files and their sizes.

Reading. Every task gets a byte range. It scans for the three bytes a gzip member starts
with, decodes what follows, and takes a place as a record's start only if a WARC header
with a type and a length comes out, the member ends where that length says, its checksum
is right, and the members after it follow without gap up to the end of the range. From there
it reads member after member, and owns the records that start inside its range. The bytes
of a member may look like a start; that an embedded archive is taken for the file's own would
take one that is stored without compression and reaches from the range's first bytes past its end.

The files are read and written with ``pyarrow.fs``, in the shared folder or any other place
it reaches, and never through a driver's or executor's own folder.

Defined cases: a null payload is empty. Without a URL there is no target header. Rows that
repeat the largest id of a payload are all responses; a null id is smaller than any other,
and where all are null, all are responses. An empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.llm.common import file_system, new_folder, stored

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a file after which the next one is begun, and of a range to be read.
FILE_BYTES = 1 << 30
RANGE_BYTES = 16 << 20
#: Bytes fetched at once.
FETCH = 1 << 20
DATE = "1970-01-01T00:00:00Z"
#: What ends a header, and the two line ends after a record's block.
HEADER_END = b"\r\n\r\n"
RECORD_END = b"\r\n\r\n"

RECORD = (
    "path string, offset long, length long, type string, record_id string, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to string, payload binary"
)


def with_types(pages: DataFrame, id_col: str, url_col: str, payload_col: str, revisit_from: int = 0) -> DataFrame:
    """Rows (id, url, payload, digest, responder) with the payload as bytes; ``responder`` is
    the id of the response that the row revisits, null if it is a response itself."""
    payload = F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    largest = rows.groupBy("digest").agg(F.max("id").alias("largest"), F.count("*").alias("n")).filter("n > 1")
    known = largest.select(F.col("digest").alias("of"), "largest")
    joined = rows.join(known, F.col("digest") == F.col("of"), "left")
    revisits = (F.octet_length("payload") >= revisit_from) & ~F.col("id").eqNullSafe(F.col("largest"))
    return joined.withColumn("responder", F.when(revisits, F.col("largest"))).select(
        "id", "url", "payload", "digest", "responder"
    )


def record_name(record_id) -> str:
    return f"<urn:x-page:{'' if record_id is None else int(record_id)}>"


def member(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as one gzip member; headers without value are left out."""
    lines = ["WARC/1.1"]
    for name, value in (*headers, ("Content-Length", str(len(block)))):
        if value is not None:
            lines.append(f"{name}: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value) if name == "WARC-Target-URI" else f"{name}: {value}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode("utf-8", "surrogatepass") + HEADER_END
    return packer.compress(head) + packer.compress(block) + packer.compress(RECORD_END) + packer.flush()


def record_of(row_id, url: str | None, payload: bytes, digest: str, responder, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    named = [
        ("WARC-Type", "response" if responder is None else "revisit"),
        ("WARC-Record-ID", record_name(row_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if responder is None:
        return member(named, http + payload)
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return member([*named, ("WARC-Profile", profile), ("WARC-Refers-To", record_name(responder))], http)


def write_archives(rows: DataFrame, folder: str, date: str = DATE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes rows of ``with_types`` below the folder; the stored manifest (path, bytes, records)."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = file_system(folder)
        context = TaskContext.get()
        done, out, draft, size, records = [], None, "", 0, 0

        def finish() -> None:
            nonlocal out, size, records
            out.close()
            name = f"part-{context.partitionId():06d}-{len(done):04d}.warc.gz"
            system.move(draft, f"{base}/{name}")
            done.append((f"{folder}/{name}", size, records))
            out, size, records = None, 0, 0

        for batch in batches:
            for row_id, url, payload, digest, responder in batch.itertuples(index=False):
                ids = [None if pd.isna(x) else int(x) for x in (row_id, responder)]
                if out is None:
                    draft = f"{base}/_draft-{context.taskAttemptId()}-{len(done)}"
                    out = system.open_output_stream(draft)
                    info = b"software: trafficloom\r\nformat: WARC File Format 1.1\r\n"
                    named = [("WARC-Type", "warcinfo"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
                    first = member([*named, ("WARC-Record-ID", f"<urn:x-archive:{context.partitionId()}:{len(done)}>")], info)
                    size += out.write(first)
                size += out.write(record_of(ids[0], url, payload, digest, ids[1], date))
                records += 1
                if size >= file_bytes:
                    finish()
        if out is not None:
            finish()
        if done:
            yield pd.DataFrame(done, columns=["path", "bytes", "records"])

    # Ids travel as text: pandas would turn a column of longs with a null into floats.
    texts = rows.select(F.col("id").cast("string"), "url", "payload", "digest", F.col("responder").cast("string"))
    return stored(texts.mapInPandas(write, "path string, bytes long, records long"), "warc-manifest")


class Source:
    """Random access to one file with the last fetched piece kept."""

    def __init__(self, path: str):
        system, name = file_system(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()
        self.start, self.piece = 0, b""

    def at(self, offset: int) -> bytes:
        """Some bytes from the offset on, none at the end."""
        if not self.start <= offset < self.start + len(self.piece):
            self.start, self.piece = offset, self.file.read_at(min(FETCH, max(0, self.size - offset)), offset)
        return self.piece[offset - self.start :]

    def next_magic(self, offset: int, end: int) -> int | None:
        """The first place of the three bytes that starts before the end."""
        while offset < end:
            piece = self.at(offset)
            if len(piece) < len(MAGIC) and offset + len(piece) < self.size:
                self.start, self.piece = offset, b""
                piece = self.at(offset)
            found = piece.find(MAGIC)
            if found >= 0:
                return offset + found if offset + found < end else None
            if offset + len(piece) >= self.size:
                return None
            offset += len(piece) - len(MAGIC) + 1
        return None


def decoded(source: Source, offset: int) -> tuple[dict[str, str], bytes, int] | None:
    """The header, the block and the next member's offset, or None if no record starts here."""
    unpack = zlib.decompressobj(31)
    data, place, head, searched = bytearray(), offset, -1, 0
    try:
        while not unpack.eof:
            piece = source.at(place)
            if not piece:
                return None
            data += unpack.decompress(piece)
            place += len(piece)
            if head < 0:
                if not data.startswith(b"WARC/1."[: len(data)]):
                    return None
                # a header may have any length; what was searched before is not searched again
                head = data.find(HEADER_END, searched)
                searched = max(0, len(data) - len(HEADER_END) + 1)
    except zlib.error:
        return None
    if head < 0:
        return None
    named = (line.partition(":") for line in data[:head].decode("utf-8", "surrogatepass").split("\r\n")[1:])
    headers = {name.strip().lower(): value.strip() for name, _, value in named}
    length = headers.get("content-length", "")
    begin = head + len(HEADER_END)
    if "warc-type" not in headers or not length.isdigit() or len(data) != begin + int(length) + len(RECORD_END):
        return None
    return headers, bytes(data[begin : begin + int(length)]), place - len(unpack.unused_data)


def first_record(source: Source, start: int, end: int) -> int | None:
    """The first record's offset inside the range, or None if none starts there."""
    candidate = source.next_magic(start, end)
    while candidate is not None:
        offset = candidate
        while offset < end and offset < source.size and (found := decoded(source, offset)):
            offset = found[2]
        if offset >= end or offset == source.size:
            return candidate
        candidate = source.next_magic(candidate + 1, end)
    return None


def records_in(path: str, start: int, end: int) -> Iterator[tuple]:
    source = Source(path)
    offset = 0 if start == 0 else first_record(source, start, end)
    while offset is not None and offset < min(end, source.size):
        found = decoded(source, offset)
        if found is None:
            raise ValueError(f"no record at {path}:{offset}")
        headers, block, following = found
        payload = block.partition(HEADER_END)[2] if headers["warc-type"] == "response" else None
        yield (
            path,
            offset,
            following - offset,
            headers["warc-type"],
            headers.get("warc-record-id"),
            headers.get("warc-target-uri"),
            headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            int(headers["x-payload-length"]) if headers.get("x-payload-length", "").isdigit() else None,
            headers.get("warc-refers-to"),
            payload,
        )
        offset = following


def read_archives(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the files in a manifest (path, bytes), one task per range of bytes.

    For responses, the payload's digest and size are those of the payload as read; a header
    that names another digest is an error. For revisits they come from the header.
    """
    from hashlib import sha1

    names = [field.split()[0] for field in RECORD.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start, end in batch.itertuples(index=False):
                rows, size = [], 0
                for record in records_in(path, int(start), int(end)):
                    if (payload := record[-1]) is not None:
                        digest = base64.b32encode(sha1(payload).digest()).decode()
                        if record[6] not in (None, digest):
                            raise ValueError(f"payload of {record[4]} at {path}:{record[1]} is damaged")
                        record = (*record[:6], digest, len(payload), *record[8:])
                        size += len(payload)
                    rows.append(record)
                    if size >= FETCH or len(rows) >= 4096:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))
    ranges = manifest.filter("bytes > 0").select("path", F.explode(starts).alias("start"))
    ranges = ranges.withColumn("end", F.col("start") + range_bytes)
    tasks = manifest.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    typed = RECORD.replace("payload_bytes long", "payload_bytes double")  # pandas has no long with nulls
    found = ranges.repartition(int(tasks), "path", "start").mapInPandas(read, typed)
    return found.withColumn("payload_bytes", F.col("payload_bytes").cast("long"))


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_from: int = 0) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads their records back."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder}"
    manifest = write_archives(with_types(pages, id_col, url_col, payload_col, revisit_from), folder)
    return read_archives(spark, manifest)
