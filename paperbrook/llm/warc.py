"""Web archives: records written with an index, and coalesced reads of the byte ranges that the index names."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperbrook.llm.common import written
from paperbrook.session import new_run_folder

# Bytes of archive after which a task starts a new file, and after which it hands them to the file system.
ARCHIVE_BYTES, BUFFER_BYTES = 1 << 30, 4 << 20
# Reads of one file closer together than this are one read; a read ends when it holds this many bytes.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
# Byte ranges of one file are dealt to tasks in stretches of this length.
STRETCH_BYTES = 64 << 20
# Bytes of records that a task reads, at least and at most.
PART_BYTES = 1 << 20, 128 << 20
# Digits of base 32 as written by the conversion of numbers and as RFC 4648 writes them (fixed values).
BASE32_FROM, BASE32_TO = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
INDEX = "file string, offset bigint, length bigint, url string, digest string, page_id bigint, record_type string"
RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
    "payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: the 160 bits as four numbers of 40 bits, eight digits each."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), BASE32_FROM, BASE32_TO)


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def digests(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest): the html as bytes, null as no bytes."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    given = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    return given.withColumn("digest", base32_sha1(F.col("payload")))


def repeated_payloads(given: DataFrame, min_bytes: int) -> DataFrame:
    """(digest, n_bytes, first): payloads of more than one row, of at least ``min_bytes``, with their largest page_id."""
    sized = given.select("page_id", "digest", F.length("payload").alias("n_bytes")).where(F.col("n_bytes") >= min_bytes)
    groups = sized.groupBy("digest", "n_bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    return groups.where("n > 1").select("digest", "n_bytes", "first")


def header_value(text: str | None) -> str:
    """Header lines end at the first line break, so none may come from data."""
    return "".join(" " if c in "\r\n" else c for c in text or "")


def record_bytes(page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a resource with its payload, or a revisit that names the record with the same payload."""
    name = "none" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        payload = b""
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(lines).encode() + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record begins here: {first[:40]!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[: int(headers["Content-Length"])]


def named_page(headers: dict[str, str], field: str) -> int | None:
    value = headers.get(field, "<urn:page:none>")[len("<urn:page:") : -1]
    return None if value == "none" else int(value)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html) under ``folder``; returns the written index.

    Of records with equal payloads of at least ``min_bytes`` bytes that with the largest page_id is the response and
    the others revisit it; rows that share that largest id are all responses, and rows without an id revisit. Every
    record is a compressed member of its own, so a byte range of the index can be read alone. The index has file,
    offset, length, url, digest, page_id and record_type; a file has the attempt in its name and counts only through
    the index. Null html is an empty payload, a null url leaves its header out. Other columns are not read.

    Only payloads that repeat are joined, by digest; that table is written first, so the planner knows its size and
    moves no html when it is small. A task holds one record and a buffer.
    """
    given = digests(pages)
    groups = written(repeated_payloads(given, min_bytes), "payloads").withColumnRenamed("digest", "of")
    same = (F.col("digest") == F.col("of")) & (F.length("payload") == F.col("n_bytes"))
    linked = given.join(groups, same, "left")
    repeats = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    linked = linked.select("page_id", "url", "digest", "payload", F.when(repeats, F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inside = filesystem(folder)
        store.create_dir(inside, recursive=True)
        context = TaskContext.get()
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        number, at, file = 0, 0, None
        for batch in batches:
            rows = []
            for values in zip(*batch.columns, strict=True):
                page_id, url, digest, payload, refers_to = (v.as_py() for v in values)
                if file is None:
                    place = f"pages-{name}-{number:04d}.warc.gz"
                    file, at = store.open_output_stream(f"{inside}/{place}", buffer_size=BUFFER_BYTES, compression=None), 0
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(record_bytes(page_id, url, digest, payload, refers_to)) + packer.flush()
                file.write(member)
                kind = "response" if refers_to is None else "revisit"
                rows.append((f"{folder}/{place}", at, len(member), url, digest, page_id, kind))
                at += len(member)
                if at >= archive_bytes:
                    file.close()
                    file, number = None, number + 1
            if rows:
                fields = [f.split() for f in INDEX.split(", ")]
                kinds = {"string": pa.string(), "bigint": pa.int64()}
                columns = [pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [f for f, _ in fields])
        if file is not None:
            file.close()

    return written(linked.mapInArrow(run, INDEX), "index")


def coalesced(index: DataFrame) -> DataFrame:
    """The index rows with a number of the stretch of the file each lies in: a unit of work of bounded length."""
    return index.withColumn("stretch", F.floor(F.col("offset") / STRETCH_BYTES))


def read_records(index: DataFrame) -> DataFrame:
    """Read the records that ``index`` (any selection of index rows) names, as rows of ``RECORD``.

    Rows are dealt by file and stretch and sorted by offset; neighbours closer than ``GAP_BYTES`` are fetched by
    one read. A task holds one read and the records of one batch; the number of tasks follows the bytes to be read,
    not those of the index.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    slots = index.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-total // min(max(total // (4 * slots), PART_BYTES[0]), PART_BYTES[1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            at = 0
            while at < len(rows):
                name, start, _ = rows[at]
                last = at
                end = start + rows[at][2]
                while (
                    last + 1 < len(rows) and rows[last + 1][0] == name and rows[last + 1][1] >= start
                    and rows[last + 1][1] - end <= GAP_BYTES and end - start < READ_BYTES
                ):
                    last += 1
                    end = max(end, rows[last][1] + rows[last][2])
                if opened != name:
                    store, inside = filesystem(name)
                    file, opened = store.open_input_file(inside), name
                data = file.read_at(end - start, start)
                records = []
                for _, offset, length in rows[at : last + 1]:
                    member = zlib.decompress(data[offset - start : offset - start + length], 31)
                    headers, payload = parse_record(member)
                    records.append((
                        named_page(headers, "WARC-Record-ID"), headers.get("WARC-Target-URI"), headers["WARC-Type"],
                        named_page(headers, "WARC-Refers-To"), int(headers["Payload-Length"]),
                        headers["WARC-Payload-Digest"].removeprefix("sha1:"), payload,
                    ))
                kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
                fields = [f.split() for f in RECORD.split(", ")]
                columns = [pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*records, strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [f for f, _ in fields])
                at = last + 1

    dealt = coalesced(index).repartition(parts, "file", "stretch").sortWithinPartitions("file", "offset")
    return dealt.select("file", "offset", "length").mapInArrow(run, RECORD)


def checked(records: DataFrame) -> DataFrame:
    """The records without their payloads; digest and length of responses are taken from the bytes that were read."""
    held = F.col("record_type") == "response"
    return records.select(
        "page_id", F.when(held, F.length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(held, base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )


def archive_and_read(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages to a new folder under the shared one, then read every record back by the index."""
    index = write_archives(pages, new_run_folder(pages.sparkSession, "archives"), min_bytes)
    return checked(read_records(index))
