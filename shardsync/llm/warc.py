"""WARC archives: writing captures, reading records, assembling transactions."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardsync.llm.common import located, work_dir, written
from shardsync.llm.token_files import open_store

#: Payloads below this size are always stored in full.
LEAST_SHARED = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Header fields that become columns.
FIELDS = {
    "record_id": "warc-record-id",
    "type": "warc-type",
    "concurrent_to": "warc-concurrent-to",
    "refers_to": "warc-refers-to",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
}
RECORDS = "file string, position long, " + "".join(f"{c} string, " for c in FIELDS) + "block binary"


def choose_stored(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``name`` (of the row's capture) and
    ``same_as``: the name of the capture that stores the same payload, or null where
    the payload is stored.

    Of equal payloads of at least ``least`` bytes the one with the largest ``page_id``
    is stored (null is smallest; ties: the later row). Digests meet in partial
    aggregates; only those that occur again are joined back."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = located(pages, F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    name = F.concat_ws("#", F.col("at.file"), F.col("at.row").cast("string"))
    rows = rows.withColumn("name", name).withColumn("digest", F.sha2("payload", 256))
    again = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "name")).alias("keep"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", F.col("keep.name").alias("stored"))
    )
    found = rows.join(written(again, "warc-shared"), "digest", "left")
    other = F.when(F.col("stored") != F.col("name"), F.col("stored"))
    return found.select("page_id", "url", "payload", "name", other.alias("same_as"))


def record_id(name: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{name}')}>"


def _record(headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member of its own. Header values hold no line ends."""
    lines = [f"{k}: {' '.join(v.splitlines())}" for k, v in headers.items()]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"]).encode()
    return gzip.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def _capture(
    page_id: int | None, url: str | None, payload: bytes, name: str, same_as: str | None, date: str
) -> Iterator[bytes]:
    """Request, response or revisit, and metadata of one page."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    kind = "revisit" if same_as else "response"
    own = record_id(name, "response")
    shared = {"WARC-Date": date, "WARC-Target-URI": url or ""}
    refer = {"WARC-Refers-To": record_id(same_as, "response"), "WARC-Profile": REVISIT_PROFILE}
    host, _, path = (url or "").partition("://")[2].partition("/")
    get = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    fields = "" if page_id is None else f"pageId: {page_id}\r\n"
    yield _record(
        {"WARC-Type": "request", "WARC-Record-ID": record_id(name, "request"),
         "WARC-Concurrent-To": own, **shared, "Content-Type": "application/http; msgtype=request"},
        get,
    )
    yield _record(
        {"WARC-Type": kind, "WARC-Record-ID": own, **shared, **(refer if same_as else {}),
         "WARC-Payload-Digest": digest, "Content-Type": "application/http; msgtype=response"},
        http.encode() + (b"" if same_as else payload),
    )
    yield _record(
        {"WARC-Type": "metadata", "WARC-Record-ID": record_id(name, "metadata"),
         "WARC-Concurrent-To": own, **shared, "Content-Type": "application/warc-fields"},
        fields.encode(),
    )


def write_warc(captures: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of ``choose_stored`` to gzipped archives, one for each task, and
    return a written table of their names (``file``, ``records``). A task that runs
    again writes a file of its own, and the table names only files of tasks that
    ended well."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        store, path = open_store(file)
        n = 0
        with store.open_output_stream(path, compression=None) as out:
            for batch in batches:
                for k in range(batch.num_rows):
                    for record in _capture(*(c[k].as_py() for c in batch.columns), date):
                        out.write(record)
                        n += 1
        made = [pa.array([file]), pa.array([n], pa.int64())]
        yield pa.RecordBatch.from_arrays(made, ["file", "records"]).slice(0, int(n > 0))

    rows = captures.select("page_id", "url", "payload", "name", "same_as")
    return written(rows.mapInArrow(write, "file string, records long"), "warc-files")


def parse_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record. The block is as
    long as its header says, whatever bytes it holds. A file that ends inside a record
    is an error."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one must begin")
        headers: dict[str, str] = {}
        last = ""
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and last:
                headers[last] += " " + text.strip()
            else:
                last, _, value = text.partition(":")
                last = last.strip().lower()
                headers[last] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the file ends inside a record")
        yield headers, block


def hex_digest(value: str | None) -> str | None:
    """A labelled SHA-1 in base 32 or 16 as bare lower-case hex; others as they are."""
    label, _, digest = (value or "").rpartition(":")
    if label.lower() == "sha1" and len(digest) == 32:
        return base64.b32decode(digest.upper()).hex()
    return digest.lower() if label.lower() == "sha1" else value


def read_warc(files: DataFrame, batch_bytes: int = 1 << 23) -> DataFrame:
    """Every record of the archives named in ``file``, gzipped or plain: ``file``,
    ``position``, the ``FIELDS`` and ``block``. A task streams through its archives and
    holds ``batch_bytes`` of records, or one longer record, at a time."""

    def rows(file: str) -> Iterator[tuple]:
        store, path = open_store(file)
        with store.open_input_stream(path, compression=None) as raw:
            source = io.BufferedReader(raw, 1 << 20)
            plain = source.peek(2)[:2] != b"\x1f\x8b"
            stream = source if plain else io.BufferedReader(gzip.GzipFile(fileobj=source), 1 << 20)
            for k, (headers, block) in enumerate(parse_records(stream)):
                values = {c: headers.get(h) for c, h in FIELDS.items()}
                values["payload_digest"] = hex_digest(values["payload_digest"])
                yield file, k, *values.values(), block

    kinds = [pa.string(), pa.int64(), *[pa.string()] * len(FIELDS), pa.binary()]
    names = ["file", "position", *FIELDS, "block"]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            held, size = [], 0
            for row in (r for file in given.column(0).to_pylist() for r in rows(file)):
                held.append(row)
                size += len(row[-1]) + 500
                if size >= batch_bytes:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)

    return files.select("file").repartition(max(1, files.count())).mapInArrow(read, RECORDS)


def http_parts(block: Column) -> tuple[Column, Column]:
    """Head (as text) and payload of an HTTP message."""
    text = block.cast("string")
    end = F.octet_length(F.substring_index(text, "\r\n\r\n", 1))
    return F.substring_index(text, "\r\n\r\n", 1), F.substring(block, end + 5, F.octet_length(block))


def assemble(records: DataFrame, *payload: str) -> DataFrame:
    """Transactions: one nested row for each capture, with ``capture`` (the identifier
    that all its records share), ``response`` (a response or revisit), ``request`` and
    ``metadata``. ``payload`` names further columns of ``records`` to nest.

    A response or revisit is a capture; a request or metadata record belongs to the
    one it is concurrent to. Records whose partner isn't there come out with null in
    its place. Of several records of a kind in one capture, also repeated ones, the
    first by file and position counts. Other record types have no part in captures.
    Identifiers are spread by hash and each kind is reduced before the joins, so no
    capture gathers more than three records."""

    def part(name: str, kinds: list[str], key: str) -> DataFrame:
        nested = F.struct("file", "position", *FIELDS, *payload)
        own = records.where(F.col("type").isin(kinds) & F.col(key).isNotNull())
        return own.groupBy(F.col(key).alias("capture")).agg(F.min(nested).alias(name))

    responses = part("response", ["response", "revisit"], "record_id")
    requests = part("request", ["request"], "concurrent_to")
    metadata = part("metadata", ["metadata"], "concurrent_to")
    return responses.join(requests, "capture", "full").join(metadata, "capture", "full")


def archive_pages(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Write a capture for every row of ``pages`` (``page_id``, ``url``, ``html``), read
    the archives back and assemble them: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``, ``capture``.

    Null html is an empty payload, null url an empty address; a null ``page_id`` stays
    null. Every row comes out, repeated ones as captures of their own; further columns
    are ignored; an empty table gives no rows. The size and digest of a response come
    from the bytes read back, those of a revisit from its HTTP head and WARC header."""
    files = write_warc(choose_stored(pages, least), work_dir(pages.sparkSession, "warc"))
    records = read_warc(files)
    head, body = http_parts(F.col("block"))
    stored = F.col("type") == "response"
    told = F.regexp_extract(head, r"(?i)\r\nContent-Length: *([0-9]+)", 1)
    records = records.select(
        "file", "position", *[c for c in FIELDS if c != "payload_digest"],
        F.when(stored, F.sha1(body)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.when(stored, F.octet_length(body).cast("long"))
        .otherwise(F.when(told != "", told).cast("long")).alias("payload_bytes"),
        F.when(
            F.col("type") == "metadata",
            F.regexp_extract(F.col("block").cast("string"), r"(?m)^pageId: (-?[0-9]+)", 1),
        ).alias("page_id"),
    )
    records = written(records, "warc-records")
    found = assemble(records, "payload_bytes", "page_id").select(
        F.when(F.col("metadata.page_id") != "", F.col("metadata.page_id")).cast("long").alias("page_id"),
        "response.payload_bytes",
        "response.payload_digest",
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("refers_to"),
        "capture",
    )
    found = written(found, "warc-captures")
    named = found.select(F.col("capture").alias("refers_to"), F.col("page_id").alias("refers_to_page"))
    shared = found.where(F.col("refers_to").isNotNull()).select("refers_to").distinct()
    named = written(named.join(shared, "refers_to"), "warc-referred")
    return found.join(named, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_page").alias("refers_to"), "capture",
    )
