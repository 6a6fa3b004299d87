"""WARC archives: a writer of one gzip member a record, and a splittable reader.

Writer: every task writes one archive of its own in the shared folder, under a name no other attempt uses, and returns
its path, size and record count. Only archives named in the settled list count, so a repeated task leaves no double records.
Of records with equal payloads the one with the largest id is a ``response``; the others are ``revisit`` records
without a payload that refer to it.

Reader: archives are cut into byte ranges. A task looks for the gzip magic in its range, takes a place for the start of a member only
if it unpacks to a WARC header, and owns the records that start inside the range, reading on past its end for the last one.
HTML in UTF-8 never holds the magic's second byte after its first, so no payload stored as it is can pass for a member.

A null payload is empty, a null URL is left out, a null id is written as ``none`` and never referred to. Rows that repeat id and payload are
records of their own, of the same type. Broken members raise an error that names file and place; digests are checked on reading.
A payload of any length is one record, held once by the task that writes or reads it. Columns other than page_id, url and html are not archived,
whatever their names; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import new_path, settle

MAGIC = b"\x1f\x8b\x08"
# Bytes of an archive that one reading task owns, and bytes read at once.
SPLIT_BYTES = 8 << 20
RANGES_A_TASK = 4
BLOCK_BYTES = 1 << 20
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of a member that may be read before its first header line shows.
PROBE_BYTES = 4096

RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
ARCHIVES = T.StructType([T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("records", T.LongType())])


def decide(pages: DataFrame, payload: str = "html", key: str = "page_id", least_bytes: int = 0) -> DataFrame:
    """Add ``record_type`` and ``refers_to``. Payloads shorter than ``least_bytes`` are all responses.

    Digests are grouped with sums taken before the shuffle; the join back is an equi-join that adaptive execution splits at hot payloads.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    keyed = pages.drop("record_type", "refers_to").withColumn("_digest", F.sha1(body)).withColumn("_bytes", F.octet_length(body))
    largest = keyed.select("_digest", "_bytes", key).groupBy("_digest", "_bytes").agg(F.max(key).alias("_largest"))
    other = (F.col("_bytes") >= least_bytes) & F.col("_largest").isNotNull() & ~F.col(key).eqNullSafe(F.col("_largest"))
    return (
        keyed.join(largest, ["_digest", "_bytes"])
        .withColumn("record_type", F.when(other, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(other, F.col("_largest")))
        .drop("_digest", "_bytes", "_largest")
    )


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    body = b"" if kind == "revisit" else payload
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + body
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {IDENTICAL}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, payload: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """Write decided pages as archives; returns the settled list of them."""
    folder = new_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("body"), "record_type", "refers_to"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        path, size, count, out = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(path, compression=None)
                member = record(*row)
                out.write(member)
                size, count = size + len(member), count + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{path.rpartition('/')[2]}"], "bytes": [size], "records": [count]})

    return settle(rows.mapInArrow(run, ARCHIVES), "archives")


def _id(name: str | None) -> int | None:
    inner = (name or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(inner) if inner.lstrip("-").isdigit() else None


def parse(content: bytes) -> tuple:
    """A row of RECORDS from one unpacked member."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return _id(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, _id(fields.get("WARC-Refers-To")), digest, payload if kind == "response" else None


def records_in(file, start: int, end: int) -> Iterator[bytes]:
    """Unpack the members that start in [start, end) of an open file."""
    size, at, held, base = file.size(), start, b"", start

    def more() -> bool:
        nonlocal held
        block = file.read_at(min(BLOCK_BYTES, size - base - len(held)), base + len(held)) if base + len(held) < size else b""
        held += block
        return bool(block)

    while at < end:
        held, base = held[at - base :], at
        while (found := held.find(MAGIC)) < 0 and base + max(0, len(held) - 2) < end:
            held, base = held[max(0, len(held) - 2) :], base + max(0, len(held) - 2)
            if not more():
                return
        if found < 0 or base + found >= end:
            return
        held, base = held[found:], base + found
        while len(held) < PROBE_BYTES and more():
            pass
        try:
            genuine = zlib.decompressobj(31).decompress(held[:PROBE_BYTES], 8).startswith(b"WARC/1.")
        except zlib.error:
            genuine = False
        if not genuine:
            at = base + 1
            continue
        # Blocks go through one by one, so a record of any length is copied once.
        unpack, out, behind = zlib.decompressobj(31), [], base + len(held)
        out.append(unpack.decompress(held))
        while not unpack.eof:
            block = file.read_at(min(BLOCK_BYTES, size - behind), behind) if behind < size else b""
            if not block:
                raise ValueError(f"the member at byte {base} is cut off")
            behind += len(block)
            out.append(unpack.decompress(block))
        held = unpack.unused_data
        at = base = behind - len(held)
        yield b"".join(out)


def read(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the listed archives (columns path and bytes). Revisits have no payload.

    Ranges are dealt out evenly, up to ``RANGES_A_TASK`` to a task once all cores have one. The number of tasks is set: by the few bytes that
    describe a range, all would be put together.
    """
    ranges = archives.where("bytes > 0").select("path", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"), "bytes")
    n = ranges.count()
    tasks = max(1, min(n, max(archives.sparkSession.sparkContext.defaultParallelism, -(-n // RANGES_A_TASK))))
    ranges = ranges.repartition(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as file:
                    rows, held = [], 0
                    for content in records_in(file, start, min(size, start + split_bytes)):
                        rows.append(parse(content))
                        held += len(content)
                        if held > 4 * BLOCK_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    return ranges.mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=RECORDS.names)


def resolved(records: DataFrame) -> DataFrame:
    """Payload size and digest of every record; a revisit takes them from the response that it refers to."""
    narrow = settle(records.select("page_id", "record_type", "refers_to", "payload_digest", F.octet_length("payload").cast("long").alias("payload_bytes")), "records")
    responses = narrow.where("record_type = 'response'")
    sources = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = narrow.where("record_type = 'revisit'").drop("payload_bytes").join(sources, ["refers_to", "payload_digest"], "left")
    return responses.unionByName(revisits)
