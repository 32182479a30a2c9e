"""WARC archives: pages to records, and whole-file gzip normalised to one member a record with an offset index.

A writer makes an archive as one gzip stream, as many tools do; nothing in it can be read without inflating
all before it. The normaliser inflates that stream once, writes every record as its own member to a new file,
and puts each member's place into a sidecar index beside it. Readers then fetch single records by place.

Files are named by a random number for each attempt, and a table lists those whose task succeeded. A lost
executor's task is run again under another name; what it left behind is never listed, so never read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import broadcast_if_small, stored, text_slices
from marketspark.session import working_path

GZIP = 31
LEVEL = 1
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
SPLIT_BYTES = 32 << 20
LEAST_DUPLICATE = 100
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if re.match("file:/[^/]", uri) else uri)


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, full: int) -> bytes:
    """A WARC record. A revisit keeps the HTTP head, which names the full length, and not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {full}\r\n\r\n".encode()
    block = head + payload
    target = CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "urn:unknown")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of a record, of its HTTP head, and the payload that is there."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = fields_of(head)
    http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
    return fields, fields_of(http), payload


def inflated(stream: pa.NativeFile) -> Iterator[bytes]:
    """The bytes of a gzip file, of one member or several, a piece at a time."""
    inflate, data = zlib.decompressobj(GZIP), b""
    while data := inflate.unconsumed_tail or inflate.unused_data or stream.read(READ_BYTES):
        if inflate.eof:
            inflate = zlib.decompressobj(GZIP)
        yield inflate.decompress(data, 4 * READ_BYTES)
    if not inflate.eof:
        raise ValueError("the gzip stream ends early")


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, cut by their own lengths; a record may lie over any number of pieces."""
    held = bytearray()
    need, end = 0, -1
    for piece in pieces:
        held += piece
        while True:
            if end < 0:
                end = held.find(b"\r\n\r\n", max(0, need))
                if end < 0:
                    need = max(0, len(held) - 3)
                    break
                need = end + 4 + int(fields_of(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need, end = 0, -1
    if held:
        raise ValueError("the last record is cut off")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """(archive, n_records): ``pages`` (page_id, url, html, digest, record_type, refers_to) as monolithic archives."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        out, name, held, count = None, "", 0, 0

        def finish() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "n_records": pa.array([count], pa.int64())})

        for batch in text_slices(batches, "html"):
            for row in batch.to_pylist():
                if out is None:
                    name, held, count, packer = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0, zlib.compressobj(LEVEL, wbits=GZIP)
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                payload = (row["html"] or "").encode()
                revisit = row["record_type"] == "revisit"
                data = record(row["record_type"], row["page_id"], row["url"], b"" if revisit else payload, row["digest"],
                              row["refers_to"] if revisit else None, len(payload))
                out.write(packer.compress(data))
                held, count = held + len(data), count + 1
                if held >= ARCHIVE_BYTES:
                    yield finish()
                    out = None
        if out is not None:
            yield finish()

    return pages.mapInArrow(write, "archive string, n_records long")


def one_a_task(archives: DataFrame) -> DataFrame:
    """Archives in as many partitions as there are, which adaptive execution does not merge by the bytes of names."""
    return archives.repartition(max(1, archives.count()))


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """(archive, offset, length): every record of each archive as its own member of a new file, with a sidecar."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(source)
        out_store, out_root = opened(target)
        out_store.create_dir(out_root, recursive=True)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                name, at, places = f"{archive.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz", 0, []
                with (store.open_input_stream(f"{root}/{archive}", compression=None) as stream,
                      out_store.open_output_stream(f"{out_root}/{name}", compression=None) as out,
                      out_store.open_output_stream(f"{out_root}/{name}.idx", compression=None) as sidecar):
                    for data in records(inflated(stream)):
                        packer = zlib.compressobj(LEVEL, wbits=GZIP)
                        member = packer.compress(data) + packer.flush()
                        out.write(member)
                        sidecar.write(f"{at} {len(member)}\n".encode())
                        places.append((at, len(member)))
                        at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(places), pa.string()), pa.array([p for p, _ in places], pa.int64()),
                     pa.array([n for _, n in places], pa.int64())], ["archive", "offset", "length"])

    return archives.mapInArrow(rewrite, "archive string, offset long, length long")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Every record an index lists, fetched by its place: id, full payload's length and digest, type, reference."""

    def page(urn: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
        return int(found[1]) if found else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        name, stream = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if archive != name:
                    name, stream = archive, store.open_input_file(f"{root}/{archive}")
                fields, http, payload = parsed(zlib.decompress(stream.read_at(length, offset), GZIP))
                kind = fields["warc-type"]
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{archive} at {offset}: the payload is not what was written")
                rows.append({"page_id": page(fields["warc-record-id"]), "payload_bytes": int(http["content-length"]),
                             "payload_digest": digest, "record_type": kind, "refers_to": page(fields.get("warc-refers-to"))})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                ("record_type", pa.string()), ("refers_to", pa.int64())]))

    # An index row is small and what it stands for is not, so the number of tasks is given, not left to the rows' bytes.
    parts = index.withColumn("part", F.floor(F.col("offset") / SPLIT_BYTES))
    dealt = parts.repartition(max(1, parts.select("archive", "part").distinct().count()), "archive", "part")
    return dealt.sortWithinPartitions("archive", "offset").select("archive", "offset", "length").mapInArrow(read, RECORD)


def archive_pages(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", folder: str | None = None,
) -> DataFrame:
    """Write, normalise, read back: page_id, payload_bytes, payload_digest, record_type, refers_to for each row.

    Of equal payloads of at least 100 bytes the smallest id is a response and others revisit it; shorter ones
    and rows without id are responses. Rows that repeat the smallest id are responses as well. A null html is
    an empty payload, and one of any length is a record of its own. Extra columns are left out; an empty table writes no archive. ``folder`` keeps the
    archives; without it they go to the shared working folder.

    Pages are not shuffled while the payloads that repeat are few (their counted digests are then broadcast);
    beyond that they are joined by digest, where Spark splits a digest that very many pages have.
    """
    spark = pages.sparkSession
    folder = folder or working_path(spark, "archives")
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"),
        F.col(html_column).cast("string").alias("html"))
    digest = F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest")
    long = rows.filter((F.octet_length("html") >= LEAST_DUPLICATE) & F.col("page_id").isNotNull()).select("page_id", digest)
    repeated = long.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    revisit = F.col("page_id") > F.col("first_id")
    judged = rows.select("*", digest).join(broadcast_if_small(stored(repeated, "repeated-payloads")), "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"))
    archives = stored(write_archives(judged, f"{folder}/monolithic"), "archives")
    index = stored(normalise(one_a_task(archives.select("archive")), f"{folder}/monolithic", f"{folder}/records"), "record-index")
    return read_records(index, f"{folder}/records")
