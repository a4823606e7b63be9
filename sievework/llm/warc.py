"""WARC archives with an index first: records by offset, then coalesced byte ranges.

Every task writes the records of its rows to an archive of its own in the shared folder and gives one
index row a record: archive, offset, length, URL, payload digest. Readers select index rows, and
neighbouring records of an archive are read with one request. A payload is stored once; other records
with the same digest are revisits that name the page that has it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import blocks, scratch, stored

# Fixed values of the format.
VERSION = b"WARC/1.1"
BREAK = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"

SPAN, GAP = 8 << 20, 64 << 10   # bytes of one read, and of unwanted records between two wanted ones
TASK_SPANS = 2                  # stretches of SPAN bytes that a task reads, about
LEVEL = 1                       # of compression
INDEX = "page_id long, url string, archive string, offset long, length long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def sized(pages: DataFrame) -> DataFrame:
    """Pages with the digest of their payload; a null page is an empty payload."""
    return pages.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))


def with_originals(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Pages with ``refers_to``, the largest page id of their payload; null on that page itself."""
    pages = sized(pages.select("page_id", "url", "html"))
    small = F.coalesce(F.octet_length("html"), F.lit(0)) < min_bytes
    first = pages.groupBy("digest").agg(F.max("page_id").alias("original"))
    joined = pages.join(first, "digest")
    return joined.select("page_id", "url", "html", F.when(small | F.expr("page_id <=> original"), None).otherwise(F.col("original")).alias("refers_to"))


def header(fields: list[tuple[str, str]]) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in fields]
    return BREAK.join(lines) + BREAK * 2


def one_line(text: str) -> str:
    return " ".join(text.split("\r")).replace("\n", " ")


def record(page_id, url, payload: bytes, refers_to, digest: str) -> bytes:
    """One record; a revisit keeps the size of its payload, but not the payload."""
    kind, body = ("response", payload) if refers_to is None else ("revisit", b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", RECORD_DATE),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", one_line(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return header([*fields, ("Content-Length", str(len(body)))]) + body + BREAK * 2


def written(batches, folder: str):
    """Write an archive; its name is new with every attempt, so an index row always fits its file."""
    store, root = pafs.FileSystem.from_uri(folder)
    name = f"{uuid.uuid4().hex}.warc.gz"
    out, offset = None, 0
    for batch in blocks(batches, column="html"):
        rows = []
        for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
            payload = (html or "").encode()
            digest = base32_sha1(payload)
            packer = zlib.compressobj(LEVEL, wbits=31)
            data = packer.compress(record(page_id, url, payload, refers_to, digest)) + packer.flush()
            out = out or store.open_output_stream(f"{root}/{name}", compression=None)
            out.write(data)
            rows.append((page_id, url, name, offset, len(data), len(payload), digest, "response" if refers_to is None else "revisit", refers_to))
            offset += len(data)
        yield pa.RecordBatch.from_pylist([dict(zip(NAMES, r)) for r in rows], schema=INDEX_SCHEMA)
    if out is not None:
        out.close()


NAMES = [c.split()[0] for c in INDEX.split(", ")]
INDEX_SCHEMA = pa.schema([(n, pa.string() if c.endswith("string") else pa.int64()) for n, c in zip(NAMES, INDEX.split(", "))])


def uri(path: str) -> str:
    return path if "://" in path else "file://" + path.removeprefix("file:")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> tuple[str, DataFrame]:
    """Write one record per row and return the folder and the index, which is stored itself.

    Of pages with equal payloads of ``min_bytes`` or more, the one with the largest id is the response
    (rows that repeat this id are responses too); the others are revisits of it. Null ids never win over
    others and are responses where a payload has no other. A null page is an empty payload, a null URL
    leaves the field out. An empty table gives an empty index.
    """
    folder = uri(folder or scratch(pages.sparkSession, "warc"))
    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root)
    return folder, stored(with_originals(pages, min_bytes).mapInArrow(partial(written, folder=folder), INDEX), "warc-index")


def coalesced(rows: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, first row, last row + 1) of the reads that cover sorted (offset, length) pairs."""
    spans: list[list[int]] = []
    for k, (offset, length) in enumerate(rows):
        if spans and offset - spans[-1][1] <= GAP and max(offset + length, spans[-1][1]) - spans[-1][0] <= SPAN:
            spans[-1][1], spans[-1][3] = max(offset + length, spans[-1][1]), k + 1
        else:
            spans.append([offset, offset + length, k, k + 1])
    return [tuple(s) for s in spans]


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and body of a compressed record."""
    plain = zlib.decompress(data, wbits=31)
    top, _, rest = plain.partition(BREAK * 2)
    lines = top.split(BREAK)
    if lines[0] != VERSION:
        raise ValueError(f"no record: {lines[0][:40]!r}")
    fields = dict(line.decode().split(": ", 1) if b": " in line else (line.decode().rstrip(":"), "") for line in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    if len(rest) != len(body) + 4:
        raise ValueError("record with a wrong length")
    return fields, body


def page_of(field: str | None) -> int | None:
    number = (field or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_back(batches, folder: str, bodies: bool):
    """Records of index rows sorted by archive and offset, in coalesced reads."""
    store, root = pafs.FileSystem.from_uri(folder)
    for batch in blocks(batches):
        names, offsets, lengths = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
        out, at = [], 0
        while at < len(names):
            end = at
            while end < len(names) and names[end] == names[at]:
                end += 1
            with store.open_input_file(f"{root}/{names[at]}") as f:
                for start, stop, a, b in coalesced(list(zip(offsets[at:end], lengths[at:end]))):
                    data = f.read_at(stop - start, start)
                    for k in range(at + a, at + b):
                        fields, body = parsed(data[offsets[k] - start:offsets[k] - start + lengths[k]])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if fields["WARC-Type"] == "response" and base32_sha1(body) != digest:
                            raise ValueError(f"{names[k]} at {offsets[k]}: payload does not fit its digest")
                        out.append((page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), int(fields["X-Payload-Length"]), digest,
                                    fields["WARC-Type"], page_of(fields.get("WARC-Refers-To")), body.decode() if bodies and fields["WARC-Type"] == "response" else None))
            at = end
        yield pa.RecordBatch.from_pylist([dict(zip(RECORD_SCHEMA.names, r)) for r in out], schema=RECORD_SCHEMA)


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
RECORD_SCHEMA = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in RECORD.split(", ")])


def read_records(folder: str, selected: DataFrame, bodies: bool = True) -> DataFrame:
    """The records of the selected index rows: page_id, url, sizes, digest, kind, refers_to and html.

    Rows are dealt by archive and stretch of the archive, and sorted, so that reads coalesce; the number
    of tasks follows the bytes of the archives, not those of the index. Each response is checked against its digest. ``html`` is null on revisits (the page in ``refers_to`` has
    it), and everywhere without ``bodies``.
    """
    placed = selected.select("archive", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / SPAN))
    total = placed.agg(F.sum("length")).first()[0] or 0
    dealt = placed.repartition(total // (TASK_SPANS * SPAN) + 1, "archive", "stretch").sortWithinPartitions("archive", "offset")
    return dealt.select("archive", "offset", "length").mapInArrow(partial(read_back, folder=folder, bodies=bodies), RECORD)
