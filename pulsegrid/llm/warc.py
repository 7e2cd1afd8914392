"""WARC archives: one gzip member per record, read back in byte ranges.

Writing: of records with equal payloads one is a response, the others are revisits that name it and hold its HTTP header
only. Each task writes files of its own; a file counts once its row of the manifest, an ordinary table, is committed, so
what a lost or repeated task left behind is never read.

Reading: a task scans its byte range for the gzip magic, takes a place for a record if what it decodes to begins with
a whole WARC header, and owns every record that starts in its range, also where it ends in the next. Compressed data can hold the
magic by chance, which the header rules out; the writer sees to it that no record holds a copy of another as it is.

Defined cases: a NULL payload is empty; a NULL URL is left out; a NULL id is written as an empty name and read as NULL; rows that
share the smallest id of a payload are responses all; equal rows are records of their own; an empty table gives no records;
other columns are not carried.
"""

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_dir, stored
from .columns import in_small_batches

# Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 1 << 30
SPLIT_BYTES = 64 << 20
#: Tasks that ranges are dealt to at most.
MOST_TASKS = 1 << 14
_LEVEL, _BLOCK, _STEP = 4, 4 << 20, 1 << 14
_NAME = "<urn:record:{}>"


def digest(payload):
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key, url, payload, refers_to=None, date=DATE):
    """The bytes of one record, not compressed."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_NAME.format('' if key is None else key)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if revisit:
        head += [f"WARC-Refers-To: {_NAME.format(refers_to)}", f"WARC-Profile: {IDENTICAL}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compressed(data):
    """A gzip member. Data that deflate copies as it is could hold the magic of a record inside; a block ends in each."""
    packer, parts, at = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31), [], 0
    place = data.find(MAGIC)
    while place >= 0:
        parts += [packer.compress(data[at:place + 1]), packer.flush(zlib.Z_SYNC_FLUSH)]
        at, place = place + 1, data.find(MAGIC, place + 1)
    return b"".join([*parts, packer.compress(data[at:]), packer.flush()])


# ---- Reading ----

class Blocks:
    """Bytes of a file by place, from a block that moves along."""

    def __init__(self, file, size):
        self.file, self.size, self.start, self.block = file, size, 0, b""

    def __call__(self, start, n):
        if not self.start <= start <= start + n <= self.start + len(self.block):
            want = min(max(n, _BLOCK), self.size - start)
            self.start, self.block = start, self.file.read_at(want, start) if want > 0 else b""
        return self.block[start - self.start:start - self.start + n]


def decoded(read, place):
    """(bytes, end) of the member that starts here; None if it isn't a record. A header may have any length."""
    flags = read(place + 3, 1)
    if not flags or flags[0] & 0xE0:
        return None
    unpacker, made, at = zlib.decompressobj(31), bytearray(), place
    while not unpacker.eof:
        data = read(at, _STEP)
        if not data:
            return None
        at += len(data)
        try:
            made += unpacker.decompress(data)
        except zlib.error:
            return None
        if made[:5] != b"WARC/"[:len(made)]:
            return None
    return (bytes(made), at - len(unpacker.unused_data)) if b"\r\n\r\n" in made else None


def records(read, start, end, size=None):
    """(place, bytes) of all records that start from ``start`` to before ``end``.

    With ``size``, that of a file of our writer, records must stand side by side from the first byte to the last: a place between
    two of them without a record is an error. The task that owns a record looks at the place behind it, also in the next range.
    """
    place, due = start, 0 if start == 0 else None
    while place < end:
        data = read(place, min(_STEP, end - place) + len(MAGIC) - 1)
        if not data:
            break
        found = data.find(MAGIC)
        if found < 0:
            place += max(1, len(data) - len(MAGIC) + 1)
            continue
        place += found
        if place >= end:
            break
        member = decoded(read, place)
        if member is None:
            place += 1
        else:
            if size is not None and due not in (None, place):
                raise ValueError(f"no record at byte {due}")
            yield place, member[0]
            place = due = member[1]
    if size is not None and due is not None and due < size and (due < end or decoded(read, due) is None):
        raise ValueError(f"no record at byte {due}")


def _fields(lines):
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _key(name):
    found = re.fullmatch(r"<urn:record:(.*)>", name or "")
    return found[1] if found and found[1] else None


def parsed(data):
    """(key, url, type, refers_to, digest, payload or None, payload bytes) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _fields(head.decode("utf-8", "replace").split("\r\n")[1:])
    block = rest[:int(warc.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = warc.get("warc-type")
    if kind == "revisit":
        said = _fields(http.decode("utf-8", "replace").split("\r\n")[1:])
        return (_key(warc.get("warc-record-id")), warc.get("warc-target-uri"), kind, _key(warc.get("warc-refers-to")),
                (warc.get("warc-payload-digest") or "").removeprefix("sha1:"), None, int(said.get("content-length", 0)))
    return (_key(warc.get("warc-record-id")), warc.get("warc-target-uri"), kind, None, digest(payload), payload, len(payload))


# ---- Jobs ----

def with_first(rows, least_bytes=0):
    """key, url, payload and ``refers_to``: the smallest key with an equal payload, where that is another one."""
    rows = rows.withColumn("same", F.sha2("payload", 256))
    firsts = rows.where(F.length("payload") >= least_bytes).groupBy("same").agg(
        F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").select("same", "first")
    rows = rows.join(stored(firsts, "repeated-payloads"), "same", "left")
    other = ~F.col("first").eqNullSafe(F.col("key"))
    return rows.select("key", "url", "payload", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(df, folder, key="page_id", url="url", payload="html", least_bytes=0, archive_bytes=ARCHIVE_BYTES):
    """Write a record per row below ``folder``; the manifest (path, bytes, records) of the files written."""
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("url"),
                     F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = with_first(rows, least_bytes)

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, size, n = None, None, 0, 0
        for batch in batches:
            for k, u, p, r in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, n = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                member = compressed(record(k, u, p, r))
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield manifest(name, size, n)
        if out is not None:
            out.close()
            yield manifest(name, size, n)

    def manifest(name, size, n):
        return pa.RecordBatch.from_pydict({"path": [f"{folder.rstrip('/')}/{name}"], "bytes": [size], "records": [n]})

    return stored(in_small_batches(rows).mapInArrow(run, "path string, bytes long, records long"), "manifest")


def archives_in(spark, folder):
    """(path, bytes) of all archives below a folder that others wrote."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option(
        "recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("bytes"))


def read_archives(manifest, split_bytes=SPLIT_BYTES, payloads=True):
    """A row per record of the files in (path, bytes): path, place, key, url, type, refers_to, digest, payload, payload_bytes.

    The digest is that of the payload read, or for a revisit the one it states. Without ``payloads`` the column is NULL.
    A manifest with ``records`` is one of our writer: if a file of it gives fewer records, or is cut short, reading fails.
    """
    own = "records" in manifest.columns
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.lit(own).alias("own"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    schema = ("path string, place long, key string, url string, type string, refers_to string, digest string, "
              "payload binary, payload_bytes long")
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.binary(), pa.int64()]
    names = [f.name for f in T._parse_datatype_string(schema).fields]

    def run(batches):
        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for path, size, whole, start in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                store, inside = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(inside) as file:
                    for place, data in records(Blocks(file, size), start, min(start + split_bytes, size), size if whole else None):
                        *head, payload, n = parsed(data)
                        rows.append((path, place, *head, payload if payloads else None, n))
                        held += n if payloads else 200
                        if held > 16 << 20:
                            yield made(rows)
                            rows, held = [], 0
                if rows:
                    yield made(rows)

    tasks = max(1, min(ranges.count(), MOST_TASKS))  # given, or the small rows of many ranges would meet in one task
    return ranges.repartition(tasks, "path", "start").mapInArrow(run, schema)


def archive_folder(spark):
    return new_dir(spark, "archives")
