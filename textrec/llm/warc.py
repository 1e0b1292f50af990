"""WARC: writer with revisit records, and a splittable reader.

Writing.  Each task writes one archive of gzip members, a record each, under a
name of its own attempt, and reports the file; only files that successful
tasks report are in the manifest, so a lost or repeated attempt leaves nothing
that a reader would see.  Payloads are grouped by SHA-1: the record with the
smallest id is the response, the others are revisit records that refer to it
and carry no payload.  The grouping runs on (id, digest) alone, without the
payloads; a digest that a third of all rows share is one row after the partial
aggregation, and the join back is on the record's own id and digest.

Reading.  A file is dealt out as byte ranges.  A task looks for the gzip magic
from the start of its range on, takes a candidate for a member only if it
decompresses to a WARC header with a valid length, and from then on follows
member after member.  It owns the records that start inside its range, and
reads beyond its end to finish the last one.  So any split gives every record
exactly once, and a damaged stretch costs only the records inside it.

A run compares the records read with the manifest and fails on a difference.

Defined cases: null html is an empty payload; null url or id are left out of
the record (the row's id comes back null); ids may hold any characters; other
columns are not read; records with equal payloads and the
same smallest id are all responses; payloads below ``min_bytes`` are always
responses; an empty table gives no files and an empty result."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.llm.common import ship_package, slices, table
from textrec.session import materialize, scratch_path

RANGE_BYTES = 4 << 20
READ_BYTES = 256 << 10
#: A header block longer than this is no record's.
MAX_HEADER = 64 << 10
MIN_REVISIT_BYTES = 0
#: Records are handed on in batches of about this many payload bytes.
BATCH_BYTES = 4 << 20

#: The start of a gzip member (deflate), of a WARC record, and
#: the profile of revisit records.
GZIP_MAGIC = b"\x1f\x8b\x08"
WARC_VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(record_id) -> str:
    """Whatever an id holds, its name stays on one line and can be read back."""
    return f"<urn:record:{quote(str(record_id), safe='')}>"


def urn_id(urn: str | None) -> str | None:
    m = re.fullmatch(r"<urn:record:(.*)>", urn or "")
    return None if m is None else unquote(m[1])


def header_value(text) -> str:
    """A value that stays on its line."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", str(text))


def member(record_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member."""
    revisit = refers_to is not None
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Date", DATE)]
    if record_id is not None:
        fields.append(("WARC-Record-ID", record_urn(record_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", header_value(url)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", len(payload)),
               ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_urn(refers_to))]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))]).encode()
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(WARC_VERSION + head + b"\r\n" + block + b"\r\n\r\n") + c.flush()


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """record_id, url, payload and refers_to (null for responses)."""
    rows = pages.select(
        F.col("page_id").alias("record_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")) \
        .withColumn("digest", F.sha1("payload"))
    keys = rows.where((F.length("payload") >= min_bytes) & F.col("record_id").isNotNull()).select("record_id", "digest")
    first = materialize(keys.groupBy("digest").agg(F.min("record_id").alias("first"), F.max("record_id").alias("last"))
                        .where("first != last").select("digest", "first"), "warc-first")
    revisits = (keys.join(first, "digest").where("record_id != first")
                .select("record_id", "digest", F.col("first").alias("refers_to")).distinct())
    return rows.join(revisits, ["record_id", "digest"], "left").select("record_id", "url", "payload", "refers_to")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the records into ``folder`` and return the manifest: path, bytes,
    records.  ``folder`` is a URI that every executor reaches."""
    ship_package(records.sparkSession)

    def run(batches):
        fs, base = open_store(folder)
        out, name, n, size = None, "", 0, 0
        for batch in batches:
            for rows in slices(batch, "payload"):
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                for row in rows.to_pylist():
                    payload = row["payload"]
                    data = member(row["record_id"], row["url"], payload, base32_sha1(payload), row["refers_to"])
                    out.write(data)
                    n, size = n + 1, size + len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder.rstrip('/')}/{name}"], "bytes": [size], "records": [n]})

    return materialize(records.mapInArrow(run, "path string, bytes bigint, records bigint"), "warc-manifest")


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or an absolute path, and the path in it."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return pafs.LocalFileSystem(), uri


class RangeReader:
    """Records of one archive that start in [start, end)."""

    def __init__(self, source, size: int, start: int, end: int):
        self.source, self.size, self.start, self.end = source, size, start, min(end, size)
        self.buffer, self.base = b"", start

    def window(self, at: int, n: int) -> bytes:
        """Up to n bytes from ``at``, through one buffer."""
        if not self.base <= at <= self.base + len(self.buffer) or at + n > self.base + len(self.buffer):
            want = min(max(n, READ_BYTES), self.size - at)
            self.source.seek(at)
            self.buffer, self.base = (self.source.read(want) if want > 0 else b""), at
        return self.buffer[at - self.base:at - self.base + n]

    def next_magic(self, at: int) -> int | None:
        """The first place from ``at`` on, before the end of the range, that
        holds the magic."""
        while at < self.end:
            data = self.window(at, min(READ_BYTES, self.size - at))
            if (k := data.find(GZIP_MAGIC)) >= 0:
                return at + k if at + k < self.end else None
            if at + len(data) >= self.size:
                return None
            at += max(1, len(data) - len(GZIP_MAGIC) + 1)
        return None

    def decode(self, at: int) -> tuple[dict, bytes, int] | None:
        """Headers, block and end of the member at ``at``; None if it is none.
        Data that doesn't start as a record is given up after its first bytes."""
        d = zlib.decompressobj(31)
        out, head, pos = bytearray(), None, at
        try:
            while not d.eof:
                piece = self.window(pos, READ_BYTES)
                if not piece:
                    return None
                out += d.decompress(piece)
                pos += len(piece)
                if not out.startswith(WARC_VERSION[:len(out)]):
                    return None
                if head is None:
                    if (cut := out.find(b"\r\n\r\n")) >= 0:
                        head = parse_headers(bytes(out[:cut]))
                        if head is None or not re.fullmatch(r"[0-9]+", head.get("content-length", "")):
                            return None
                    elif len(out) > MAX_HEADER:
                        return None
        except zlib.error:
            return None
        if head is None:
            return None
        body = out.find(b"\r\n\r\n") + 4
        length = int(head["content-length"])
        if len(out) != body + length + 4 or out[-4:] != b"\r\n\r\n":
            return None
        return head, bytes(out[body:body + length]), pos - len(d.unused_data)

    def records(self):
        at = self.start
        while (at := self.next_magic(at)) is not None:
            found = self.decode(at)
            if found is None:
                at += 1
                continue
            yield found[:2]
            at = found[2]


def parse_headers(block: bytes) -> dict[str, str] | None:
    lines = block.decode("utf-8", "replace").split("\r\n")
    pairs = [line.partition(":") for line in lines[1:]]
    if any(not sep for _, sep, _ in pairs):
        return None
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def byte_ranges(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, size, start, end: one row for each range, dealt out evenly to as many
    tasks as there are ranges, or a sixteenth of that where it is more than the
    session's usual number (a range is small; rows of ranges are too small for
    Spark to see the work behind them)."""
    ranges = manifest.select(
        "path", F.col("bytes").alias("size"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0)),
                             F.lit(range_bytes).cast("bigint"))).alias("start")).withColumn("end", F.col("start") + range_bytes)
    n = manifest.agg(F.sum(F.greatest(F.ceil(F.col("bytes") / range_bytes), F.lit(1)))).first()[0] or 1
    usual = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(min(n, max(usual, n // 16)))


def check_complete(records: DataFrame, manifest: DataFrame) -> None:
    """Raises if a file gave other than the number of records that its task wrote."""
    found = records.groupBy("path").agg(F.count("*").alias("found"))
    wrong = (manifest.join(found, "path", "left").where(~F.col("records").eqNullSafe(F.coalesce("found", F.lit(0))))
             .agg(F.count("*").alias("files"), F.min("path").alias("path")).first())
    if wrong["files"]:
        raise RuntimeError(f"{wrong['files']} archives don't give the records written to them, such as {wrong['path']}")


def read_archives(ranges: DataFrame, id_type: str = "bigint", with_block: bool = True) -> DataFrame:
    """One row per record of the given ranges.  ``payload_ok`` tells whether a
    response's payload has the digest and the length of its headers."""
    ship_package(ranges.sparkSession)

    def rows_of(path, size, start, end):
        fs, name = open_store(path)
        with fs.open_input_file(name) as source:
            for head, block in RangeReader(source, size, start, end).records():
                payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
                digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                kind = head.get("warc-type")
                ok = kind != "response" or (digest == base32_sha1(payload)
                                            and str(len(payload)) == head.get("x-payload-length"))
                length = head.get("x-payload-length", "")
                yield {"path": path, "record_id": urn_id(head.get("warc-record-id")), "record_type": kind,
                       "url": head.get("warc-target-uri"),
                       "payload_bytes": int(length) if length.isdigit() else len(payload), "payload_digest": digest,
                       "refers_to": urn_id(head.get("warc-refers-to")), "payload_ok": ok,
                       "payload": payload if with_block else None}, len(payload)

    schema = pa.schema([("path", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
                        ("payload_ok", pa.bool_()), ("payload", pa.binary())])

    def run(batches):
        out, total = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                for row, n in rows_of(r["path"], r["size"], r["start"], r["end"]):
                    out.append(row)
                    total += (n if with_block else 0) + 200
                    if total >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, total = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    read = ranges.select("path", "size", "start", "end").mapInArrow(
        run, "path string, record_id string, record_type string, url string, payload_bytes bigint, payload_digest string, "
             "refers_to string, payload_ok boolean, payload binary")
    return read.withColumns({c: F.col(c).cast(id_type) for c in ("record_id", "refers_to")})


def op9_splittable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = write_archives(with_revisits(pages), scratch_path(spark, "warc"))
    records = materialize(read_archives(byte_ranges(manifest), dict(pages.dtypes)["page_id"], with_block=False), "warc-records")
    check_complete(records, manifest)
    return records.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          "refers_to", "payload_ok")
