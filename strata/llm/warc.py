"""Web archives: writing, normalising monolithic gzip, and reading by index.

Archives are written as one gzip stream over the whole file, the form that many
tools produce and that allows no random access. The normaliser inflates such a
stream once, in bounded pieces, finds the records by their headers, writes each
as a gzip member of its own, and keeps a sidecar index: for every record its
archive and the offset and length of its member. A record is then read from the
index without inflating anything else.

Of records with equal payloads the one with the smallest page id holds the
payload (response); the others refer to it (revisit).

Files are written by Spark's text writer with lineSep NUL, one archive a file
(``archive=<id>/kind=warc/part-*``): gzip readers skip zero bytes after the last member.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import drop_path, new_path, prepare, store

# Uncompressed bytes of an archive (a record stays whole), and of one step of inflation.
ARCHIVE_BYTES = 16 << 20
INFLATE_BYTES = 1 << 20
LEVEL = 6
_PREFIX = "urn:strata:page:"


def payload_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode("ascii")


def _header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode("utf-8")


def make_record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """A response, or a revisit if ``refers_to`` is given. X-Payload-Length is the
    length of the full payload, which a revisit does not hold."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_PREFIX}{'none' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", "sha1:" + payload_digest(hashlib.sha1(payload).digest())),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url)))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{_PREFIX}{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields) + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields in lower case, block) of one whole record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def records_of(stream) -> "object":
    """Whole records, one after another, of an iterator of inflated bytes."""
    held = bytearray()
    need = None
    for piece in stream:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                fields, _ = parse_record(bytes(held[: end + 4]) + b"")
                need = end + 4 + int(fields["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends within a record")


def inflate(raw: bytes):
    """Bounded pieces of what a gzip file holds, whatever its members; zero bytes
    after a member are padding."""
    at = 0
    while at < len(raw):
        if raw[at] == 0:
            at += 1
            continue
        d = zlib.decompressobj(31)
        data = raw[at:]
        while not d.eof:
            piece = d.decompress(data, INFLATE_BYTES)
            if not piece and not d.unconsumed_tail and not d.eof:
                raise ValueError("the gzip stream is cut off")
            if piece:
                yield piece
            data = d.unconsumed_tail
        at = len(raw) - len(d.unused_data)


def plan_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with payload and refers_to.

    Copies are found by digest and length; only payloads met on more than one page
    are joined back, so a hot payload is a skewed join key that Spark splits, never
    a group in one task. Null html: empty payload. A null page id is never
    referred to; rows that share the smallest id of a payload are all responses."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = keyed.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    firsts = store(
        keyed.where(F.col("size") >= least_bytes).groupBy("sha", "size").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
        .select("sha", "size", "first_id"), "revisits",
    )
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id"))
    return keyed.join(firsts, ["sha", "size"], "left").select("page_id", "url", "payload", F.when(other, F.col("first_id")).alias("refers_to"))


def write_monolithic(records: DataFrame, path: str) -> None:
    """Records (page_id, url, payload, refers_to) as archives of about
    ARCHIVE_BYTES, each one gzip stream over the whole file."""

    def run(batches):
        held, size, out = [], 0, []

        def archive():
            z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            raw = b"".join([*map(z.compress, held), z.flush()])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["raw"])

        for batch in batches:
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(make_record(page_id, url, payload, first))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    size = 0
        if held:
            yield archive()

    (
        records.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "raw binary").select(F.col("raw").cast("string").alias("value"))
        .write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path)
    )


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive under ``source`` under ``target`` with a member per
    record, and its sidecar index beside it (``archive=<id>/kind=warc`` and
    ``kind=index``: lines of record id, offset and length). Both come from one pass
    that inflates each archive once. Returns the index: archive, record_id,
    offset, length."""
    prepare(spark)

    def run(batches):
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                members, index, at = [], [], 0
                for record in records_of(inflate(raw.as_buffer().to_pybytes())):
                    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = z.compress(record) + z.flush()
                    fields, _ = parse_record(record[: record.index(b"\r\n\r\n") + 4])
                    index.append(f"{fields['warc-record-id']} {at} {len(member)}\n")
                    members.append(member)
                    at += len(member)
                name = "a" + hashlib.md5(path.encode("utf-8")).hexdigest()  # never read as a number
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name, name]), pa.array(["index", "warc"]), pa.array(["".join(index).encode("utf-8"), b"".join(members)], pa.binary())],
                    ["archive", "kind", "raw"],
                )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    (
        files.select("path", "content").mapInArrow(run, "archive string, kind string, raw binary")
        .select("archive", "kind", F.col("raw").cast("string").alias("value"))
        .write.partitionBy("archive", "kind").option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(target)
    )
    return read_index(spark, target)


def _files(spark: SparkSession, target: str, kind: str) -> DataFrame:
    """(archive, content) of the files of one kind; none, if nothing was written."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(target)
    if "kind" not in files.columns:
        return spark.createDataFrame([], "archive string, content binary")
    return files.where(F.col("kind") == kind).select("archive", "content")


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The sidecar indexes of all archives: archive, record_id, offset, length."""
    lines = _files(spark, target, "index").select("archive", F.explode(F.split(F.rtrim(F.col("content").cast("string"), F.lit("\x00")), "\n")).alias("line"))
    parts = lines.where("line <> ''").select("archive", F.split("line", " ").alias("p"))
    return parts.select("archive", F.col("p")[0].alias("record_id"), F.col("p")[1].cast("long").alias("offset"), F.col("p")[2].cast("long").alias("length"))


def read_records(spark: SparkSession, target: str, index: DataFrame) -> DataFrame:
    """Every indexed record, read by seeking to its member: page_id,
    payload_bytes, payload_digest, record_type, refers_to and the block's length."""
    prepare(spark)
    prefix = f"<{_PREFIX}"

    def number(urn: str | None):
        return int(urn[len(prefix) : -1]) if urn and urn != f"{prefix}none>" else None

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "block_bytes")}
            for raw, entries in zip(batch.column(0), batch.column(1)):
                content = memoryview(raw.as_buffer())
                for e in entries.as_py():
                    fields, block = parse_record(zlib.decompress(content[e["offset"] : e["offset"] + e["length"]], 31))
                    if fields["warc-record-id"] != e["record_id"]:
                        raise ValueError("the index does not fit the archive")
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if payload_digest(hashlib.sha1(payload).digest()) != digest:
                            raise ValueError(f"damaged payload in {e['record_id']}")
                    row = (number(fields["warc-record-id"]), int(fields["x-payload-length"]), digest, fields["warc-type"], number(fields.get("warc-refers-to")), len(block))
                    for column, value in zip(out.values(), row):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    files = _files(spark, target, "warc")
    entries = index.groupBy("archive").agg(F.collect_list(F.struct("record_id", "offset", "length")).alias("entries"))  # bounded by an archive's size
    return files.join(entries, "archive").select("content", "entries").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, block_bytes long"
    )


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to monolithic archives, normalise them and read them back.
    An empty table writes nothing and gives an empty result."""
    spark = prepare(pages.sparkSession)
    raw, normal = new_path(spark, "warc-monolithic"), new_path(spark, "warc")
    write_monolithic(plan_revisits(pages, least_bytes), raw)
    index = normalise(spark, raw, normal)
    drop_path(spark, raw)
    if index.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, block_bytes long")
    return read_records(spark, normal, index)
