"""WARC archives: writing, normalising monolithic gzip files, and reading by index.

``write_archives`` makes a record per page, laid out by Spark's text writer as one gzip stream
per file, the form that cannot be entered midway. ``normalise`` inflates each such stream once,
rewrites every record as a gzip member of its own and adds a sidecar index of offsets.
``read_archives`` goes by that index from member to member.

Records with equal payloads: the one with the largest ``page_id`` (of several rows with it, one)
is a ``response``, the others are ``revisit`` records without payload that refer to it.

A null html is an empty payload. A null url leaves the target out; line ends in urls are
percent-encoded. Rows without ``page_id`` are written and read like others, a response among
equals only if none has an id. An empty table makes no archives.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import stored
from tidemark.session import scratch_dir

END = "\r\n\r\n"
CHUNK = 1 << 20
# The alphabets of base 32 by number and as WARC digests are written.
NUMBER_DIGITS, DIGEST_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(text: Column) -> Column:
    """Upper-case base 32 of the SHA-1 of a text's UTF-8 bytes: 20 bits give 4 digits."""
    hexa = F.sha1(text)
    digits = [F.lpad(F.conv(F.substring(hexa, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*digits), NUMBER_DIGITS, DIGEST_DIGITS)


def records(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest, record type and the response they refer to."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"), F.monotonically_increasing_id().alias("row"),
    ).withColumn("digest", digest(F.col("payload")))
    # Written before it is joined: only then can Spark split the rows of a very common payload.
    groups = rows.groupBy("digest").agg(F.max(F.struct("page_id", "row")).alias("top"), F.count("*").alias("n")).where("n > 1")
    groups = stored(groups.select("digest", F.col("top.page_id").alias("top_id"), F.col("top.row").alias("top_row")), "warc-groups")
    joined = rows.join(groups, "digest", "left")
    revisit = F.col("top_row").isNotNull() & (F.col("row") != F.col("top_row"))
    return joined.select(
        "page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("top_id")).alias("refers_to"), F.when(revisit, F.col("top_row")).alias("refers_row"), "row",
    )


def _record_id(page: str, row: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(":"), F.col(row).cast("string"), F.lit(">"))


def record_text(date: str) -> Column:
    """A whole record without its closing line ends."""
    revisit = F.col("kind") == "revisit"
    block = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("payload")))
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("kind"),
        F.lit("\r\nWARC-Record-ID: "), _record_id("page_id", "row"),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nX-Payload-Length: "), F.octet_length("payload").cast("string"),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("\r\nWARC-Target-URI: "), target)).otherwise(F.lit("")),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), _record_id("refers_to", "refers_row"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit(END), block,
    ]
    return F.concat(*lines)


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """One gzip stream per file; records end with two line ends, which is the writer's separator."""
    texts = records(pages).select(record_text(date).alias("value"))
    texts.write.option("compression", "gzip").option("lineSep", END).text(path)


class Stream:
    """Reads a compressed file as one inflated stream, a chunk at a time."""

    def __init__(self, source):
        self.source, self.buffer, self.inflater = source, bytearray(), zlib.decompressobj(47)

    def _more(self) -> bool:
        data = self.inflater.unconsumed_tail or self.inflater.unused_data
        if self.inflater.eof:
            self.inflater = zlib.decompressobj(47)
        data = data or self.source.read(CHUNK)
        if not data:
            return False
        self.buffer += self.inflater.decompress(data, CHUNK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``, or None at the end of the stream."""
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("the archive ends within a record")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        result = bytes(self.buffer[:n])
        del self.buffer[:n]
        return result


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


def record_stream(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of every record of an archive, monolithic or not."""
    stream = Stream(source)
    while (head := stream.until(END.encode())) is not None:
        named = fields(head)
        body = stream.take(int(named["content-length"]) + len(END))
        yield named, head + body


def normalise_one(files: fs.FileSystem, source: str, target: str) -> int:
    """Rewrites an archive with a member per record, and its index; returns the record count.

    Both are written under other names first and moved when whole, so that a task that is
    lost or run twice leaves nothing half done.
    """
    mark, offset, count = f".{uuid.uuid4().hex}", 0, 0
    with files.open_input_stream(source, compression=None) as raw, \
            files.open_output_stream(target + mark) as out, files.open_output_stream(target + ".idx" + mark) as index:
        for named, record in record_stream(raw):
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = packer.compress(record) + packer.flush()
            out.write(member)
            entry = {"offset": offset, "length": len(member), "id": named["warc-record-id"], "type": named["warc-type"]}
            index.write((json.dumps(entry) + "\n").encode())
            offset, count = offset + len(member), count + 1
    files.move(target + mark, target)
    files.move(target + ".idx" + mark, target + ".idx")
    return count


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _normaliser(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for uri in batch.column("path").to_pylist():
                files, source = _filesystem(uri)
                _, base = _filesystem(folder)
                name = source.rsplit("/", 1)[-1].removesuffix(".txt.gz") + ".warc.gz"
                done.append((f"{folder}/{name}", normalise_one(files, source, f"{base}/{name}")))
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["path", "n_records"])
    return run


def archive_paths(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """One partition per archive, so that each is a task that can be repeated alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return listed.repartition(max(1, min(listed.count(), 10_000)))


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(path, n_records) of the archives written to ``target``, a folder that all executors share."""
    files, base = _filesystem(target)
    files.create_dir(base, recursive=True)
    return stored(archive_paths(spark, source, "*.gz").mapInArrow(_normaliser(target), "path string, n_records long"), "warc-done")


def read_one(files: fs.FileSystem, path: str) -> Iterator[tuple]:
    """Rows of an archive, each from its own member; payloads are held against their digests."""
    with files.open_input_stream(path + ".idx") as index:
        entries = [json.loads(line) for line in index.read().splitlines()]
    with files.open_input_file(path) as archive:
        for entry in entries:
            archive.seek(entry["offset"])
            record = zlib.decompress(archive.read(entry["length"]), 47)
            head, _, rest = record.partition(END.encode())
            named = fields(head + END.encode())
            sha1, size = named["warc-payload-digest"].removeprefix("sha1:"), int(named["x-payload-length"])
            if named["warc-type"] == "response":
                payload = rest[:int(named["content-length"])].partition(END.encode())[2]
                if base64.b32encode(hashlib.sha1(payload).digest()).decode() != sha1 or len(payload) != size:
                    raise ValueError(f"{entry['id']}: the payload does not have its digest")
            yield _page(named["warc-record-id"]), size, sha1, named["warc-type"], _page(named.get("warc-refers-to"))


def _page(record_id: str | None) -> int | None:
    page = record_id.split(":")[2] if record_id else ""
    return int(page) if page else None


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            rows = list(read_one(*_filesystem(uri)))
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in RECORDS.split(", ")])


def read_archives(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record."""
    return archives.select("path").mapInArrow(_reader, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages as monolithic archives, normalises those and reads them back."""
    spark = pages.sparkSession
    raw, members = scratch_dir(spark, "warc-raw"), scratch_dir(spark, "warc-members")
    write_archives(pages, raw)
    done = normalise(spark, raw, members)
    return read_archives(done.repartition(max(1, min(done.count(), 10_000))))
