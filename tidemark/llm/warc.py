"""WARC archives in Zstandard: one frame for each record, the dictionary in a leading skippable frame.

:class:`ArchiveReader` loads the dictionary from the skippable frame at the start (raw or itself compressed), decodes one
frame for each record, and checks version, headers, lengths and digests. A record whose checks fail
is reported with its place and the reason; the frame's end is known, so reading goes on behind it. Damage inside a
frame ends the archive, which is reported too.

The writer gives each task's rows an archive of its own. Of records with equal payloads of at least ``min_bytes``
bytes the one with the largest key is stored as a response; the others become revisits that name it.

Defined cases: a null or empty payload is an empty one; a null key comes before all others and is written as
an empty field; repeated rows with the largest key are all responses; a null address is written as an empty
one; an empty table gives no archives and no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tasks import Upload, map_batches, open_store, slices
from tidemark.workspace import broadcast_if_small, run_dir, shared_table

# Marks of the formats.
SKIPPABLE = 0x184D2A5D
VERSION = b"WARC/1.1"
FRAME = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ID_PREFIX, ID_SUFFIX = "<urn:page:", ">"

#: Payloads that a dictionary is trained on, in bytes and in number, and its size.
SAMPLE_BYTES, SAMPLE_COUNT, DICTIONARY_BYTES = 1 << 20, 200, 1 << 15
CHUNK = 1 << 18
#: Longest block that a reader accepts.
MAX_BLOCK = 1 << 30


def digest_of(payload: bytes) -> str:
    """SHA-1 in base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def trained(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from some payloads, or none if they are too few to train one."""
    samples = [s[: 1 << 16] for s in samples if len(s) >= 8]
    if len(samples) < 16:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    def __init__(self, upload: Upload, samples: list[bytes], level: int = 3):
        self.upload, self.count = upload, 0
        dictionary = trained(samples)
        if dictionary is not None:
            data = zstandard.ZstdCompressor(level=level).compress(dictionary.as_bytes())
            upload.write(struct.pack("<II", SKIPPABLE, len(data)) + data)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=True, write_checksum=True)

    def add(self, headers: list[tuple[str, str]], block: bytes) -> None:
        lines = [VERSION.decode(), *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
        self.upload.write(self.compressor.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n"))
        self.count += 1

    def page(self, key: int | None, url: str | None, payload: bytes, digest: str, response: int | None, revisit: bool) -> None:
        """One page, as a response or as a revisit of the response with key ``response``."""
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        block = http if revisit else http + payload
        target = quote(url or "", safe="%:/?#[]@!$&'()*+,;=~")
        name = lambda k: f"{ID_PREFIX}{'' if k is None else k}{ID_SUFFIX}"
        headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(key)), ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{digest_of(block)}"), ("Content-Type", "application/http; msgtype=response")]
        if revisit:
            headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", name(response))]
        self.add(headers, block)


class BadRecord(ValueError):
    """A record that breaks the format."""


class ArchiveReader:
    """Records of one archive as (place, headers, block); constant memory beside one record."""

    def __init__(self, stream):
        self.stream, self.buffer, self.place = stream, b"", 0

    def _fill(self, count: int) -> bool:
        while len(self.buffer) < count:
            data = self.stream.read(CHUNK)
            if not data:
                return False
            self.buffer += data
        return True

    def _take(self, count: int) -> bytes:
        if not self._fill(count):
            raise BadRecord("archive ends inside a frame")
        data, self.buffer = self.buffer[:count], self.buffer[count:]
        self.place += count
        return data

    def _skippable(self) -> bytes | None:
        """Content of a skippable frame, if one comes next."""
        if not self._fill(8):
            return None
        magic, size = struct.unpack("<II", self.buffer[:8])
        if magic & 0xFFFFFFF0 != 0x184D2A50:
            return None
        self._take(8)
        data = self._take(size)
        return data if magic == SKIPPABLE else b""

    def frames(self) -> Iterator[tuple[int, bytes]]:
        dictionary = None
        leading = self._skippable()
        if leading:
            if leading[:4] == FRAME:
                leading = zstandard.ZstdDecompressor().decompress(leading, max_output_size=MAX_BLOCK)
            dictionary = zstandard.ZstdCompressionDict(leading)
        decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
        while self._fill(1):
            start = self.place
            if self._skippable() is not None:
                continue
            frame, parts, size = decompressor.decompressobj(), [], 0
            while not frame.eof:
                if not self._fill(1):
                    raise BadRecord("archive ends inside a frame")
                data, self.buffer = self.buffer, b""
                try:
                    parts.append(frame.decompress(data))
                except zstandard.ZstdError as error:
                    raise BadRecord(f"frame at {start} can't be decoded: {error}") from error
                size += len(parts[-1])
                if size > MAX_BLOCK:
                    raise BadRecord(f"record at {start} is too long")
                self.buffer = frame.unused_data if frame.eof else b""
                self.place += len(data) - len(self.buffer)
            yield start, b"".join(parts)

    @staticmethod
    def record(data: bytes) -> tuple[dict[str, str], bytes]:
        """Headers (names in lower case) and block of one decoded frame, checked."""
        head, mark, rest = data.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        if not mark or lines[0] not in (b"WARC/1.0", VERSION):
            raise BadRecord("no WARC version line or end of headers")
        headers: dict[str, str] = {}
        for line in lines[1:]:
            name, colon, value = line.decode("utf-8", "replace").partition(":")
            if not colon or not name or name != name.strip():
                raise BadRecord("a header line is malformed")
            headers[name.lower()] = value.strip()
        for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
            if name not in headers:
                raise BadRecord(f"no {name} header")
        if not headers["content-length"].isdigit():
            raise BadRecord("Content-Length is no number")
        length = int(headers["content-length"])
        if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
            raise BadRecord("Content-Length differs from the block's length")
        block = rest[:length]
        stated = headers.get("warc-block-digest", "")
        if stated.startswith("sha1:") and stated[5:] != digest_of(block):
            raise BadRecord("block digest differs")
        return headers, block

    def records(self) -> Iterator[tuple[int, dict[str, str] | None, bytes, str | None]]:
        """(place, headers, block, error) of each record; headers are missing where there is an error."""
        try:
            for place, data in self.frames():
                try:
                    headers, block = self.record(data)
                except BadRecord as error:
                    yield place, None, b"", str(error)
                else:
                    yield place, headers, block, None
        except BadRecord as error:
            yield self.place, None, b"", str(error)


def http_parts(headers: dict[str, str], block: bytes) -> tuple[int, bytes | None]:
    """Length of the full payload by the HTTP headers, and the payload itself unless the record is a revisit."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark:
        raise BadRecord("no end of the HTTP headers")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode("latin-1").partition(":") for x in head.split(b"\r\n")[1:])}
    if not fields.get("content-length", "").isdigit():
        raise BadRecord("no HTTP Content-Length")
    length = int(fields["content-length"])
    if headers["warc-type"] == "revisit":
        return length, None
    if length != len(payload):
        raise BadRecord("HTTP Content-Length differs from the payload's length")
    stated = headers.get("warc-payload-digest", "")
    if stated.startswith("sha1:") and stated[5:] != digest_of(payload):
        raise BadRecord("payload digest differs")
    return length, payload


def write_archives(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write every row as a record; returns the table of archives (``file``, ``records``, ``bytes``)."""
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    # Of equal payloads, the row with the largest key; payloads that occur once need no row here.
    shared = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha")
        .agg(F.max(F.struct(F.col("key").isNotNull().alias("has"), "key")).alias("best"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha", F.col("best.key").alias("response"), F.lit(True).alias("shared"))
    )
    joined = rows.join(broadcast_if_small(shared, "shared-payloads"), "sha", "left").select(
        "key", "url", "payload", "response", F.coalesce(F.col("shared") & ~F.col("key").eqNullSafe(F.col("response")), F.lit(False)).alias("revisit")
    )

    def written(batches):
        writer, waiting, size = None, [], 0
        part = TaskContext.get().partitionId()

        def begin():
            return ArchiveWriter(Upload(folder, f"part-{part:06d}.warc.zst"), [w[2] for w in waiting])

        def put(row):
            own, link, data, response, revisit = row
            writer.page(own, link, data, digest_of(data), response, revisit)

        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                row = (row[0], row[1], row[2].encode(), row[3], row[4])
                if writer is not None:
                    put(row)
                    continue
                waiting.append(row)
                size += len(row[2])
                if size >= SAMPLE_BYTES or len(waiting) >= SAMPLE_COUNT:
                    writer = begin()
                    for held in waiting:
                        put(held)
                    waiting = []
        if waiting:
            writer = begin()
            for held in waiting:
                put(held)
        if writer is not None:
            uri = writer.upload.commit()
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([writer.count], pa.int64()), pa.array([writer.upload.size], pa.int64())], ["file", "records", "bytes"])

    return shared_table(map_batches(joined, written, "file string, records bigint, bytes bigint"), "archives")


RECORD_SCHEMA = "file string, place bigint, record_id string, record_type string, target_uri string, payload_bytes bigint, payload_digest string, refers_to string, payload binary, error string"


def read_archives(spark: SparkSession, files: DataFrame, with_payload: bool = True, strict: bool = False) -> DataFrame:
    """One row for each record of the archives in ``files.file``; ``strict`` raises the first error instead of reporting it."""

    def read(batches):
        names = [f.partition(" ")[0] for f in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = open_store(uri)
                with store.open_input_stream(path, compression=None) as stream:
                    held, size = [], 0
                    for place, headers, block, error in ArchiveReader(stream).records():
                        row = {"file": uri, "place": place, "error": error}
                        if headers is not None:
                            row |= {"record_id": headers["warc-record-id"], "record_type": headers["warc-type"], "target_uri": headers.get("warc-target-uri"), "refers_to": headers.get("warc-refers-to"), "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:")}
                            try:
                                length, payload = http_parts(headers, block)
                                row |= {"payload_bytes": length, "payload": payload if with_payload else None}
                            except BadRecord as problem:
                                row["error"] = str(problem)
                        if row["error"] and strict:
                            raise BadRecord(f"{uri} at {place}: {row['error']}")
                        held.append(row)
                        size += len(block)
                        if len(held) >= 1000 or size > 1 << 22:
                            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in held], arrow)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in held], arrow)

    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(f.split(" ")[0], kinds[f.split(" ")[1]]) for f in RECORD_SCHEMA.split(", ")])
    count = max(1, files.count())
    numbered = files.select("file", F.regexp_extract("file", r"part-(\d+)", 1).alias("number"))
    spread = min(count, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = numbered.repartitionById(spread, F.pmod(F.coalesce(F.expr("try_cast(number as bigint)"), F.lit(0)), F.lit(spread)).cast("int")).select("file")
    return map_batches(placed, read, RECORD_SCHEMA)


def key_of(column: str):
    """The key in a record's name; null for the empty one."""
    inner = F.substring_index(F.substring_index(F.col(column), ID_PREFIX, -1), ID_SUFFIX, 1)
    return F.when(inner != "", inner.cast("bigint"))


def archive_folder(spark: SparkSession) -> str:
    return f"{run_dir(spark, 'warc')}-{uuid.uuid4().hex[:8]}"
