"""WARC archives with a Zstandard dictionary of their own, record by record.

An archive begins with a skippable frame that holds the dictionary, built from the records that
follow; then comes a frame per record, so any record can be read alone. Equal payloads are
stored once: later records revisit the first.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelloom.llm.common import Workspace, column_values, portions

# fixed values: the skippable frame that marks an embedded dictionary, and the revisit profile
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
MANIFEST = "path string, records bigint, bytes bigint"


def record_id(key) -> str:
    return f"<urn:record:{'' if key is None else key}>"


def make_record(key, url: str | None, payload: bytes, length: int, digest: str, first, date: str) -> bytes:
    """One record's bytes; a revisit (``first`` not None) has the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    target = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:unknown"
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(key)),
        ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if first is not None:
        fields += [("WARC-Refers-To", record_id(first)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-case names), HTTP head and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a record: {version[:40]!r}")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
    return fields, http, payload


def build_dictionary(records: list[bytes], size: int, sample: int):
    """A dictionary of the records, from pieces spread evenly over all of them.

    Archives too small to train one get those pieces as they are.
    """
    import zstandard

    total = sum(map(len, records))
    piece = max(256, min(8192, sample // max(1, len(records))))
    every = max(1, -(-len(records) * min(piece, -(-total // max(1, len(records)))) // sample))
    pieces = [r[:piece] for r in records[::every]]
    size = min(size, max(1024, total // 10))
    try:
        return zstandard.train_dictionary(size, pieces, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(pieces)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_bytes(records: list[bytes], dictionary_size: int, sample: int, level: int) -> Iterator[bytes]:
    """The frames of an archive: the embedded dictionary, then a frame per record."""
    import zstandard

    made = build_dictionary(records, dictionary_size, sample)
    raw = zstandard.ZstdCompressor(level=level).compress(made.as_bytes())
    yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    compressor = zstandard.ZstdCompressor(level=level, dict_data=made)
    for record in records:
        yield compressor.compress(record)


def read_archive(file) -> Iterator[bytes]:
    """The records of an open archive, one at a time."""
    import zstandard

    magic, length = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    data = zstandard.ZstdDecompressor().decompress(file.read(length))
    trained = data[:4] == b"\x37\xa4\x30\xec"
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind))
    waiting = b""
    while True:
        stream = decompressor.decompressobj()
        parts = []
        while not stream.eof:
            data = waiting or file.read(1 << 20)
            if not data:
                if parts:
                    raise ValueError("the archive ends within a record")
                return
            waiting = b""
            parts.append(stream.decompress(data))
        waiting = stream.unused_data
        yield b"".join(parts)


def first_copies(df: DataFrame, key: str, digest: str, length: str, least: int) -> DataFrame:
    """(digest, first key) of payloads of ``least`` bytes or more that several rows have."""
    return df.where(F.col(length) >= least).groupBy(digest).agg(
        F.min(key).alias("first"), F.count("*").alias("n")
    ).where("n > 1 and first is not null").select(digest, "first")


def write_archives(
    df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 100,
    archive_size: int = 32 << 20, dictionary_size: int = 112_640, sample: int = 2 << 20, level: int = 3,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row of ``df`` to archives in ``folder``; returns their manifest, lazily.

    The payload is text, stored as UTF-8 (null: empty). Of records with equal payloads of at least
    ``least`` bytes the one with the smallest key is a response and the others revisit it; smaller
    ones are all responses. Rows that repeat the smallest key with the same payload are responses,
    too; rows with a null key never are the first and revisit if there is one.

    A task holds the records of one archive (``archive_size`` bytes and one record) and writes
    a file with a name of its own, so a task that runs again leaves its first file out of the
    manifest. The manifest must be written or kept before it is used: reading it writes files.
    The folder is reached with Arrow's file systems (local and mounted paths, HDFS, S3, GCS).
    """
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("url"), data.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("length", F.octet_length("payload").cast("bigint"))
    firsts = first_copies(rows, "key", "digest", "length", least)
    numeric = df.schema[key].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    joined = rows.join(firsts, "digest", "left").select(
        "key", "url", "length", "digest",
        F.when(F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first")), F.col("first")).alias("first"), "payload",
    )
    if not numeric:
        joined = joined.withColumn("key", F.col("key").cast("string")).withColumn("first", F.col("first").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        place, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        place.create_dir(base, recursive=True)

        def close(records: list[bytes]) -> pa.RecordBatch:
            path, size = f"{base}/{uuid.uuid4().hex}.warc.zst", 0
            with place.open_output_stream(path) as out:
                for part in archive_bytes(records, dictionary_size, sample, level):
                    out.write(part)
                    size += len(part)
            return pa.RecordBatch.from_pydict({
                "path": [path.rsplit("/", 1)[1]], "records": pa.array([len(records)], pa.int64()), "bytes": pa.array([size], pa.int64()),
            })

        records, size = [], 0
        for batch in portions(batches, 200):
            columns = [column_values(batch, c) for c in ("key", "url", "payload", "length", "digest", "first")]
            for k, u, p, n, d, first in zip(*columns):
                records.append(make_record(k, u, p, n, d, first, date))
                size += len(records[-1])
                if size >= archive_size:
                    yield close(records)
                    records, size = [], 0
        if records:
            yield close(records)

    return joined.mapInArrow(run, MANIFEST)


RECORD = "key string, type string, url string, refers_to string, digest string, length bigint, payload binary"


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives a manifest lists, one row each; ``payload`` is null for revisits.

    A response's digest and length are computed anew from its payload and must be the stated ones;
    a revisit's are those of the payload it refers to, as stated in its head.
    """
    tasks = max(1, min(manifest.count(), 4 * spark.sparkContext.defaultParallelism, 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        place, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        names = ["key", "type", "url", "refers_to", "digest", "length", "payload"]
        for batch in batches:
            for path in column_values(batch, "path"):
                rows, size = [], 0
                with place.open_input_stream(f"{base}/{path}") as file:
                    for record in read_archive(file):
                        fields, http, payload = parse_record(record)
                        stated = fields["warc-payload-digest"].removeprefix("sha256:")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        whole = fields["warc-type"] == "response"
                        if whole and (hashlib.sha256(payload).hexdigest() != stated or len(payload) != length):
                            raise ValueError(f"{path}: {fields['warc-record-id']} is damaged")
                        name = lambda v: v and (v[len("<urn:record:"):-1] or None)
                        rows.append((
                            name(fields["warc-record-id"]), fields["warc-type"], fields["warc-target-uri"],
                            name(fields.get("warc-refers-to")), stated, length, payload if whole else None,
                        ))
                        size += len(record)
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return manifest.select("path").repartition(tasks).mapInArrow(run, RECORD)


def round_trip(spark: SparkSession, df: DataFrame, work: Workspace, **options) -> DataFrame:
    """Write the rows of ``df`` to archives in the workspace and read them back."""
    folder = work.path("archives")
    manifest = work.keep(write_archives(df, folder, **options), "manifest")
    return read_archives(spark, manifest, folder)
