"""Token ids as length-delimited binary records with an offset index (operator 8).

A file holds records in ascending doc_id order, each framed as

    length of the payload, 8 bytes | masked checksum of these 8 bytes, 4 bytes
    payload | masked checksum of the payload, 4 bytes | one newline byte

all little-endian. The payload is the doc_id (8 bytes), 1 if the doc_id is not NULL else 0 (1 byte), the
width of an id in bytes (1 byte: 2 or 4), and the ids. A checksum is the CRC-32 of the bytes, rotated
right by 15 bits plus a constant, so that the checksum of data that holds checksums is no checksum of
theirs. The newline comes from Spark's text writer, which writes the files: attempts that fail leave
nothing behind, and any store that Spark can write to will do.

The index, written beside the records as Parquet, has file, offset, length, doc_id, n_tokens and the
number of ids before in the same file; it is made by reading every file once and checking every frame. A
reader that shuffles takes rows of the index in any order and reads ``length`` bytes at ``offset``.

Defined results: NULL and empty texts have the end id alone; a NULL doc_id sorts first; rows that share a
doc_id, however many, stand next to each other, in as many files as they need, ordered by a hash of their
texts and by the texts; an empty table writes no record; very long texts are one record each; other columns
are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lookup, small, text_batches
from .shingles import text_slices
from .wordcache import worker_cache

END_ID = 2
#: Text bytes per file, about.
FILE_BYTES = 32_000_000
_HEAD, _TAIL, _META = "<QI", "<I", "<qBB"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    narrow = len(ids) == 0 or int(ids.max()) < 1 << 16
    body = ids.astype("<u2" if narrow else "<u4").tobytes()
    payload = struct.pack(_META, doc_id or 0, doc_id is not None, 2 if narrow else 4) + body
    length = struct.pack("<Q", len(payload))
    return length + struct.pack(_TAIL, masked(length)) + payload + struct.pack(_TAIL, masked(payload))


def unframe(data: bytes | memoryview, offset: int = 0) -> tuple[int, int | None, np.ndarray]:
    """(bytes of the frame, doc_id, ids) at the offset; raises ValueError if a checksum fails."""
    length, check = struct.unpack_from(_HEAD, data, offset)
    if masked(bytes(data[offset : offset + 8])) != check:
        raise ValueError(f"length at byte {offset} is damaged")
    start = offset + struct.calcsize(_HEAD)
    payload = bytes(data[start : start + length])
    (check,) = struct.unpack_from(_TAIL, data, start + length)
    if masked(payload) != check:
        raise ValueError(f"record at byte {offset} is damaged")
    doc_id, known, width = struct.unpack_from(_META, payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_META)).astype("<u4")
    return struct.calcsize(_HEAD) + length + struct.calcsize(_TAIL), doc_id if known else None, ids


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Encode every text, append the end id and write the records, one file per range of doc_id."""
    text_batches(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long"), "text")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(tokenizer_path)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for first, last, _, _ in text_slices(texts):
                ids, bounds = cache.encode([t or "" for t in texts[first:last].to_pylist()])
                frames = [
                    frame(d, np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id)))
                    for i, d in enumerate(doc_ids[first:last])
                ]
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])

    # A doc_id of very many rows is a range of hashes, not one task and one file.
    order = ["doc_id", F.xxhash64(F.coalesce("text", F.lit("")))]
    ordered = own.repartitionByRange(total // file_bytes + 1, *order).sortWithinPartitions(*order, "text")
    frames = ordered.mapInArrow(encode, "value binary")
    frames.select(F.col("value").cast("string")).write.option("compression", "none").text(path)


def _scan(files: DataFrame) -> DataFrame:
    """A row per record: place in the file, doc_id, number and checksum of the ids."""
    schema = (
        "file string, part int, offset bigint, length bigint, doc_id bigint, before bigint,"
        " n_tokens bigint, ids_crc32 bigint"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                part = int(name.rsplit("/", 1)[-1].split("-")[1])
                data = memoryview(batch.column(1)[i].as_buffer())
                at, before, rows = 0, 0, []
                while at < len(data):
                    length, doc_id, ids = unframe(data, at)
                    rows.append((name, part, at, length, doc_id, before, len(ids), zlib.crc32(ids.tobytes())))
                    before += len(ids)
                    at += length + 1
                if rows:
                    columns = list(zip(*rows))
                    types = [pa.string(), pa.int32()] + [pa.int64()] * 6
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types)],
                        [f.split(" ")[0] for f in schema.split(", ")],
                    )

    return files.select("path", "content").mapInArrow(scan, schema)


def write_index(spark: SparkSession, path: str, index_path: str) -> None:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    _scan(files).write.parquet(index_path)


def token_starts(index: DataFrame) -> DataFrame:
    """Add ``start``, the number of ids in all records before. Files follow each other by number."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    # One row per file.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    return lookup(index, small(firsts), ["part"]).withColumn("start", F.col("_first") + F.col("before")).drop("_first")


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, seed: int) -> DataFrame:
    """(doc_id, ids) in an order drawn by the seed: files are taken as wholes, records by the index."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    places = index.groupBy(F.col("file").alias("path")).agg(F.collect_list("offset").alias("at"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = memoryview(batch.column(0)[i].as_buffer())
                got = [unframe(data, at)[1:] for at in batch.column(1)[i].as_py()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in got], pa.int64()), pa.array([x for _, x in got], pa.list_(pa.int64()))],
                    ["doc_id", "ids"],
                )

    rows = files.join(places, "path").select("content", "at").mapInArrow(take, "doc_id bigint, ids array<bigint>")
    drawn = F.xxhash64(F.lit(seed), "doc_id")
    return rows.repartitionByRange(drawn).sortWithinPartitions(drawn)
