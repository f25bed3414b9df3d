"""Token ids as length-delimited binary records, with a separate offset index.

A shard is a file of frames, one a document, in ascending doc_id order over all
shards. A frame is

    length of the payload (8 bytes) | masked crc32 of those bytes (4 bytes)
    payload                         | masked crc32 of the payload (4 bytes) | 0x0A

all little-endian. The payload holds the width of an id (1 byte: 2 or 4), whether
the document has an id (1 byte), its doc_id (8 bytes), and the token ids. A crc is
masked, rotated by 15 bits plus a constant, so that a crc of data that holds crcs
stays strong. The index has a row (shard, record, doc_id, offset, length, n_tokens,
shard_start) for each frame, so that records can be read in any order.

Frames are written by Spark's text writer, whose line end is the last byte of the
frame, and read by its binary-file source; both work on any file system of Spark.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridcast.llm.common import arrow_batches
from gridcast.llm.tokens import PieceEncoder

END_ID = 2
SHARD_BYTES = 32 << 20  # of text; ids take about half of it
BATCH_ROWS = 512
_STRETCH = 1 << 20
_LENGTH, _HEAD, _BODY, _CRC = "<Q", "<QI", "<BBq", "<I"
_HEAD_SIZE, _BODY_SIZE, _CRC_SIZE = (struct.calcsize(f) for f in (_HEAD, _BODY, _CRC))
_INDEX = ("path string, shard int, part int, record long, doc_id long, offset long, length long, n_tokens long, "
          "shard_start long, ids_crc32 long")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    """A frame but for its last byte, which the writer adds."""
    payload = struct.pack(_BODY, width, doc_id is not None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack(_LENGTH, len(payload))
    return length + struct.pack(_CRC, masked(length)) + payload + struct.pack(_CRC, masked(payload))


def unframe(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """doc_id, ids and the offset of the next frame; a damaged frame raises ValueError."""
    if at + _HEAD_SIZE > len(data):
        raise ValueError(f"frame at {at}: cut off")
    length, crc = struct.unpack_from(_HEAD, data, at)
    if masked(bytes(data[at:at + 8])) != crc:
        raise ValueError(f"frame at {at}: length does not match its checksum")
    body, end = at + _HEAD_SIZE, at + _HEAD_SIZE + length
    if end + _CRC_SIZE + 1 > len(data):
        raise ValueError(f"frame at {at}: cut off")
    payload = data[body:end]
    if masked(payload) != struct.unpack_from(_CRC, data, end)[0] or data[end + _CRC_SIZE] != 10:
        raise ValueError(f"frame at {at}: payload does not match its checksum")
    width, has_id, doc_id = struct.unpack_from(_BODY, payload)
    return doc_id if has_id else None, np.frombuffer(payload, f"<u{width}", offset=_BODY_SIZE), end + _CRC_SIZE + 1


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every whole text of `docs(doc_id, text)`, append `end_id`, and write the shards to
    `path`/shards and the index to `path`/index.

    A null or empty text is the end id alone. Null ids come first; rows of the
    same id follow one another by text, and such a key may spread over shards.
    Other columns are ignored. An empty table writes empty folders.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(total // SHARD_BYTES) + 1
    ordered = (
        rows.withColumn("_h", F.xxhash64("text")).repartitionByRange(shards, "doc_id", "_h")
        .sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    )

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer)
        for batch in batches:
            ids, counts = encoder.encode(batch.column(1))
            ends = np.cumsum(counts)
            made = [frame(doc_id, np.append(ids[b - n:b], np.uint32(end_id)), encoder.width)
                    for doc_id, n, b in zip(batch.column(0).to_pylist(), counts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    framed = ordered.mapInArrow(frames, "value binary").select(F.col("value").cast("string"))
    with arrow_batches(spark, BATCH_ROWS):
        framed.write.option("lineSep", "\n").text(f"{path}/shards")
    with arrow_batches(spark, 1):
        walk_shards(spark, path).write.parquet(f"{path}/index")


def frame_size(data: memoryview, at: int) -> int:
    """Bytes of the frame at `at` as far as its beginning tells; a length that is damaged counts as none, for unframe to see."""
    if at + _HEAD_SIZE > len(data):
        return _HEAD_SIZE
    length, crc = struct.unpack_from(_HEAD, data, at)
    return _HEAD_SIZE + (length + _CRC_SIZE + 1 if masked(bytes(data[at:at + 8])) == crc else 0)


def stretches(spark: SparkSession, path: str) -> DataFrame:
    """The shards' files in stretches of at most _STRETCH bytes, those of a file in order; `ends` marks its last."""
    last = f"greatest(length - 1, 0L) div {_STRETCH}"
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards")
        .select("path", "content", "length", F.explode(F.expr(f"sequence(0L, {last})")).alias("i"))
        .select("path", F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"),
                F.coalesce(F.expr(r"try_cast(regexp_extract(path, '-c(\\d+)[.]', 1) as int)"), F.lit(0)).alias("part"),
                F.expr(f"i = {last}").alias("ends"), F.expr(f"substring(content, cast(i * {_STRETCH} + 1 as int), {_STRETCH})").alias("content"))
    )


def walk_shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per frame of all shards, from the files alone; every checksum is verified.

    Files come to Python in stretches, one at a time for an action inside `arrow_batches(spark, 1)`;
    a frame that goes on in the next stretch waits for it.
    """
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _INDEX.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int32()] + [pa.int64()] * 7
        parts, size, need, record, offset, start = [], 0, 0, 0, 0, 0
        for batch in batches:
            for path, shard, part, ends, content in zip(*(batch.column(i) for i in range(5))):
                path, shard, part, ends = path.as_py(), shard.as_py(), part.as_py(), ends.as_py()
                parts.append(content.as_buffer().to_pybytes())
                size += len(parts[-1])
                if size < need and not ends:
                    continue
                data, at, out = memoryview(b"".join(parts)), 0, []
                while at < len(data):
                    need = frame_size(data, at)
                    if at + need > len(data) and not ends:
                        break
                    doc_id, ids, after = unframe(data, at)
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    out.append((path, shard, part, record, doc_id, offset + at, after - at, len(ids), start, crc))
                    at, record, start = after, record + 1, start + len(ids)
                parts, size, offset = [bytes(data[at:])], len(data) - at, offset + at
                if ends:
                    parts, size, need, record, offset, start = [], 0, 0, 0, 0, 0
                columns = list(zip(*out)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return stretches(spark, path).mapInArrow(walk, _INDEX)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index with `start`, the ids of all documents before the record, over all shards.

    The running sum has one row per file of a shard, the records take it by a join.
    """
    index = spark.read.parquet(f"{path}/index")
    files = index.groupBy("shard", "part").agg(F.sum("n_tokens").alias("ids"))
    order = Window.orderBy("shard", "part")
    before = files.select("shard", "part", (F.sum("ids").over(order) - F.col("ids")).alias("before"))
    return index.join(before, ["shard", "part"]).withColumn("start", F.col("before") + F.col("shard_start"))


def read_records(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """(doc_id, record, shard, ids) of the records that `wanted(shard, part, offset)` names, or of all.

    Each file is read once; its wanted offsets are listed in one row beside it.
    """
    index = spark.read.parquet(f"{path}/index") if wanted is None else wanted
    offsets = index.groupBy("shard", "part").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards")
        .select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"),
                F.coalesce(F.expr(r"try_cast(regexp_extract(path, '-c(\\d+)[.]', 1) as int)"), F.lit(0)).alias("part"), "content")
    )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content, at in zip(batch.column("shard"), batch.column("content"), batch.column("offsets")):
                data = memoryview(content.as_buffer())
                found = [unframe(data, offset)[:2] for offset in at.as_py()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([doc_id for doc_id, _ in found], pa.int64()), pa.array([shard.as_py()] * len(found), pa.int32()),
                    pa.array([ids.astype(np.int32) for _, ids in found], pa.list_(pa.int32())),
                ], ["doc_id", "shard", "ids"])

    return files.join(offsets, ["shard", "part"]).mapInArrow(pick, "doc_id long, shard int, ids array<int>")
