"""Length-delimited binary records of token ids with an offset index.

A shard ``tokens-NNNNN.rec`` starts with an eight-byte mark; every record is

    length of the payload   unsigned 64-bit
    masked CRC-32 of the length's eight bytes
    payload: id present (1 byte), width of a token id (1), document id (signed 64-bit), token ids
    masked CRC-32 of the payload

all little-endian. The mask turns a checksum by 15 bits and adds a constant, so that a
checksum over data that itself holds checksums stays sound. ``tokens-NNNNN.idx`` holds
for each record its offset and length (two unsigned 64-bit integers), and ends with the
masked CRC-32 of all that, so records can be read in any order.

Shards follow the order of the ids: a range shuffle and a sort within partitions. Each
task writes its shard under a name of its attempt and renames it when whole, so a lost
executor leaves no half file behind. Defined results: NULL text is an empty sequence
with its end id; NULL ids come first; ties are ordered by the text's hash; an empty table
gives no shards and no rows.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, table, text_rows, written
from .tokens import BYTE_BPE, encoder

# Fixed values of the format.
MARK = b"WGTOKEN1"
MASK_ADD = 0xA282EAD8
HEAD = struct.Struct("<BBq")
READ_BYTES = 8 << 20


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_ADD) & 0xFFFFFFFF


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder in the shared store."""
    if "://" not in uri:
        uri = uri.replace("file:", "", 1)
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def pack(doc_id: int | None, ids: bytes, width: int = 2) -> bytes:
    """One framed record; ``ids`` are unsigned 32-bit, stored in ``width`` bytes each if they fit."""
    a = np.frombuffer(ids, "<u4")
    width = width if width == 4 or not len(a) or int(a.max()) < 65536 else 4
    body = HEAD.pack(doc_id is not None, width, doc_id or 0) + a.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(body))
    return size + struct.pack("<I", masked(size)) + body + struct.pack("<I", masked(body))


def unpack(body: bytes) -> tuple[int | None, np.ndarray]:
    known, width, doc_id = HEAD.unpack_from(body)
    return (doc_id if known else None), np.frombuffer(body, f"<u{width}", offset=HEAD.size).astype("<u4")


def _checked(body: bytes, crc: bytes, where: str) -> bytes:
    if struct.pack("<I", masked(body)) != crc:
        raise ValueError(f"damaged record at {where}")
    return body


def records(stream, path: str) -> Iterator[tuple[int, bytes]]:
    """Offset and payload of every record of an open shard, checksums verified."""
    if stream.read(len(MARK)) != MARK:
        raise ValueError(f"{path} is no shard of token records")
    at = len(MARK)
    while True:
        head = stream.read(12)
        if not head:
            return
        if len(head) < 12:
            raise ValueError(f"{path} ends within a record at {at}")
        size = struct.unpack("<Q", _checked(head[:8], head[8:], f"{path}:{at}"))[0]
        body = stream.read(size + 4)
        if len(body) < size + 4:
            raise ValueError(f"{path} ends within a record at {at}")
        yield at, _checked(body[:size], body[size:], f"{path}:{at}")
        at += 16 + size


def _write(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        shard, end = ctx.partitionId(), struct.pack("<I", end_id)
        fs, top = place(folder)
        fs.create_dir(top, recursive=True)
        rec, own = f"{top}/tokens-{shard:05d}.rec", f"{top}/.{shard:05d}-{ctx.taskAttemptId()}"
        n = tokens = 0
        out = idx = enc = None
        check = b""
        for b in batches:
            for doc_id, text in zip(b.column("_id").to_pylist(), b.column("_text")):
                if out is None:
                    out, idx = fs.open_output_stream(f"{own}.rec"), fs.open_output_stream(f"{own}.idx")
                    out.write(MARK)
                    at, enc, crc = len(MARK), encoder(tokenizer), 0
                ids = enc.ids(text.as_py()) + end
                frame = pack(doc_id, ids)
                entry = struct.pack("<QQ", at, len(frame))
                out.write(frame)
                idx.write(entry)
                crc = zlib.crc32(entry, crc)
                at, n, tokens = at + len(frame), n + 1, tokens + len(ids) // 4
        if out is not None:
            idx.write(struct.pack("<I", (((crc >> 15) | (crc << 17)) + MASK_ADD) & 0xFFFFFFFF))
            out.close()
            idx.close()
            fs.move(f"{own}.idx", rec[:-4] + ".idx")
            fs.move(f"{own}.rec", rec)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n], pa.int64()), pa.array([tokens], pa.int64())],
                                             names=["shard", "records", "tokens"])
    return run


def write_records(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: str = BYTE_BPE, end_id: int = 0) -> DataFrame:
    """Encode every whole text, append ``end_id``, write shards in ascending id order.

    Returns the written manifest: ``shard``, ``records``, ``tokens``.
    """
    rows = text_rows(docs, id_col, text_col)
    rows = rows.repartitionByRange("_id", "_x", "_n").sortWithinPartitions("_id", "_x", "_n").select(F.col("_id").cast("long").alias("_id"), "_text")
    return written(rows.mapInArrow(_write(folder, tokenizer, end_id), "shard int, records long, tokens long"), "manifest")


def _read(folder: str, digests: bool):
    """Arrow function over manifest rows: a row for each record, from the files alone."""
    schema = pa.schema([("shard", pa.int32()), ("record", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
                        *([("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] if digests else [("ids", pa.binary())])])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = place(folder)
        for b in batches:
            for shard in b.column("shard").to_pylist():
                path = f"{top}/tokens-{shard:05d}.rec"
                rows, size, start = [], 0, 0
                with fs.open_input_stream(path, buffer_size=1 << 20) as stream:
                    for k, (_, body) in enumerate(records(stream, path)):
                        doc_id, ids = unpack(body)
                        data = ids.tobytes()
                        rows.append((shard, k, doc_id, start, *((len(ids), zlib.crc32(data)) if digests else (data,))))
                        start, size = start + len(ids), size + (64 if digests else len(data))
                        if size >= READ_BYTES:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)
    return run


def _shards(manifest: DataFrame) -> DataFrame:
    """Shard numbers, a partition for each shard."""
    return manifest.select("shard").repartitionByRange(max(1, manifest.count()), "shard")


def read_records(manifest: DataFrame, folder: str, digests: bool = False) -> DataFrame:
    """Every record in order: shard, number, document id, token ids before it in the shard, and
    ids (unsigned 32-bit) or their count and checksum. One task a shard; a damaged record raises."""
    last = "n_tokens long, ids_crc32 long" if digests else "ids binary"
    return _shards(manifest).mapInArrow(_read(folder, digests), f"shard int, record long, doc_id long, start long, {last}")


def _index(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = place(folder)
        for b in batches:
            for shard in b.column("shard").to_pylist():
                path = f"{top}/tokens-{shard:05d}.idx"
                with fs.open_input_stream(path) as stream:
                    data = stream.read()
                a = np.frombuffer(_checked(data[:-4], data[-4:], path), "<u8").astype(np.int64).reshape(-1, 2)
                for lo in range(0, len(a), 100_000):
                    part = a[lo:lo + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), shard, np.int32)), pa.array(np.arange(lo, lo + len(part), dtype=np.int64)),
                         pa.array(part[:, 0]), pa.array(part[:, 1])], names=["shard", "record", "offset", "length"])
    return run


def read_index(manifest: DataFrame, folder: str) -> DataFrame:
    """The offset index: shard, record, offset, length."""
    return _shards(manifest).mapInArrow(_index(folder), "shard int, record long, offset long, length long")


def _seek(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = place(folder)
        files: dict[int, object] = {}
        for b in batches:
            ids, known = [], []
            for shard, at, size in zip(*(b.column(c).to_pylist() for c in ("shard", "offset", "length"))):
                if shard not in files:
                    if len(files) >= 64:
                        files.pop(next(iter(files))).close()
                    files[shard] = fs.open_input_file(f"{top}/tokens-{shard:05d}.rec")
                frame = files[shard].read_at(size, at)
                body = _checked(frame[12:-4], frame[-4:], f"{shard}:{at}")
                doc_id, a = unpack(body)
                known.append(doc_id)
                ids.append(a.tobytes())
            yield pa.RecordBatch.from_arrays([b.column("shard"), b.column("record"), pa.array(known, pa.int64()), pa.array(ids, pa.binary())],
                                             names=["shard", "record", "doc_id", "ids"])
        for f in files.values():
            f.close()
    return run


def read_shuffled(manifest: DataFrame, folder: str, seed: int) -> DataFrame:
    """All records in an order drawn from ``seed``, each found by the index."""
    order = read_index(manifest, folder).withColumn("place", F.xxhash64("shard", "record", F.lit(seed)))
    return (order.repartitionByRange("place").sortWithinPartitions("place", "shard", "record")
            .select("shard", "record", "offset", "length").mapInArrow(_seek(folder), "shard int, record long, doc_id long, ids binary"))


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` as token records, written and read back: place, count and checksum of each."""
    folder = scratch(spark, "token-records")
    manifest = write_records(table(spark, sf_dir, "documents"), folder)
    rows = read_records(manifest, folder, digests=True)
    # one row a shard, so small enough for every task: the tokens of the shards before it
    before = manifest.select(F.col("shard").alias("_s"), F.coalesce(F.sum("tokens").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(before), rows["shard"] == before["_s"])
            .select("doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32"))
