"""Token ids as length-delimited binary records with masked checksums, and an offset index beside each file.

A file is a run of records: length (8 bytes), masked checksum of the length (4), payload, masked
checksum of the payload (4). The payload is id, flag (1: the id is null), bytes per token id, token
ids before the record in its file, number of token ids, then the ids; all little-endian. The index
holds the offset of every record and the end of the file, 8 bytes each, so records can be read in any
order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.frames import scratch, stored, texts
from tidewatch.llm.wordbpe import END, encoder

HEAD, LENGTH, CHECK = struct.Struct("<qBBQQ"), struct.Struct("<Q"), struct.Struct("<I")
#: Fixed: what masking adds to a checksum turned by 15 bits, so that data holding checksums does not fool it.
MASK = 0xA282EAD8
#: Bytes gathered before they are written, records that one reader takes at a time, and how often it does.
BUFFER, SLICE, SLICES = 1 << 22, 2_000, 4


def masked(data: bytes) -> bytes:
    crc = zlib.crc32(data)
    return CHECK.pack(((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF)


def framed(payload: bytes) -> bytes:
    length = LENGTH.pack(len(payload))
    return b"".join((length, masked(length), payload, masked(payload)))


def unframed(data: bytes) -> Iterator[bytes]:
    """Payloads of whole records; a damaged one is an error."""
    at = 0
    while at < len(data):
        length = data[at:at + 8]
        size = LENGTH.unpack(length)[0]
        payload = data[at + 12:at + 12 + size]
        if data[at + 8:at + 12] != masked(length) or data[at + 12 + size:at + 16 + size] != masked(payload):
            raise ValueError(f"damaged record at byte {at}")
        yield payload
        at += 16 + size


def payload(name: int | None, before: int, ids: bytes, wide: bool) -> bytes:
    """One document's record; `ids` are 32-bit and kept in 16 if the vocabulary allows."""
    kept = ids if wide else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return HEAD.pack(name or 0, name is None, 4 if wide else 2, before, len(ids) // 4) + kept


def of_payload(data: bytes) -> tuple[int | None, int, bytes]:
    """id, token ids before it in its file, and its ids as 32-bit integers."""
    name, nameless, width, before, n = HEAD.unpack_from(data)
    ids = np.frombuffer(data, f"<u{width}", n, HEAD.size).astype("<u4").tobytes()
    return None if nameless else name, before, ids


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that every executor reaches."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def write_records(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Writes every row's ids, with an end id, to files in `folder`; returns their manifest.

    Rows are range-partitioned by (id, hash of the text), null ids last, and sorted, so file number
    and place in the file follow that order. Every attempt of a task writes files of its own names,
    and the manifest names those of the attempt that counted: a lost executor leaves files that no
    reader looks at. A null text is empty. Repeated rows have a record each. No rows give no files.

    Manifest: shard, path, records, tokens.
    """
    rows = texts(docs, id_col, text_col).select(F.col("id").cast("long").alias("id"), F.xxhash64("text").alias("mark"), "text")
    order = [F.col("id").asc_nulls_last(), F.col("mark")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        wide = encode.library.get_vocab_size() > 1 << 16
        end = np.array([END], "<u4").tobytes()
        system, root = place(folder)
        system.create_dir(root)
        shard = TaskContext.get().partitionId()
        path = f"{root}/part-{shard:06d}-{uuid.uuid4().hex}"
        offsets, at, before, waiting, written = [], 0, 0, [], 0
        with system.open_output_stream(path) as out:
            for batch in batches:
                for name, text in zip(batch.column("id"), batch.column("text"), strict=True):
                    ids = encode.text(text.as_py()) + end
                    record = framed(payload(name.as_py(), before, ids, wide))
                    offsets.append(at)
                    waiting.append(record)
                    at, before = at + len(record), before + len(ids) // 4
                    if at - written > BUFFER:
                        out.write(b"".join(waiting))
                        waiting, written = [], at
            out.write(b"".join(waiting))
        if not offsets:
            system.delete_file(path)
            return
        with system.open_output_stream(f"{path}.idx") as out:
            out.write(np.array([*offsets, at], "<u8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([path]), pa.array([len(offsets)]), pa.array([before])],
                                         ["shard", "path", "records", "tokens"])

    return stored(rows.mapInArrow(write, "shard long, path string, records long, tokens long"))


def read_records(manifest: DataFrame, folder: str, seed: int | None = None) -> DataFrame:
    """id, start (ids of all records before it), ids (binary, 32-bit) and place of every record.

    Files are read in slices found by their index. With a seed the slices are dealt out, and the
    records within each task mixed, in an order drawn from it.
    """
    ahead = F.coalesce(F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each file, so this order is over a short list.
    slices = manifest.select("shard", "path", "records", ahead.alias("ahead")).select(
        "*", F.explode(F.expr(f"sequence(0L, records - 1, {SLICE}L)")).alias("first"))
    # Rows of slices are small and what they stand for is not, so their number sets that of the tasks.
    count = manifest.agg(F.sum(F.ceil(F.col("records") / SLICE))).first()[0] or 0
    slices = slices.repartition(max(1, -(-count // SLICES)), F.xxhash64(F.lit(seed or 0), "path", "first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = place(folder)
        for batch in batches:
            rows = batch.to_pylist()
            if seed is not None:
                rows = [rows[k] for k in np.random.default_rng(seed).permutation(len(rows))]
            for row in rows:
                count = min(SLICE, row["records"] - row["first"])
                with system.open_input_file(row["path"] + ".idx") as index:
                    offsets = np.frombuffer(index.read_at(8 * (count + 1), 8 * row["first"]), "<u8").tolist()
                with system.open_input_file(row["path"]) as data:
                    whole = data.read_at(offsets[-1] - offsets[0], offsets[0])
                found = [of_payload(p) for p in unframed(whole)]
                places = range(row["first"], row["first"] + count)
                if seed is not None:
                    order = np.random.default_rng([seed, row["shard"], row["first"]]).permutation(count)
                    found, places = [found[k] for k in order], [places[k] for k in order]
                names, before, ids = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array([row["ahead"] + b for b in before], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([row["shard"]] * count, pa.int64()), pa.array(list(places), pa.int64())], ["id", "start", "ids", "shard", "place"])

    return slices.mapInArrow(read, "id long, start long, ids binary, shard long, place long")


def record_digest(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row, from files written and read back."""
    spark: SparkSession = docs.sparkSession
    folder = scratch(spark)
    found = read_records(write_records(docs, folder), folder)
    return found.select(F.col("id").alias("doc_id"), "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
