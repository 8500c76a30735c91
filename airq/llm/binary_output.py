"""Token ids in files of independent zstandard frames with a seek table.

A file is a series of zstandard frames, each holding whole documents as little-endian
unsigned 32-bit ids, then one skippable frame with the seek table of the public seekable
format: per frame its compressed size, its decompressed size and the low 32 bits of the
XXH64 of its content, then the number of frames, a flag byte and the closing magic number.
Any zstandard reader can read the whole file; ours reads the table and then only the frames
that hold the documents asked for, and checks each one.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airq.llm.tables import kept_table
from airq.llm.words import slices, tokenizer
from airq.session import scratch_path

# fixed values of the seekable format
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
INDEX = "file string, doc_id long, frame long, byte long, first long, n_tokens long"
FRAME_BYTES = 1 << 18


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    body = b"".join(struct.pack("<III", *f) for f in frames) + struct.pack("<IBI", len(frames), CHECKSUMS, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


class Reader:
    """Frames of one file, each read, checked and decompressed on request."""

    def __init__(self, source):
        import zstandard

        self.source, self.d = source, zstandard.ZstdDecompressor()
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums")
        self.entries = np.frombuffer(self._read(size - 9 - 12 * n, 12 * n), dtype="<u4").reshape(n, 3)
        self.at = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def frame(self, k: int) -> bytes:
        import xxhash

        packed, plain, check = (int(x) for x in self.entries[k])
        data = self.d.decompress(self._read(int(self.at[k]), packed), max_output_size=plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return data


def _write(fs, path: str, docs):
    """Writes (row, ids) pairs; yields (row, frame, byte, first, n) in order. The file appears under its name when whole."""
    import xxhash
    import zstandard

    c, frames, part, size, first = zstandard.ZstdCompressor(level=1), [], [], 0, 0
    aside = f"{path}.{uuid.uuid4().hex}"

    with fs.open_output_stream(aside) as out:

        def close():
            data = b"".join(part)
            packed = c.compress(data)
            out.write(packed)
            frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

        for row, ids in docs:
            yield row, len(frames), size, first, len(ids) // 4
            part.append(ids)
            size, first = size + len(ids), first + len(ids) // 4
            if size >= FRAME_BYTES:
                close()
                part, size = [], 0
        if part:
            close()
        out.write(seek_table(frames))
    fs.move(aside, path)


def write_ids(docs: DataFrame, folder: str, file: str, end: int) -> DataFrame:
    """Writes one file per range of ``doc_id`` below ``folder`` and returns the index of its documents.

    Rows are dealt out by ranges of ``doc_id`` and sorted, so the files in the order of their
    names hold all documents in ascending order. A task that runs again replaces its file.
    """
    last = np.array([end], dtype="<u4").tobytes()

    def put(batches):
        import pyarrow as pa
        from pyarrow import fs as pfs

        fs, root = pfs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():06d}.ids.zst"
        tok = tokenizer(file)

        def documents():
            for b in batches:
                keys = b.column("doc_id").to_pylist()
                for at, texts in slices(b):
                    for i, ids in enumerate(tok.encode(texts)):
                        yield keys[at + i], ids + last

        rows = []
        fs.create_dir(root, recursive=True)
        for r in _write(fs, f"{root}/{name}", documents()):
            rows.append((name, *r))
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], [x.split(" ")[0] for x in INDEX.split(", ")])
                rows = []
        if rows:
            c = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.string()), *(pa.array(x, pa.int64()) for x in c[1:])], [x.split(" ")[0] for x in INDEX.split(", ")])

    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    index = kept_table(ordered.mapInArrow(put, INDEX), "ids-index")
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    starts = files.select(F.col("file").alias("_file"), F.coalesce(F.sum("_n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return index.join(starts, F.col("file") == F.col("_file")).withColumn("start", F.col("first") + F.col("_before")).drop("_file", "_before", "first")


def read_ids(index: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """The documents listed in ``index`` (all or some of its rows) from the files: ``doc_id, start, n_tokens`` and ``ids`` or, with ``digest``, ``ids_crc32``.

    Tasks take runs of frames of a file and decompress only frames with listed documents.
    """

    def get(batches):
        import pyarrow as pa
        from pyarrow import fs as pfs

        fs, root = pfs.FileSystem.from_uri(folder)
        name, reader, number, data = None, None, -1, b""
        for b in batches:
            c = b.to_pydict()
            out, size, ids, at = [], 0, [], 0
            for i, (f, frame, byte, n) in enumerate(zip(c["file"], c["frame"], c["byte"], c["n_tokens"], strict=True)):
                if f != name:
                    name, reader, number = f, Reader(fs.open_input_file(f"{root}/{f}")), -1
                if frame != number:
                    number, data = frame, reader.frame(frame)
                ids.append(data[byte : byte + 4 * n])
                if digest:
                    out.append(zlib.crc32(ids.pop()))
                    continue
                size += 4 * n
                if size >= 1 << 24:
                    yield pa.RecordBatch.from_arrays([*(b.column(x).slice(at, i + 1 - at) for x in ("doc_id", "start", "n_tokens")), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
                    size, ids, at = 0, [], i + 1
            rest = pa.array(out, pa.int64()) if digest else pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(x).slice(at) for x in ("doc_id", "start", "n_tokens")), rest], ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    runs = index.withColumn("_run", F.floor(F.col("frame") / 64)).repartition("file", "_run").sortWithinPartitions("file", "frame", "byte")
    return runs.select("doc_id", "start", "n_tokens", "file", "frame", "byte").mapInArrow(get, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary"))


def encode_to_files(docs: DataFrame, file: str = "word_bpe_49k.json", end: int = 2, folder: str | None = None) -> DataFrame:
    """Writes all documents and reads them back: ``doc_id, start, n_tokens, ids_crc32``.

    NULL and empty texts hold the end id alone; rows that share a ``doc_id`` follow each
    other; rows without ``doc_id`` come first; an empty table gives no files and no rows.
    """
    folder = folder or scratch_path(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, folder, file, end), folder, digest=True)


def open_documents(spark: SparkSession, index: DataFrame, folder: str, doc_ids: DataFrame) -> DataFrame:
    """Ids of the documents named in ``doc_ids`` (column ``doc_id``); other frames are not read."""
    return read_ids(index.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi"), folder)
