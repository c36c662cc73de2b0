"""Token ids in binary files of independent zstandard frames with a trailing seek table.

File format, all integers little-endian:

    frame 0 | frame 1 | ... | seek table | footer

- a frame is one complete zstandard frame; decompressed it holds the ids of whole documents, one after another, each id an
  unsigned integer of `width` bytes (2 or 4, by default what the vocabulary needs; a wider id is an error);
- the seek table is itself a zstandard frame of fixed records: for each frame its offset (u64), compressed size (u32),
  decompressed size (u64), crc32 of the compressed bytes (u32), first document's place in the file (u64), documents (u32);
  then for each document its id (i64; the smallest i64 stands for null) and number of ids (u64);
- the footer has the table's offset (u64), its compressed size (u32), frames (u32), documents (u64), all ids (u64), crc32
  of the table's compressed bytes (u32), width (u32) and the magic bytes.

A reader loads the footer and the table, then only the frames with the documents it wants, and checks each frame's crc32.
Files are written beside their final name and renamed, so a lost executor leaves no half file under a final name.
Document ids ascend within a file and from file to file. Files are cut by ranges of (doc_id, a hash of the text), so rows
that share one id, or have none, still spread over files; equal rows are interchangeable.

Defined results: a null or empty text has only its end id; null doc_ids come first; repeated rows are written each; an
empty table gives no files; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, texts_of
from .tokens import encoder

MAGIC = b"LXTOKEN1"
_FOOTER = struct.Struct("<QIIQQII8s")
_FRAME = np.dtype([("offset", "<u8"), ("size", "<u4"), ("raw", "<u8"), ("crc", "<u4"), ("first", "<u8"), ("docs", "<u4")])
_DOC = np.dtype([("doc_id", "<i8"), ("n", "<u8")])
NULL_ID = -(2**63)
#: A frame is closed at this many decompressed bytes; one document is never split.
FRAME_BYTES = 256 * 1024
MANIFEST = "file int, path string, n_docs long, n_ids long"


def open_store(path: str):
    """(file system, path) of a folder in any store pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class TokenFileWriter:
    def __init__(self, sink, width: int, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.sink, self.width, self.limit, self.zstd = sink, width, frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames, self.docs, self.held, self.held_docs, self.held_bytes, self.at, self.ids = [], [], [], 0, 0, 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.width < 4 and len(ids) and int(ids.max()) >= 1 << 8 * self.width:
            raise ValueError(f"id {int(ids.max())} does not fit in {self.width} bytes")
        raw = ids.astype(f"<u{self.width}").tobytes()
        self.docs.append((NULL_ID if doc_id is None else doc_id, len(ids)))
        self.held.append(raw)
        self.held_docs, self.held_bytes, self.ids = self.held_docs + 1, self.held_bytes + len(raw), self.ids + len(ids)
        if self.held_bytes >= self.limit:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.held_docs:
            data = self.zstd.compress(b"".join(self.held))
            self.frames.append((self.at, len(data), self.held_bytes, zlib.crc32(data), len(self.docs) - self.held_docs, self.held_docs))
            self.sink.write(data)
            self.at += len(data)
            self.held, self.held_docs, self.held_bytes = [], 0, 0

    def close(self) -> None:
        self._close_frame()
        table = self.zstd.compress(np.array(self.frames, _FRAME).tobytes() + np.array(self.docs, _DOC).tobytes())
        self.sink.write(table)
        self.sink.write(_FOOTER.pack(self.at, len(table), len(self.frames), len(self.docs), self.ids, zlib.crc32(table), self.width, MAGIC))


class TokenFileReader:
    """Random access by document place; `source` is a seekable binary file of `size` bytes."""

    def __init__(self, source, size: int):
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        source.seek(size - _FOOTER.size)
        offset, length, frames, docs, self.n_ids, crc, self.width, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        source.seek(offset)
        table = source.read(length)
        if zlib.crc32(table) != crc:
            raise ValueError("the seek table is damaged")
        raw = self.zstd.decompress(table)
        self.frames = np.frombuffer(raw, _FRAME, frames)
        self.docs = np.frombuffer(raw, _DOC, docs, frames * _FRAME.itemsize)

    def frame(self, k: int) -> Iterator[tuple[int | None, np.ndarray]]:
        f = self.frames[k]
        self.source.seek(int(f["offset"]))
        data = self.source.read(int(f["size"]))
        if zlib.crc32(data) != f["crc"]:
            raise ValueError(f"frame {k} is damaged")
        ids, at = np.frombuffer(self.zstd.decompress(data), f"<u{self.width}"), 0
        for d in self.docs[int(f["first"]) : int(f["first"] + f["docs"])]:
            n = int(d["n"])
            yield (None if d["doc_id"] == NULL_ID else int(d["doc_id"])), ids[at : at + n]
            at += n

    def document(self, place: int) -> np.ndarray:
        """The ids of one document; only its frame is read."""
        k = int(np.searchsorted(self.frames["first"], place, "right")) - 1
        for i, (_, ids) in enumerate(self.frame(k)):
            if i == place - self.frames[k]["first"]:
                return ids
        raise IndexError(place)

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for k in range(len(self.frames)):
            yield from self.frame(k)


def _write(folder: str, tokenizer: str, kind: str, end_id: int, width: int, frame_bytes: int):
    def run(batches):
        store, root = open_store(folder)
        enc, part = encoder(tokenizer, kind), TaskContext.get().partitionId()
        name, temp, writer, end = f"{root}/part-{part:06d}.tok", f"{root}/.{part:06d}-{uuid.uuid4().hex}", None, np.array([end_id], np.uint32)
        sink = None
        for b in batches:
            for doc, ids in zip(b.column("doc_id").to_pylist(), map(enc.encode, texts_of(b.column("text")))):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    sink = store.open_output_stream(temp)
                    writer = TokenFileWriter(sink, width, frame_bytes)
                writer.add(doc, np.concatenate((np.frombuffer(ids, "<u4"), end)))
        if writer is not None:
            writer.close()
            sink.close()
            store.move(temp, name)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{folder}/part-{part:06d}.tok"]), pa.array([len(writer.docs)], pa.int64()), pa.array([writer.ids], pa.int64())], names=["file", "path", "n_docs", "n_ids"])

    return run


def width_of(tokenizer: str, end_id: int = 0) -> int:
    """Bytes that hold every id of a vocabulary and the end id."""
    from tokenizers import Tokenizer

    return 2 if max([end_id, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values()]) < 2**16 else 4


def write_tokens(docs: DataFrame, tokenizer: str, kind: str = "byte", end_id: int = 0, width: int | None = None, frame_bytes: int = FRAME_BYTES, folder: str | None = None, files: int | None = None) -> DataFrame:
    """Write the files in ascending doc_id order; the manifest, one row a file, has path, n_docs and n_ids."""
    spark = docs.sparkSession
    width = width or width_of(tokenizer, end_id)
    folder = folder or new_path(spark, "tokens")
    n = files or max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    by_id = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    made = by_id.mapInArrow(_write(folder, tokenizer, kind, end_id, width, frame_bytes), MANIFEST)
    made.write.parquet(f"{folder}/manifest")
    return spark.read.schema(made.schema).parquet(f"{folder}/manifest")


def _read(b):
    for row in b.to_pylist():
        store, path = open_store(row["path"])
        with store.open_input_file(path) as f:
            reader, at = TokenFileReader(f, f.size()), row["start"]
            for k in range(len(reader.frames)):
                cols = [[], [], [], []]
                for doc, ids in reader.frame(k):
                    for c, v in zip(cols, (doc, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                        c.append(v)
                    at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _read_all(batches):
    for b in batches:
        yield from _read(b)


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files; start counts the ids of all before it.

    The driver gets one row a file of the manifest (never of documents) to add up the files' starts.
    """
    rows, start = [], 0
    for r in manifest.orderBy("file").toLocalIterator():
        rows.append((r["path"], start))
        start += r["n_ids"]
    files = spark.createDataFrame(rows, "path string, start long")
    return files.repartition(max(1, len(rows))).mapInArrow(_read_all, "doc_id long, start long, n_tokens long, ids_crc32 long")
