"""Token files of independent zstandard frames with a trailing seek table.

A file is the public seekable format: one frame for each document with its ids as unsigned
little-endian integers of 16 or 32 bits, then a skippable frame with the document ids, then the seek table (a
skippable frame too) with each frame's sizes and the low 32 bits of the XXH64 of its content.
A reader loads the tables at the end and decompresses only the frames that it is asked for.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm import tokens
from tidemark.llm.shared import cut, shared_dir, ship

#: Fixed values of the seekable zstandard format: skippable frame magics, seek table magic, checksum flag.
SKIPPABLE, IDS_FRAME, SEEK_MAGIC, CHECKSUMS = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80
#: A document without an id.
NO_ID = -(1 << 63)
LEVEL = 1


class FileWriter:
    """Writes one token file to an open stream, document by document."""

    def __init__(self, out, wide: bool) -> None:
        self.out, self.kind = out, "<u4" if wide else "<u2"
        self.zip, self.ids, self.entries, self.tokens = zstandard.ZstdCompressor(level=LEVEL), [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = ids.astype(self.kind).tobytes()
        frame = self.zip.compress(raw)
        self.out.write(frame)
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.tokens += len(ids)

    def finish(self) -> None:
        names = struct.pack("<Q", int(self.kind[2:])) + np.array(self.ids, "<i8").tobytes()
        self.out.write(struct.pack("<II", IDS_FRAME, len(names)) + names)
        table = np.array(self.entries, "<u4").reshape(-1, 3).tobytes()
        foot = struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(foot)) + table + foot)


class FileReader:
    """Reads documents of a token file by their place in it."""

    def __init__(self, source) -> None:
        self.source = source
        end = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        seek = end - 9 - 12 * n
        self.entries = np.frombuffer(self._at(seek, 12 * n), "<u4").reshape(-1, 3)
        names = self._at(seek - 8 - 8 * (n + 1), 8 * (n + 1))
        self.kind, self.doc_ids = f"<u{struct.unpack('<Q', names[:8])[0]}", np.frombuffer(names[8:], "<i8")
        self.starts = np.concatenate([[0], np.cumsum(self.entries[:, 0].astype(np.int64))])
        self.unzip = zstandard.ZstdDecompressor()

    def _at(self, place: int, n: int) -> bytes:
        self.source.seek(place)
        return self.source.read(n)

    def __len__(self) -> int:
        return len(self.entries)

    def find(self, doc_id: int | None) -> list[int]:
        """Places of the documents with the id, by bisection: a file is in ascending order of ids."""
        key = NO_ID if doc_id is None else doc_id
        return list(range(np.searchsorted(self.doc_ids, key), np.searchsorted(self.doc_ids, key, "right")))

    def read(self, place: int) -> np.ndarray:
        size, raw_size, check = (int(x) for x in self.entries[place])
        raw = self.unzip.decompress(self._at(int(self.starts[place]), size), max_output_size=raw_size) if raw_size else b""
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check or len(raw) != raw_size:
            raise ValueError(f"frame {place} doesn't match its checksum")
        return np.frombuffer(raw, self.kind)


def _open(path: str):
    return fs.FileSystem.from_uri(path)


def write(docs: DataFrame, folder: str, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None, parts: int | None = None) -> DataFrame:
    """Writes the token files below ``folder``, a URI all executors reach; returns their list.

    Rows ``(part, path, docs, tokens, first_id, start)``: files hold ascending ranges of document
    ids, ``start`` counts the ids in all files before. Rows are dealt by range of (id, hash of
    the text), sorted and encoded in one pass; a file is written under a name of the attempt and
    moved to its own name when whole, so a task that is run again replaces it. A null text has
    the end id alone; null document ids come first; repeated rows are documents of their own.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = vocabulary or tokens.vocabulary_path()
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = tokens.size(vocabulary) > 1 << 16
    listed = pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("first_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}.tokens"
        where, path = _open(name)
        writer = out = None
        for batch in batches:
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    where.create_dir(path.rpartition("/")[0], recursive=True)
                    draft = f"{path}.{task.taskAttemptId()}"
                    out = where.open_output_stream(draft)
                    writer = FileWriter(out, wide)
                for ids in tokens.encode([t.as_py()], vocabulary):
                    writer.add(key, np.frombuffer(ids, "<u4"))
        if writer is not None:
            writer.finish()
            out.close()
            where.move(draft, path)
            first = None if writer.ids[0] == NO_ID else writer.ids[0]
            row = {"part": task.partitionId(), "path": name, "docs": len(writer.ids), "tokens": writer.tokens, "first_id": first}
            yield pa.RecordBatch.from_pylist([row], schema=listed)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h").select(F.col("doc_id"), "text")
    files = cut(dealt.mapInArrow(run, "part int, path string, docs long, tokens long, first_id long"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every document of the listed files: ``(doc_id, start, n_tokens, ids_crc32)``, ``ids`` too if asked for.

    ``ids`` are bytes of unsigned 32-bit integers, and the checksum is over these. Files are
    dealt to tasks; a frame that doesn't match its checksum raises an error.
    """

    ship(files.sparkSession)
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where, name = _open(path)
                with where.open_input_file(name) as source:
                    file, out, at = FileReader(source), [], start
                    for i in range(len(file)):
                        ids = file.read(i).astype("<u4").tobytes()
                        key = int(file.doc_ids[i])
                        out.append((None if key == NO_ID else key, at, len(ids) // 4, zlib.crc32(ids), ids)[: len(fields)])
                        at += len(ids) // 4
                        if len(out) == 1000 or i == len(file) - 1:
                            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*out, strict=True), fields, strict=True)], names=[n for n, _ in fields])
                            out = []

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part").select("path", "start").mapInArrow(run, schema)


def new_folder(spark) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
