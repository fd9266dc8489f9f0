"""Token ids in files of fixed width: each id takes the least number of bits
that the vocabulary needs.

A file holds blocks of 65,536 ids, each block a whole number of bytes, then the
ids and starts of its documents, then a fixed-size tail that says where those
begin. As the width is fixed, the bytes of any id range follow from its start:
reading seeks to them and unpacks with numpy. Files are written in ascending
doc_id order, one per partition, under names of their own; the manifest, a table
with one row per stretch of a file, names those that count, so what a lost or
repeated task leaves behind is never read.

Defined cases: a null text counts as empty and has the end id only; rows with
equal doc_id are ordered by their text, null ids come first; an empty table
gives no file and an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm.common import Staging, open_folder
from martkit.llm.tokens import by_bytes, encoder
from martkit.session import new_path

MAGIC = b"BITSIDS1"
BLOCK = 65_536
#: Documents of about so many ids are read by one task at a time.
STRETCH = 4_000_000
_TAIL = struct.Struct("<qqqBq8s")  # documents, ids, index offset, bits, block, magic
_MANIFEST = "part int, path string, first_doc long, docs long, first_id long, ids long"


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, low bits first; the last byte is filled with 0."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(raw, axis=1, count=bits, bitorder="little"), bitorder="little").tobytes()


def unpack(raw: bytes, start: int, n: int, bits: int) -> np.ndarray:
    """``n`` ids of a packed stretch from id number ``start`` on."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n, start * bits // 8).astype(np.uint32)
    first = (np.arange(start, start + n, dtype=np.int64)) * bits
    padded = np.frombuffer(raw + b"\0" * 8, np.uint8)
    words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    return ((words[first >> 3] >> (first & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


class Writer:
    """One file: takes documents in order, holds one block."""

    def __init__(self, stream, bits: int):
        self.stream, self.bits = stream, bits
        self.held: list[np.ndarray] = []
        self.waiting = self.written = 0
        self.doc_ids: list[int | None] = []
        self.starts: list[int] = []
        self.total = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.total)
        self.total += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK:
            self._flush(self.waiting - self.waiting % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for k in range(0, n, BLOCK):
            raw = pack(ids[k : k + min(BLOCK, n - k)], self.bits)
            self.stream.write(raw)
            self.written += len(raw)
        self.held, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.waiting)
        names = np.array([x or 0 for x in self.doc_ids], "<i8")
        known = np.array([x is not None for x in self.doc_ids], np.uint8)
        self.stream.write(names.tobytes() + np.array(self.starts, "<i8").tobytes() + known.tobytes())
        self.stream.write(_TAIL.pack(len(names), self.total, self.written, self.bits, BLOCK, MAGIC))
        self.stream.close()


class Reader:
    """Random access to one file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        self.docs, self.ids, self.index, self.bits, self.block, magic = _TAIL.unpack(source.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")

    def documents(self, first: int, n: int) -> tuple[list[int | None], np.ndarray]:
        """Ids of documents and the n + 1 starts that bound them."""
        names = np.frombuffer(self.source.read_at(8 * n, self.index + 8 * first), "<i8")
        known = np.frombuffer(self.source.read_at(n, self.index + 16 * self.docs + first), np.uint8)
        more = min(n + 1, self.docs - first)
        starts = np.frombuffer(self.source.read_at(8 * more, self.index + 8 * (self.docs + first)), "<i8")
        if more == n:
            starts = np.append(starts, self.ids)
        return [int(x) if k else None for x, k in zip(names, known)], starts

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file."""
        group = start // 8 * 8  # eight ids fill whole bytes
        low, high = group * self.bits // 8, -(-(start + n) * self.bits // 8)
        return unpack(self.source.read_at(high - low, low), start - group, n, self.bits)


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encodes every whole text and writes it to ``folder``; the manifest."""

    def write(batches):
        from pyspark import TaskContext

        code = encoder(tokenizer)
        system, top = open_folder(folder)
        part = TaskContext.get().partitionId()
        path, out = f"{top}/part-{part:06d}-{uuid.uuid4().hex}.ids", None
        rows, first_doc, first_id = [], 0, 0
        for batch in batches:
            for some in by_bytes(batch, "text"):
                found = code.encode([x or "" for x in some.column("text").to_pylist()])
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), found):
                    if out is None:
                        out = Writer(system.open_output_stream(path), code.bits)
                    out.add(doc_id, np.append(ids, np.uint32(end_id)))
                    if out.total - first_id >= STRETCH:
                        rows.append((part, path, first_doc, len(out.doc_ids) - first_doc, first_id, out.total - first_id))
                        first_doc, first_id = len(out.doc_ids), out.total
        if out is not None:
            out.close()
            if len(out.doc_ids) > first_doc:
                rows.append((part, path, first_doc, len(out.doc_ids) - first_doc, first_id, out.total - first_id))
        names = [x.split()[0] for x in _MANIFEST.split(", ")]
        types = [pa.int32(), pa.string(), *[pa.int64()] * 4]
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return Staging(docs.sparkSession).keep(ordered.mapInArrow(write, _MANIFEST), "ids-manifest")


def read_ids(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Reads the files of a manifest back: per document ``doc_id``, ``start``
    (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""
    sizes = manifest.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect()  # one row per file
    before, bases = 0, []
    for row in sizes:
        bases.append((row["part"], before))
        before += row["ids"]
    placed = manifest.join(spark.createDataFrame(bases, "part int, base long"), "part")

    def read(batches):
        system, _ = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                yield _stretch(system, row)

    fields = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.repartition(max(1, min(10_000, len(sizes) * 2)), "path", "first_doc").mapInArrow(read, fields)


def _stretch(system, row: dict) -> pa.RecordBatch:
    with system.open_input_file(row["path"]) as source:
        file = Reader(source)
        names, starts = file.documents(row["first_doc"], row["docs"])
        crcs = [0] * len(names)
        lo, end = 0, int(starts[-1])
        at = int(starts[0])
        while at < end:  # a block at a time, also through very long documents
            ids = file.read(at, min(BLOCK, end - at)).astype("<u4")
            last = at + len(ids)
            while lo < len(names) and starts[lo] < last:
                a, b = max(at, int(starts[lo])), min(last, int(starts[lo + 1]))
                crcs[lo] = zlib.crc32(ids[a - at : b - at].tobytes(), crcs[lo])
                if starts[lo + 1] > last:
                    break
                lo += 1
            at = last
    columns = [pa.array(names, pa.int64()), pa.array(starts[:-1] + row["base"]), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def id_report(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Writes the ids of every text and reads them back."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "ids")
    return read_ids(spark, folder, write_ids(docs, folder, tokenizer, end_id))
