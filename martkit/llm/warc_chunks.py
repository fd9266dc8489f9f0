"""Web archives by a chunked record table.

A payload is never handled as one piece outside the row it came in: it becomes
rows (record, chunk number, at most a mebibyte of data), in order, and every
step that needs all of it carries an incremental SHA-1 and a byte count from
chunk to chunk. One pass digests, a small table of digests decides which records
revisit which, one pass writes, and reading streams the archives back as chunk
rows. Archives are written under names of their own and listed in a manifest, so
what a lost or repeated task leaves behind is never read.

Defined cases: a null html counts as empty; null urls are written without a
target; rows equal in id and payload are all responses; a record without id is a
response unless a record with id has the same payload; an empty table gives no
archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm.common import Staging, open_folder
from martkit.session import new_path

CHUNK = 1 << 20
#: Bytes of an archive that one task reads at a time, at least.
STRETCH = 16 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_ODD = re.compile(r"[\x00-\x1f\x7f]|^\s|\s$|^$")
_GZIP = 31  # zlib's window setting for a gzip member


def records(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload`` and a hash that tells repeated ids apart."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.xxhash64(payload).alias("mark"),
    )


def chunk_table(known: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per chunk, the chunks of a record in order and side by side; an
    empty payload has one empty chunk."""
    last = F.greatest(F.ceil(F.octet_length("payload") / size) - 1, F.lit(0)).cast("int")
    rows = known.withColumn("last_chunk", last).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), "last_chunk")))
    return rows.withColumn("data", F.substring("payload", F.col("chunk_no") * size + 1, F.lit(size))).drop("payload")


def digests(chunks: DataFrame) -> DataFrame:
    """Per record its id, mark, ``payload_bytes`` and ``payload_digest``, by an
    incremental digest over its chunk rows."""

    def run(batches):
        sha, size = hashlib.sha1(), 0
        for batch in batches:
            out = []
            data = batch.column("data")
            for i, (page, mark, no, last) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("page_id", "mark", "chunk_no", "last_chunk")))):
                if no == 0:
                    sha, size = hashlib.sha1(), 0
                raw = data[i].as_buffer()
                sha.update(raw)
                size += raw.size
                if no == last:
                    out.append((page, mark, size, base64.b32encode(sha.digest()).decode()))
            columns = list(zip(*out)) or [()] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["page_id", "mark", "payload_bytes", "payload_digest"])

    fields = "page_id long, mark long, payload_bytes long, payload_digest string"
    return chunks.select("page_id", "mark", "chunk_no", "last_chunk", "data").mapInArrow(run, fields)


def decide(found: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Per id and mark: digest, size and ``refers_to``, which is null for a
    response."""
    first = found.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
    first = first.agg(F.min("page_id").alias("first_id")).filter("first_id is not null")
    joined = found.distinct().join(first, ["payload_digest", "payload_bytes"], "left")
    other = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "mark", "payload_bytes", "payload_digest", F.when(other, F.col("first_id")).alias("refers_to"))


def _name(page: int | None) -> str:
    return "<urn:x-page:none>" if page is None else f"<urn:x-page:{page}>"


def _header(row: dict, date: str) -> bytes:
    """The head of a record; its length is known before its data is seen."""
    revisit = row["refers_to"] is not None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(row['page_id'])}", f"WARC-Date: {date}"]
    if row["url"] is not None:
        odd = _ODD.search(row["url"])  # would break the line
        lines.append(f"WARC-Target-URI: {quote(row['url']) if odd else row['url']}")
        lines += ["X-Target-Quoted: yes"] * bool(odd)
    lines += [f"WARC-Payload-Digest: sha1:{row['payload_digest']}", f"X-Payload-Length: {row['payload_bytes']}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(row['refers_to'])}"]
    size = len(_HTTP) + (0 if revisit else row["payload_bytes"])
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + _HTTP


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a gzipped record per page; the manifest, a row per stretch of an
    archive."""
    known = records(pages)
    staging = Staging(pages.sparkSession)
    found = staging.keep(digests(chunk_table(known)), "digests")
    choice = decide(found, least_bytes).withColumnsRenamed({"page_id": "_page", "mark": "_mark"})
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("mark") == F.col("_mark"))
    joined = known.join(choice.hint("merge"), same).drop("_page", "_mark")
    stored = joined.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")))
    # Long payloads are cut into chunks before they leave the JVM.
    rows = chunk_table(stored).drop("mark")
    fields = "path string, offset long, length long"

    def write(batches):
        system, top = open_folder(folder)
        path, out, at, first, rows, pack = f"{top}/{uuid.uuid4().hex}.warc.gz", None, 0, 0, [], None
        for batch in batches:
            data = batch.column("data")
            for i, row in enumerate(batch.drop_columns(["data"]).to_pylist()):
                if out is None:
                    out = system.open_output_stream(path, compression=None)
                parts = []
                if row["chunk_no"] == 0:
                    pack = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
                    parts.append(pack.compress(_header(row, date)))
                parts.append(pack.compress(data[i].as_buffer()))
                if row["chunk_no"] == row["last_chunk"]:
                    parts += [pack.compress(b"\r\n\r\n"), pack.flush()]
                for part in parts:
                    out.write(part)
                    at += len(part)
                if row["chunk_no"] == row["last_chunk"] and at - first >= STRETCH:
                    rows.append((path, first, at - first))
                    first = at
        if out is not None:
            out.close()
            if at > first:
                rows.append((path, first, at - first))
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64(), pa.int64()])], names=["path", "offset", "length"])

    manifest = staging.keep(rows.mapInArrow(write, fields), "warc-manifest")
    staging.drop(found)
    return manifest


class _Stream:
    """Bytes of consecutive gzip members, a little at a time."""

    def __init__(self, source, offset: int, length: int):
        self.source, self.at, self.end = source, offset, offset + length
        self.unpack, self.raw, self.full = zlib.decompressobj(_GZIP), b"", False
        self.ready, self.pos = b"", 0  # bytes before pos are used up

    def _more(self) -> bool:
        if self.unpack.eof:
            self.raw, self.unpack, self.full = self.unpack.unused_data, zlib.decompressobj(_GZIP), False
        if not self.raw and not self.full:
            n = min(1 << 16, self.end - self.at)
            if n <= 0:
                return False
            self.raw = self.source.read_at(n, self.at)
            self.at += n
        out = self.unpack.decompress(self.raw, 1 << 18)
        self.raw, self.full = self.unpack.unconsumed_tail, len(out) == 1 << 18
        self.ready, self.pos = self.ready[self.pos :] + out, 0
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before a mark, which is passed over; None at the end."""
        while (k := self.ready.find(mark, self.pos)) < 0:
            if not self._more():
                if self.ready[self.pos :].strip():
                    raise ValueError("a record breaks off")
                return None
        out, self.pos = self.ready[self.pos : k], k + len(mark)
        return out

    def pieces(self, n: int, most: int):
        """The next ``n`` bytes in pieces of ``most``."""
        while n:
            size = min(n, most)
            parts = []
            while size:
                if self.pos == len(self.ready) and not self._more():
                    raise ValueError("a record breaks off")
                some = self.ready[self.pos : self.pos + size]
                self.pos += len(some)
                size -= len(some)
                n -= len(some)
                parts.append(some)
            yield b"".join(parts)


def _records(stream: _Stream, most: int):
    """(header fields, chunks of the payload) of each record in turn."""
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        left = int(fields["Content-Length"])
        left -= len(stream.until(b"\r\n\r\n")) + 4  # the HTTP head is no payload
        yield fields, stream.pieces(left, most)
        stream.until(b"\r\n\r\n")


def _page(name: str | None) -> int | None:
    return None if name is None or name.endswith(":none>") else int(name.rpartition(":")[2][:-1])


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, data: bool = True, size: int = CHUNK) -> DataFrame:
    """The chunk table of the archives: a row per chunk with ``bytes_so_far`` and
    ``digest_so_far`` of the payload; with ``data`` false the bytes stay out. A
    revisit has one row, with the size and digest that its record names."""
    names = ["page_id", "url", "record_type", "refers_to", "chunk_no", "last", "bytes_so_far", "digest_so_far", "data"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]

    def batch(rows):
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def chunks(fields, parts):
        revisit = fields["WARC-Type"] == "revisit"
        url = fields.get("WARC-Target-URI")
        url = unquote(url) if "X-Target-Quoted" in fields else url
        base = (_page(fields["WARC-Record-ID"]), url, fields["WARC-Type"], _page(fields.get("WARC-Refers-To")))
        total = int(fields["X-Payload-Length"])
        told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if revisit or not total:
            yield (*base, 0, True, total, told, b"" if data else None)
            return
        sha, done = hashlib.sha1(), 0
        for no, part in enumerate(parts):
            sha.update(part)
            done += len(part)
            yield (*base, no, done == total, done, base64.b32encode(sha.digest()).decode(), part if data else None)

    def read(batches):
        system, _ = open_folder(folder)
        for some in batches:
            for row in some.to_pylist():
                rows, held = [], 0
                with system.open_input_file(row["path"]) as source:
                    for fields, parts in _records(_Stream(source, row["offset"], row["length"]), size):
                        for chunk in chunks(fields, parts):
                            rows.append(chunk)
                            held += len(chunk[-1] or b"")
                            if held >= 4 * size or len(rows) >= 5000:
                                yield batch(rows)
                                rows, held = [], 0
                        for _ in parts:  # what is not wanted is read over
                            pass
                yield batch(rows)

    fields = "page_id long, url string, record_type string, refers_to long, chunk_no int, last boolean, bytes_so_far long, digest_so_far string, data binary"
    dealt = manifest.repartition(max(1, min(10_000, manifest.count())), "path", "offset")
    return dealt.mapInArrow(read, fields)


def archive_report(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Writes a record per page and reads the archives back: a row per page."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    rows = read_archives(spark, folder, write_archives(pages, folder, least_bytes), data=False)
    return rows.filter("last").select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"),
        "record_type", "refers_to", "url",
    )


_BITS = "0000000100100011010001010110011110001001101010111100110111101111"
_FIVE = " + ".join(f"{1 << (4 - k)} * CAST(substr(bits, j * 5 + {k + 1}, 1) AS INT)" for k in range(5))
#: The same rows in DuckDB's SQL; base 32 is spelled out from the digits of SHA-1.
ARCHIVE_SQL = f"""
WITH raw AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
digits AS (
  SELECT page_id, url, octet_length(payload) AS size, min(page_id) OVER (PARTITION BY payload) AS first,
    array_to_string(list_transform(range(1, 41), lambda i:
      substr('{_BITS}', strpos('0123456789abcdef', substr(sha1(payload), i, 1)) * 4 - 3, 4)), '') AS bits
  FROM raw)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_FIVE}, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, url
FROM digits
"""
