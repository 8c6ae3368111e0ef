"""WARC archives: a writer that stores equal payloads once, and a sequential reader.

Writer: each record is one gzip member.  Of the pages with one payload the
largest id is written as ``response``, the others as ``revisit`` records
(identical-payload-digest) that refer to it; their block keeps the HTTP head, whose
Content-Length is the payload's.  Every task writes its own files (a new one
after ``archive_bytes``), named by its attempt. The table of archives, which Spark commits,
lists those of the attempts that came through; what a lost attempt left is in no list.

Reader: each archive is read by one task, front to back in blocks.  The
stream is inflated incrementally, a new decompressor for every gzip member; the WARC
head gives the block's length, the HTTP head in it the payload's.  Payload bytes go into
SHA-1 as they come, so memory does not grow with a record.  Block and payload digests are
checked against the heads; a wrong digest, a short record or bytes that are no record raise.

Files are opened through ``pyarrow.fs`` under the shared checkpoint folder.

Defined results: NULL html is an empty payload; empty payloads are equal like any
others; of rows that repeat an id and its payload, one is the response and the others refer to the same
id; a NULL id counts as the smallest; an empty table makes no archive and gives an empty
result.  Other columns are not archived, except the URL, which may be NULL.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlens.llm.common import attach, scratch, ship_by_value, written

ship_by_value(__name__)

ARCHIVE_BYTES = 1 << 30
READ_BYTES = 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"


def open_fs(uri: str):
    """(file system, path) of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def revisit_plan(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``pages`` as (id, row, url, payload, revisit, refers_to, refers_row).

    Payloads are grouped by SHA-256.  Where several rows of a group have the
    largest id, the first in scan order is the response.  The numbered rows are
    written first, so every reader sees the same numbers.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = written(rows.withColumn("sha", F.sha2("payload", 256)), "warc-rows")
    per_id = rows.groupBy("sha", "id").agg(F.count("*").alias("same"), F.min("row").alias("row"))
    groups = per_id.groupBy("sha").agg(F.sum("same").alias("n"), F.max(F.struct("id", "same", "row")).alias("first"))
    groups = written(groups.where("n > 1"), "warc-groups")
    total = int(groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    found = attach(rows, groups, "sha", "n", ["id", "url", "row"], total, ["n", "first"])
    is_first = F.col("id").eqNullSafe(F.col("first.id")) & ((F.col("first.same") == 1) | (F.col("row") == F.col("first.row")))
    revisit = F.col("n").isNotNull() & ~is_first
    return found.select("id", "row", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("first.id")).alias("refers_to"),
                        F.when(revisit, F.col("first.row")).alias("refers_row"))


def _writer(folder: str, archive_bytes: int):
    def run(batches):
        import base64
        import hashlib
        import zlib
        from datetime import datetime, timezone

        from pyspark import TaskContext

        fs, root = open_fs(folder)
        context = TaskContext.get()
        stem = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        date = datetime.fromtimestamp(0, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")   # reruns write the same bytes
        out, name, size, records, number = None, "", 0, 0, 0

        def digest(data: bytes) -> str:
            return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()

        def name_of(page, row) -> str:          # the row keeps records of one page id apart
            return f"<{ID_PREFIX}{'' if page is None else page}#{row}>"

        def member(page, row, url, payload, revisit, refers_to, refers_row) -> bytes:
            http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
            block = http if revisit else http + payload
            heads = [("WARC-Type", "revisit" if revisit else "response"),
                     ("WARC-Record-ID", name_of(page, row)), ("WARC-Date", date)]
            if url:
                heads.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
            heads += [("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block))]
            if revisit:
                heads += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name_of(refers_to, refers_row))]
            heads += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
            head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in heads) + "\r\n"
            z = zlib.compressobj(6, zlib.DEFLATED, 31)
            return z.compress(head.encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()

        def closed():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64()), pa.array([size], pa.int64())],
                                              ["archive", "records", "bytes"])

        for batch in batches:
            for part in (batch.slice(k, 64) for k in range(0, batch.num_rows, 64)):
                for row in part.to_pylist():
                    if out is None:
                        name, size, records = f"{stem}-{number:04d}.warc.gz", 0, 0
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    data = member(row["id"], row["row"], row["url"], row["payload"], row["revisit"], row["refers_to"], row["refers_row"])
                    out.write(data)
                    size, records = size + len(data), records + 1
                    if size >= archive_bytes:
                        yield closed()
                        out, number = None, number + 1
        if out is not None:
            yield closed()

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives now and return (archive, records, bytes), a row for
    each file."""
    plan = revisit_plan(pages, id_col, url_col, html_col)
    return written(plan.mapInArrow(_writer(folder, archive_bytes), "archive string, records long, bytes long"), "warc-archives")


class Member:
    """The gzip members of a stream, one after the other, inflated piece by
    piece."""

    def __init__(self, stream):
        self.stream, self.raw, self.data, self.z = stream, b"", b"", None

    def next(self) -> bool:
        """Go to the next member; False at the end of the file."""
        import zlib

        self.raw = self.raw or self.stream.read(READ_BYTES)
        self.z, self.data = zlib.decompressobj(31), b""
        return bool(self.raw)

    def piece(self) -> bytes:
        """The next inflated bytes; none at the end of the member."""
        while not self.z.eof:
            self.raw = self.raw or self.stream.read(READ_BYTES)
            ended = not self.raw
            out = self.z.decompress(self.raw, READ_BYTES)
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if out:
                return out
            if ended and not self.z.eof:
                raise ValueError("archive ends within a record")
        return b""

    def head(self) -> list[str]:
        """The lines up to the empty line, however long; what follows stays in ``data``."""
        head = bytearray(self.data)
        seen = 0
        while (end := head.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(head)
            more = self.piece()
            if not more:
                raise ValueError("record without an end of its head")
            head += more
        self.data = bytes(head[end + 4:])
        return head[:end].decode("utf-8").split("\r\n")

    def take(self, n: int):
        """``n`` bytes in pieces."""
        while n:
            self.data = self.data or self.piece()
            if not self.data:
                raise ValueError("record shorter than its Content-Length")
            got, self.data = self.data[:n], self.data[n:]
            n -= len(got)
            yield got

    def rest(self) -> bytes:
        out = self.data
        while more := self.piece():
            out += more
        return out


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def read_records(stream, with_payload: bool = False):
    """Dicts of one archive's records, in order, digests verified."""
    import base64
    import hashlib

    member = Member(stream)
    while member.next():
        lines = member.head()
        head = _fields(lines)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        length = int(head["content-length"])
        block_sha, payload_sha, payload, size, http = hashlib.sha1(), hashlib.sha1(), [], 0, bytearray()
        in_head = True
        for got in member.take(length):
            block_sha.update(got)
            if in_head:                                     # the HTTP head ends at its empty line
                seen = max(0, len(http) - 3)
                http += got
                if (end := http.find(b"\r\n\r\n", seen)) < 0:
                    continue
                got = bytes(http[end + 4:])
                del http[end:]
                in_head = False
            payload_sha.update(got)
            size += len(got)
            if with_payload:
                payload.append(got)
        if in_head or member.rest() != b"\r\n\r\n":
            raise ValueError("record is not framed by its Content-Length")
        revisit = head["warc-type"] == "revisit"
        full = int(_fields(http.decode("utf-8").split("\r\n"))["content-length"])
        text = {k: "sha1:" + base64.b32encode(v.digest()).decode() for k, v in (("block", block_sha), ("payload", payload_sha))}
        stated = head["warc-payload-digest"]
        if text["block"] != head["warc-block-digest"] or not revisit and (text["payload"] != stated or size != full):
            raise ValueError(f"digest or length of {head['warc-record-id']} does not match")

        def page(name):
            digits = head.get(name, "").strip("<>").removeprefix(ID_PREFIX).partition("#")[0]
            return int(digits) if digits else None

        yield {"id": page("warc-record-id"), "url": head.get("warc-target-uri"), "payload_bytes": full,
               "payload_digest": stated.removeprefix("sha1:"), "record_type": head["warc-type"],
               "refers_to": page("warc-refers-to"), "payload": b"".join(payload) if with_payload and not revisit else None}


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the files named in the column ``archive``, each
    file in a task of its own: id, url, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``; ``payload`` too if asked for (NULL for revisits)."""
    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload

    def run(batches):
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        for batch in batches:
            for archive in batch.column(0).to_pylist():
                fs, path = open_fs(archive)
                with fs.open_input_stream(path, compression=None) as stream:
                    rows, held = [], 0
                    for r in read_records(stream, with_payload):
                        rows.append(r)
                        held += len(r["payload"] or b"")
                        if len(rows) >= 1000 or held > 1 << 24:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    schema = ("id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + ", payload binary" * with_payload)
    files = max(1, archives.count())
    return archives.select("archive").repartition(files).mapInArrow(run, schema)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                       archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, then read them back."""
    spark: SparkSession = pages.sparkSession
    archives = write_archives(pages, scratch(spark, "warc"), id_col, url_col, html_col, archive_bytes)
    return read_archives(archives).select(F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
