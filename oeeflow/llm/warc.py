"""Web archives as a PySpark data source, ``spark.read.format("warc")`` and
``df.write.format("warc")``.

Writing: each task writes ``.warc.gz`` files, one gzip member per record, whose header carries the
member's length (the skip-length field of the WARC standard's annex). Files get unique names; the
commit lists those of successful attempts in a manifest, so files of lost or repeated attempts are
never read. Reading: the driver plans partitions from the manifest (or, without one, from the
folder), each task inflates a record's headers first, tests the pushed-down predicates on them and
jumps to the next member without inflating a payload that is not wanted (``payload=false``, or the
record fails a predicate).

Record types written: ``response`` (HTTP headers and payload) and ``revisit`` (HTTP headers alone,
with ``refers_to``). Files of other writers, compressed without skip lengths or not at all, are
read from end to end.

Defined results: a null payload is an empty one; repeated rows are repeated records; a null id
makes a record without a number in its id; an empty table makes an archive without records.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    StringContains, StringStartsWith, WriterCommitMessage)

from oeeflow.llm.common import on_workers, scratch_path, written

SCHEMA = ("record_type string, record_id string, target_uri string, warc_date string, payload_digest string, "
          "refers_to string, payload_bytes long, payload binary")
NAMES = ["record_type", "record_id", "target_uri", "warc_date", "payload_digest", "refers_to", "payload_bytes", "payload"]
MANIFEST = "_files.json"
ROLL_BYTES = 64 << 20
#: Header names of the WARC and HTTP standards.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "warc_date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(path: str):
    from pyarrow import fs
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


# ------------------------------------------------------------------ records

def record_bytes(row: dict) -> bytes:
    """One record: WARC headers, then a block of HTTP headers and, unless it is a revisit, the payload."""
    payload = row["payload"] or b""
    size = len(payload) if row.get("payload_bytes") is None else row["payload_bytes"]
    revisit = row["record_type"] == "revisit"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if not revisit:
        block += payload
    lines = ["WARC/1.1"]
    for column, name in HEADERS.items():
        if row.get(column) is not None:
            value = str(row[column]).replace("\r", "").replace("\n", "")
            lines.append(f"{name}: {'sha1:' + value if column == 'payload_digest' else value}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose extra field ``sl`` has its own and its inflated length."""
    pack = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    total = 12 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


class _Members:
    """The records of a file as (read, skip): ``read(n)`` gives the record's first n bytes (all for
    None), inflating no more than that; ``skip`` goes to the next record."""

    def __init__(self, f, size: int):
        self.f, self.size, self.at = f, size, 0

    def __iter__(self) -> Iterator:
        while self.at < self.size:
            self.f.seek(self.at)
            head = self.f.read(24)
            if head[:2] != b"\x1f\x8b":
                yield from self._plain()
                return
            if len(head) >= 24 and head[3] == 4 and head[12:14] == b"sl":
                total = struct.unpack("<I", head[16:20])[0]
                yield self._skipping(self.at, total)
                self.at += total
            else:
                yield from self._inflated()
                return

    def _skipping(self, start: int, total: int):
        def read(n: int | None) -> bytes:
            self.f.seek(start + 24)
            inflate = zlib.decompressobj(-15)
            if n is None:
                return inflate.decompress(self.f.read(total - 24))
            out, left = b"", total - 24
            while len(out) < n and left > 0 and not inflate.eof:
                piece = self.f.read(min(left, 4096))
                left -= len(piece)
                out += inflate.decompress(inflate.unconsumed_tail + piece, n - len(out))
            return out
        return read

    def _records(self, fill) -> Iterator:
        """Records of a stream without skip lengths; ``fill()`` gives more bytes, empty at the end."""
        buffer = b""
        while True:
            while b"\r\n\r\n" not in buffer.lstrip(b"\r\n"):
                more = fill()
                if not more:
                    return
                buffer += more
            buffer = buffer.lstrip(b"\r\n")
            end = buffer.index(b"\r\n\r\n") + 4
            size = end + int(_headers(buffer[:end]).get("content-length", 0))
            while len(buffer) < size:
                more = fill()
                if not more:
                    break
                buffer += more
            record, buffer = buffer[:size], buffer[size:]
            yield lambda n, r=record: r if n is None else r[:n]

    def _plain(self) -> Iterator:
        self.f.seek(self.at)
        yield from self._records(lambda: self.f.read(1 << 20))

    def _inflated(self) -> Iterator:
        self.f.seek(self.at)
        state = {"z": zlib.decompressobj(31), "rest": b""}

        def fill() -> bytes:
            while True:
                if state["z"].eof:
                    state["rest"] = state["z"].unused_data
                    state["z"] = zlib.decompressobj(31)
                raw = state["rest"] or self.f.read(1 << 20)
                state["rest"] = b""
                if not raw:
                    return b""
                out = state["z"].decompress(raw)
                if out:
                    return out
        yield from self._records(fill)


# ------------------------------------------------------------------ data source

class WarcFiles(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.split_bytes = int(options.get("splitBytes", 32 << 20))
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, In, StringStartsWith, StringContains)):
                self.wanted.append((type(f).__name__, column, tuple(f.value) if isinstance(f, In) else f.value))
            else:
                yield f

    def _wanted(self, row: dict) -> bool:
        for kind, column, value in self.wanted:
            have = row[column]
            if have is None or (kind == "EqualTo" and have != value) or (kind == "In" and have not in value) \
                    or (kind == "StringStartsWith" and not have.startswith(value)) \
                    or (kind == "StringContains" and value not in have):
                return False
        return True

    def partitions(self):
        from pyarrow import fs
        store, where = _store(self.path)
        if store.get_file_info(f"{where}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{where}/{MANIFEST}") as f:
                files = [tuple(x) for x in json.loads(f.read())]
        elif store.get_file_info(where).type == fs.FileType.File:
            return [WarcFiles([("", store.get_file_info(where).size)])]
        else:
            found = store.get_file_info(fs.FileSelector(where, allow_not_found=False))
            files = sorted((i.base_name, i.size) for i in found if i.type == fs.FileType.File and ".warc" in i.base_name)
        parts: list[list] = []
        room = 0
        for name, size in files:  # small files share a partition
            if not parts or room < size:
                parts.append([])
                room = self.split_bytes
            parts[-1].append((name, size))
            room -= size
        return [WarcFiles(p) for p in parts] or [WarcFiles([])]

    def read(self, partition):
        store, where = _store(self.path)
        rows: list[dict] = []
        held = 0
        for name, size in partition.files:
            with store.open_input_file(f"{where}/{name}" if name else where) as f:
                for record in _Members(f, size):
                    row = self._parse(record)
                    if row is not None:
                        rows.append(row)
                        held += len(row["payload"] or b"") + 300
                    if held > 8 << 20:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _parse(self, record) -> dict | None:
        head, size = b"", 2048
        while b"\r\n\r\n" not in head:
            more = record(size)
            if len(more) == len(head):
                return None  # no headers
            head, size = more, size * 2
        end = head.index(b"\r\n\r\n") + 4
        found = _headers(head[:end])
        row: dict = {c: found.get(n.lower()) for c, n in HEADERS.items()}
        if row["payload_digest"] is not None:
            row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
        row |= {"payload": None, "payload_bytes": None}
        if not self._wanted(row):
            return None
        block = int(found.get("content-length", 0))
        body, http = end, "application/http" in found.get("content-type", "")
        if http:
            while head.find(b"\r\n\r\n", end) < 0 and len(head) < end + block:
                more = record(size)
                if len(more) == len(head):
                    break
                head, size = more, size * 2
            body = head.find(b"\r\n\r\n", end) + 4
            row["payload_bytes"] = int(_headers(head[end:body]).get("content-length", end + block - body))
        else:
            row["payload_bytes"] = block
        if self.payload and row["record_type"] != "revisit":
            row["payload"] = record(None)[body:end + block]
        return row

    @staticmethod
    def _batch(rows: list[dict]) -> pa.RecordBatch:
        kinds = [pa.string()] * 6 + [pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(NAMES, kinds)], NAMES)


class WarcCommit(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")

    def write(self, iterator):
        store, where = _store(self.path)
        store.create_dir(where, recursive=True)
        files, out, name, size = [], None, "", 0
        for batch in iterator:
            names = batch.schema.names
            for i in range(batch.num_rows):
                data = member(record_bytes({n: batch.column(k)[i].as_py() for k, n in enumerate(names)}))
                if out is None or size + len(data) > ROLL_BYTES:
                    if out is not None:
                        out.close()
                        files.append((name, size))
                    name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{where}/{name}", compression=None)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            files.append((name, size))
        return WarcCommit(files)

    def commit(self, messages):
        store, where = _store(self.path)
        store.create_dir(where, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with store.open_output_stream(f"{where}/{MANIFEST}") as f:
            f.write(json.dumps(files).encode())

    def abort(self, messages):
        """Files without a manifest are never read."""


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let Spark push filters down to it."""
    on_workers(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# ------------------------------------------------------------------ pages to archives

def archive_pages(pages: DataFrame, path: str, min_payload: int = 0, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> None:
    """Write one record per row. Of records with equal payloads (by SHA-1) of at least
    ``min_payload`` bytes that with the smallest id is the response, the others revisit it."""
    register(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("target_uri"),
                        F.encode(F.coalesce(html_col, F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "payload_bytes": F.length("payload").cast("long")})
    # narrow: ids and digests; min and count are combined before the shuffle, however hot a digest
    narrow = written(rows.select("id", "sha1", "payload_bytes").filter(F.col("payload_bytes") >= min_payload)
                     .select("id", "sha1"), "warc-digests")
    again = narrow.groupBy("sha1").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null")
    revisits = (narrow.join(again, "sha1").filter(~F.col("id").eqNullSafe(F.col("first")))
                .groupBy(F.col("id").alias("of_id"), F.col("sha1").alias("of_sha1")).agg(F.min("first").alias("first")))
    on = rows["id"].eqNullSafe(revisits["of_id"]) & (rows["sha1"] == revisits["of_sha1"])
    joined = rows.join(revisits, on, "left")

    def urn(c: Column) -> Column:
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("first").isNotNull()
    records = joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn(F.col("id")).alias("record_id"),
        "target_uri", F.lit("2024-01-01T00:00:00Z").alias("warc_date"), F.col("sha1").alias("payload_digest"),
        F.when(revisit, urn(F.col("first"))).alias("refers_to"), "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))
    records.mapInArrow(_base32_digests, SCHEMA).write.format("warc").mode("append").save(path)


def _base32_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = list(batch.columns)
        cols[4] = pa.array([base64.b32encode(bytes.fromhex(h)).decode() for h in cols[4].to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays(cols, NAMES)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_number(urn: Column) -> Column:
    """The number in a record id that :func:`archive_pages` wrote (null if it has none)."""
    digits = F.regexp_extract(urn, r"^<urn:x-page:(-?[0-9]+)>$", 1)
    return F.when(digits != "", digits).cast("long")


def read_measured(spark: SparkSession, path: str) -> DataFrame:
    """The responses and revisits of an archive without their payloads: length and digest of a response are taken from
    the payload that was read (a record that was spoilt on the way shows), those of a revisit, whose
    payload is not there, from its headers. Both reads push the record type down."""
    full = read_archive(spark, path).filter("record_type = 'response'")
    body = F.coalesce("payload", F.lit(b""))
    full = full.withColumns({"payload_digest": F.sha1(body), "payload_bytes": F.length(body).cast("long"), "payload": F.lit(None).cast("binary")})
    full = full.select(*NAMES).mapInArrow(_base32_digests, SCHEMA)
    rest = read_archive(spark, path, payload=False).filter("record_type = 'revisit'")
    return full.unionByName(rest.select(*NAMES))


def archived_pages(pages: DataFrame, **options) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the records back (:func:`read_measured`)."""
    path = scratch_path(pages.sparkSession, "warc")
    archive_pages(pages, path, **options)
    return read_measured(pages.sparkSession, path)
