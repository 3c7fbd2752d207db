"""WARC: a deterministic sharded writer and its reader.

Writing: payload digests find equal payloads (narrow rows only); records are
range-sorted by page_id; each task writes its range to gzip files (one member a
record) and rolls to the next file once the compressed size is reached. Files
get temporary names that are unique to the task attempt; the rows that the
tasks return are the manifest, and only the files in it are renamed to their
final names, in tasks that can run again. The manifest is written last: a
folder without one is not complete, and a second call completes it. The bytes
depend on the rows alone (dates and ids are derived).

Reading: the manifest lists the files; each is streamed by one task, record by
record.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.llm.common import Scratch, shuffle_partitions

MANIFEST = "part int, seq int, name string, temp string, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    tail = (urn or "").strip("<>").rpartition(":")[2]
    return None if tail in ("", "none") else int(tail)


def _header(text: str) -> str:
    """A header value holds no line break; other characters travel as UTF-8."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: datetime) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header, and so the payload's length, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date:%Y-%m-%dT%H:%M:%SZ}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += [
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member without time or name, so equal data gives equal bytes."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Shard:
    """The files of one task attempt, under temporary names."""

    def __init__(self, folder: str, part: int):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.part, self.seq, self.attempt, self.out = part, 0, uuid.uuid4().hex, None

    def add(self, data: bytes) -> int:
        if self.out is None:
            self.temp = f"_temporary-{self.attempt}-{self.seq:05d}"
            self.out = self.store.open_output_stream(f"{self.folder}/{self.temp}", compression=None)
            self.records, self.size, self.sha = 0, 0, hashlib.sha256()
        self.out.write(data)
        self.records, self.size = self.records + 1, self.size + len(data)
        self.sha.update(data)
        return self.size

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        row = (self.part, self.seq, f"part-{self.part:05d}-{self.seq:05d}.warc.gz", self.temp, self.records, self.size, self.sha.hexdigest())
        self.seq += 1
        return row


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_MANIFEST = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("name", pa.string()), ("temp", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]
)


def records(pages: DataFrame, least: int = 100, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The rows to write, ``page_id, digest, refers_to, url, html``, and ahead of them the rows that revisit.

    Of payloads of at least ``least`` bytes that are equal, the record with the
    smallest page_id is the response and the others revisit it. Shorter ones
    are all responses. Rows that repeat that smallest page_id with the same
    payload are responses too. A null page_id ranks after all others and, if
    only such rows have a payload, they are responses.

    A row without html (null; payloads are not null here) says that all rows of
    its page_id and digest revisit ``refers_to``. Sorted by (page_id, digest,
    html IS NOT NULL) it comes just before them, so the texts are shuffled once.
    """
    p = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    big = p.where(F.octet_length("html") >= least)
    firsts = big.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    later = big.select("page_id", "digest").join(firsts, "digest").where("page_id IS NULL OR page_id > first").distinct()
    later = Scratch(pages.sparkSession, "warc").write(later, "revisits")
    text = F.lit(None).cast("string")
    return p.select("page_id", "digest", F.lit(None).cast("long").alias("refers_to"), "url", "html").unionByName(
        later.select("page_id", "digest", F.col("first").alias("refers_to"), text.alias("url"), text.alias("html"))
    )


def write_warc(
    pages: DataFrame, folder: str, roll_bytes: int = 64 << 20, level: int = 6, since: str = "2024-01-01", least: int = 100, **columns: str
) -> DataFrame:
    """Write one record for each row of ``pages`` to ``folder`` (a URI) and return the manifest.

    ``WARC-Date`` is ``since`` plus page_id seconds (modulo a century), not the
    clock. Null html is an empty payload; a null url leaves its header out. No
    rows: an empty manifest. A folder that holds a manifest is complete and is
    not written again (FileExistsError); what a call that ended early left is
    replaced, and files that the manifest does not name are not read.
    ``columns``: id_col, url_col, html_col.
    """
    spark = pages.sparkSession
    start = datetime.fromisoformat(since).replace(tzinfo=timezone.utc)
    store, root = fs.FileSystem.from_uri(_uri(folder))
    store.create_dir(root, recursive=True)
    folder = _uri(folder)
    if store.get_file_info(f"{root}/_manifest.parquet").type != fs.FileType.NotFound:
        raise FileExistsError(f"{folder} is complete")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(folder, TaskContext.get().partitionId())
        revisited = None, None, None
        for part in parts:
            for page_id, digest, refers_to, url, html in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if html is None:
                    revisited = page_id, digest, refers_to
                    continue
                refers_to = revisited[2] if revisited[:2] == (page_id, digest) else None
                date = start + timedelta(seconds=(page_id or 0) % 3_155_760_000)
                payload = html.encode("utf-8", "surrogatepass")
                data = record(page_id, url, payload, digest, refers_to, refers_to is not None, date)
                if shard.add(member(data, level)) >= roll_bytes:
                    yield _rows([shard.close()], _MANIFEST)
        if shard.out is not None:
            yield _rows([shard.close()], _MANIFEST)

    rows = records(pages, least, **columns)
    sorted_ = rows.repartitionByRange("page_id", "digest").sortWithinPartitions("page_id", "digest", F.col("html").isNotNull(), "url")
    # written before anything is renamed, so that no task runs a second time after the commit
    listed = f"{folder}/_manifest.tmp.parquet"
    sorted_.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(listed)
    final = spark.read.schema(MANIFEST).parquet(listed).select("temp", "name", "bytes").repartition(shuffle_partitions(spark))
    final.mapInArrow(_renamer(folder), "name string").write.format("noop").mode("overwrite").save()
    for info in store.get_file_info(fs.FileSelector(root)):  # of attempts that did not count
        if info.base_name.startswith("_temporary-"):
            store.delete_file(info.path)
    store.move(f"{root}/_manifest.tmp.parquet", f"{root}/_manifest.parquet")
    return read_manifest(spark, folder)


def _renamer(folder: str):
    """Gives the files of manifest rows ``temp, name, bytes`` their names; one that has its name already is left."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for part in parts:
            for temp, name, size in zip(*(c.to_pylist() for c in part.columns), strict=True):
                try:
                    store.move(f"{root}/{temp}", f"{root}/{name}")
                except OSError:  # another attempt of this task was here
                    if store.get_file_info(f"{root}/{temp}").type != fs.FileType.NotFound:
                        raise
                info = store.get_file_info(f"{root}/{name}")
                if info.type != fs.FileType.File or info.size != size:
                    raise FileNotFoundError(f"{name} of {size} bytes is not in {folder}")
            yield part.select(["name"])

    return run


def _uri(folder: str) -> str:
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{_uri(folder)}/_manifest.parquet").drop("temp")


def members(source, size: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed gzip members of a stream, one at a time."""
    z, held = zlib.decompressobj(31), []
    while data := source.read(size):
        while data:
            held.append(z.decompress(data))
            data = z.unused_data
            if z.eof:
                yield b"".join(held)
                z, held = zlib.decompressobj(31), []
    if held and any(held):
        raise ValueError("the file ends within a record")


def parse(data: bytes) -> tuple:
    """``RECORD`` of one record; raises where a length or digest is wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["warc-block-digest"]:
        raise ValueError(f"broken record {fields.get('warc-record-id')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"broken payload of {fields['warc-record-id']}")
    refers_to = page_of(fields["warc-refers-to"]) if kind == "revisit" else None
    return page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), length, digest, kind, refers_to, payload if kind == "response" else None


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of a committed folder; ``payload`` is null for revisits, and for all if not ``payloads``."""
    folder = _uri(folder)
    fields = T._parse_datatype_string(RECORD)
    names = [f.name for f in fields if payloads or f.name != "payload"]
    types = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.name, types[f.dataType.simpleString()]) for f in fields if f.name in names])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for part in parts:
            for name, count in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                seen, held, size = 0, [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for data in members(source):
                        row = parse(data)
                        held.append(row[: len(names)])
                        seen, size = seen + 1, size + len(data) * payloads
                        if len(held) >= 4096 or size >= 16 << 20:
                            yield _rows(held, schema)
                            held, size = [], 0
                if held:
                    yield _rows(held, schema)
                if seen != count:
                    raise ValueError(f"{name} has {seen} records, its manifest {count}")

    files = read_manifest(spark, folder).select("name", "records")
    schema_sql = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields if f.name in names)
    return files.repartition(max(1, files.count())).mapInArrow(run, schema_sql)  # a task for each file
