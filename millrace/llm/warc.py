"""WARC archives as a Spark data source, and an archive of pages with repeated payloads as revisits.

Reading: files are planned into partitions by size. A record's header is parsed first and tested
against predicates on the record type and other header columns that are pushed down; the block of a
record that fails, or whose payload is not asked for, is stepped over without being decoded.
Writing: each task writes files of bounded size under names of its own, and only the files of
successful attempts are named in the manifest that the commit writes, so a task that runs twice or
an executor that is lost leaves no record twice.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from millrace.llm.common import Scratch
from millrace.lookup import lookup_join
from millrace.session import scratch_path

VERSION = b"WARC/1.1"
DATE = "2000-01-01T00:00:00Z"
FILE_BYTES = 256 * 1024 * 1024
SPLIT_BYTES = 32 * 1024 * 1024
BATCH_BYTES = 4 * 1024 * 1024

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, payload_bytes long, content_length long, headers map<string,string>, payload binary"
)
# Columns that a record's header alone decides, with the header that holds each.
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
WRITE_COLUMNS = ("record_id", "record_type", "target_uri", "refers_to", "payload_sha1", "payload")


def bare(value: str | None) -> str | None:
    """A header value without the brackets of a URI or the name of a digest."""
    if value is None:
        return None
    value = value[1:-1] if value.startswith("<") and value.endswith(">") else value
    return value.split(":", 1)[1] if value.lower().startswith("sha1:") else value


def passes(columns: dict[str, str | None], tests: Sequence[tuple[str, str, object]]) -> bool:
    for column, kind, wanted in tests:
        value = columns[column]
        if kind == "null":
            ok = (value is None) == wanted
        elif kind == "prefix":
            ok = value is not None and value.startswith(wanted)
        else:
            ok = value is not None and value in wanted
        if not ok:
            return False
    return True


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class WarcSource(DataSource):
    """``format("warc")``. Options: ``path``; ``where`` (header predicates as JSON, see
    ``read_warc``); ``payload`` (``false``: headers only); ``verify`` (``true``: a payload that misses
    its digest is an error); ``splitBytes``; ``fileBytes``; ``pushdown``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        pushing = self.options.get("pushdown", "false").lower() == "true"
        return PushingReader(self.options) if pushing else WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to: choose a new path instead")
        return WarcWriter(self.options, schema.names)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "true").lower() == "true"
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.tests: list[tuple[str, str, object]] = []
        for column, wanted in json.loads(options.get("where", "{}")).items():
            if column not in HEADER_OF:
                raise ValueError(f"{column} is not a header column: {sorted(HEADER_OF)}")
            if isinstance(wanted, str):
                self.tests.append((column, "prefix", wanted.removesuffix("%")))
            else:
                self.tests.append((column, "in", tuple(wanted)))

    def partitions(self) -> list[InputPartition]:
        """Files in order of name, the small ones together up to ``splitBytes``."""
        fs, root = pafs.FileSystem.from_uri(self.path)
        infos = fs.get_file_info(pafs.FileSelector(root, allow_not_found=False))
        sizes = {i.base_name: i.size for i in infos if i.type == pafs.FileType.File}
        manifests = [n for n in sizes if n.startswith("_manifest-")]
        if manifests:
            names = [n for m in manifests for n in json.loads(fs.open_input_file(f"{root}/{m}").read())]
        else:
            names = [n for n in sizes if n.endswith((".warc", ".warc.gz"))]
        groups, room = [], 0
        for name in sorted(names):
            if sizes[name] > room:
                groups.append([])
                room = self.split_bytes
            groups[-1].append(f"{root}/{name}")
            room -= sizes[name]
        return [Files(tuple(g)) for g in groups] or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as raw:
                file = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
                for row in self.records(file):
                    rows.append(row)
                    held += 500 + len(row[-1] or b"")
                    if held >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    def records(self, file: BinaryIO) -> Iterator[tuple]:
        lines = _Lines(file)
        while (headers := read_header(lines)) is not None:
            length = int(headers["content-length"])
            columns = {c: bare(headers.get(h)) for c, h in HEADER_OF.items()}
            if not passes(columns, self.tests):
                lines.skip(length + 4)
                continue
            payload, size = None, None
            if headers.get("content-type", "").startswith("application/http"):
                head = lines.take_to(b"\r\n\r\n", length)
                wanted = self.payload and "response" in headers["warc-type"]
                body = lines.take(length - len(head)) if wanted else None
                if body is None:
                    lines.skip(length - len(head))
                payload, size = self.http_payload(head, body, columns)
            elif self.payload:
                payload = lines.take(length)
                size = len(payload)
            else:
                lines.skip(length)
            lines.skip(4)
            yield (*columns.values(), size, length, list(headers.items()), payload)

    def http_payload(self, head: bytes, body: bytes | None, columns: dict) -> tuple[bytes | None, int | None]:
        """The decoded body, which is the payload, and its length; of a body not taken only what the head says.

        A payload digest covers the body as it is stored, encoded or not; records of this writer, known by
        ``X-Payload-Length``, have the digest of the decoded body, which is the same for every encoding.
        """
        fields = _fields(head.split(b"\r\n")[1:])
        own = "x-payload-length" in fields
        if body is None:
            return None, int(fields["x-payload-length"]) if own else None
        stored = body
        if fields.get("content-encoding") == "gzip":
            body = zlib.decompress(body, wbits=31)
        digest = columns["payload_digest"]
        if self.verify and digest and base64.b32encode(hashlib.sha1(body if own else stored).digest()).decode() != digest:
            raise ValueError(f"record {columns['record_id']} does not have its payload's digest")
        return body, len(body)


class PushingReader(WarcReader):
    """The reader that also takes the filters Spark pushes down."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            column = one.attribute[0] if len(one.attribute) == 1 else None
            if column not in HEADER_OF:
                yield one
            elif isinstance(one, EqualTo):
                self.tests.append((column, "in", (one.value,)))
            elif isinstance(one, In):
                self.tests.append((column, "in", tuple(one.value)))
            elif isinstance(one, StringStartsWith):
                self.tests.append((column, "prefix", one.value))
            elif isinstance(one, IsNotNull | IsNull):
                self.tests.append((column, "null", isinstance(one, IsNull)))
            else:
                yield one


class _Lines:
    """A file read through one buffer; what is skipped beyond the buffer is sought over."""

    def __init__(self, file: BinaryIO):
        self.file, self.buffer, self.at = file, b"", 0

    def line(self) -> bytes | None:
        while (end := self.buffer.find(b"\n", self.at)) < 0:
            more = self.file.read(1 << 16)
            if not more:
                return None
            self.buffer, self.at = self.buffer[self.at :] + more, 0
        line, self.at = self.buffer[self.at : end], end + 1
        return line.rstrip(b"\r")

    def take(self, n: int) -> bytes:
        have = self.buffer[self.at : self.at + n]
        self.at += len(have)
        out = have + self.file.read(n - len(have)) if len(have) < n else have
        if len(out) < n:
            raise ValueError("the archive ends inside a record")
        return out

    def take_to(self, end: bytes, most: int) -> bytes:
        """Bytes up to and with the first ``end``, or ``most`` of them where it does not come."""
        while (found := self.buffer.find(end, self.at, self.at + most)) < 0 and len(self.buffer) - self.at < most:
            more = self.file.read(1 << 16)
            if not more:
                raise ValueError("the archive ends inside a record")
            self.buffer, self.at = self.buffer[self.at :] + more, 0
        return self.take(most if found < 0 else found + len(end) - self.at)

    def skip(self, n: int) -> None:
        have = min(n, len(self.buffer) - self.at)
        self.at += have
        if n > have:
            self.file.seek(n - have, 1)


def _fields(lines: Sequence[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def read_header(lines: _Lines) -> dict[str, str] | None:
    """Headers of the next record by lower-case name, or None at the end of the file."""
    while (first := lines.line()) == b"":
        pass
    if first is None:
        return None
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not a record: {first[:40]!r}")
    found = []
    while line := lines.line():
        found.append(line)
    return _fields(found)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    string, long = pa.string(), pa.int64()
    types = [string] * 6 + [long, long, pa.map_(string, string), pa.binary()]
    names = [*HEADER_OF, "payload_bytes", "content_length", "headers", "payload"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def record_bytes(row: dict) -> bytes:
    """One record. A response's payload is an HTTP body in gzip; a revisit has the HTTP head only."""
    payload, sha1 = row["payload"], row["payload_sha1"]
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    body = zlib.compress(payload, 6, wbits=31) if row["record_type"] == "response" else b""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Payload-Length: {len(payload)}\r\n"
    head += f"Content-Encoding: gzip\r\nContent-Length: {len(body)}\r\n" if body else ""
    block = head.encode() + b"\r\n" + body
    lines = [
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{row['record_id']}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["target_uri"] is not None:
        uri = row["target_uri"].replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"WARC-Target-URI: {uri}")
    if row["refers_to"] is not None:
        lines.append(f"WARC-Refers-To: <{row['refers_to']}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, names: Sequence[str]):
        self.path = options["path"]
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))
        missing = set(WRITE_COLUMNS) - set(names)
        if missing:
            raise ValueError(f"columns missing for archives: {sorted(missing)}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            for start in range(0, batch.num_rows, 64):
                for row in batch.select(list(WRITE_COLUMNS)).slice(start, 64).to_pylist():
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"{uuid.uuid4().hex}.warc")
                        out, size = fs.open_output_stream(f"{root}/{names[-1]}"), 0
                    size += out.write(record := record_bytes(row)) or len(record)
        if out is not None:
            out.close()
        return Written(tuple(names))

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        with fs.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for name in (n for m in messages if m is not None for n in m.names):
            fs.delete_file(f"{root}/{name}")


def read_warc(spark: SparkSession, path: str, where: dict[str, str | list[str]] | None = None, **options: str) -> DataFrame:
    """Records of the archives in a folder (``SCHEMA``) that pass ``where``.

    ``where`` maps header columns (the keys of ``HEADER_OF``) to the values allowed, or to one prefix
    written as ``prefix%``; it reaches the reader, which steps over the blocks of other records.

    With the option ``pushdown="true"``, and ``spark.sql.python.filterPushdown.enabled`` set, Spark
    also pushes down ``filter`` on those columns. Spark 4.1 then keeps the filter with the DataFrame
    it was first used on, so read the archives anew for each filter, as ``where`` does.
    """
    spark.dataSource.register(WarcSource)
    if where:
        options["where"] = json.dumps(where)
    return spark.read.format("warc").options(**options).load(path)


def write_warc(records: DataFrame, path: str, **options: str) -> None:
    """Append records with the columns ``WRITE_COLUMNS`` to the folder."""
    records.sparkSession.dataSource.register(WarcSource)
    records.select(*WRITE_COLUMNS).write.format("warc").mode("append").options(**options).save(path)


def page_records(pages: DataFrame, *, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows for ``write_warc``: one per page, the payload being the page's text in UTF-8.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is a
    response (ties: the smallest url) and the others are revisits that refer to it; smaller payloads
    are all responses. Null text is an empty payload. A null id sorts last and is written as an empty
    name. Rows that repeat id, url and text are each a response if one of them is. An empty table
    gives no records; other columns are ignored.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"),
        F.col(url_col).cast("string").alias("target_uri"),
        payload.alias("payload"),
        F.sha1(payload).alias("payload_sha1"),
    ).withColumn("place", F.struct(F.col("page").isNull().alias("unnamed"), "page", "target_uri"))
    large = rows.filter(F.octet_length("payload") >= min_bytes)
    firsts = large.groupBy("payload_sha1").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    repeated = Scratch(pages.sparkSession, "revisits").keep(firsts.filter("n > 1").select("payload_sha1", "first"))
    joined = lookup_join(rows, repeated, "payload_sha1")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("place"))
    return joined.select(
        _name(F.col("page")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(again, _name(F.col("first.page"))).alias("refers_to"),
        "payload_sha1",
        "payload",
    )


def _name(page):
    return F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("")))


def page_of(name):
    """The page id in a record's name; null where the page had none."""
    return F.nullif(F.substring_index(name, ":", -1), F.lit("")).cast("long")


def archive_pages(pages: DataFrame, path: str | None = None, *, min_bytes: int = 0, **columns: str) -> DataFrame:
    """Write one record per page below ``path`` (by default a new shared folder) and read them back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(page_records(pages, min_bytes=min_bytes, **columns), path)
    return read_warc(spark, path)
