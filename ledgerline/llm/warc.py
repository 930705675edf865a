"""WARC archives: written by Spark, read by a PySpark Python data source.

Writing: of the records with equal payloads of at least ``min_revisit`` bytes,
that with the largest page id is the response and the others are revisits that
refer to it.  Every record becomes one string and Spark's text writer, with
the record separator as line separator, writes gzip archives through its own
commit protocol, to any store that Spark can write.

Reading (``spark.read.format("warc")`` after ``register``): partitions are
planned from the archive sizes, small archives together as long as every core
has some (option ``parallelism``).  Filters on the record type and on header
columns are taken over by the source; a record's headers are parsed first, and
the payload of an unwanted record is passed over: inflated with its stream,
since an archive is one gzip stream, but neither kept, hashed nor decoded.  Column pruning does not reach a Python data source, so the
option ``payload`` says what to do with the wanted payloads: ``skip``,
``digest`` (hash them) or ``bytes``.

Defined results: a NULL html is an empty payload; a NULL url gives a record
without target URI; line breaks inside a URL are percent-encoded; rows with a
NULL page id are always responses; repeated rows with the largest id are all
responses; a payload is held whole by the task that reads it, so the longest
text bounds a task's memory; an empty table gives an archive without records;
extra columns are ignored.  A damaged archive raises an error that names it.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from .common import written

END = "\r\n\r\n"
MIN_REVISIT = 1_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
PARTITION_BYTES = 128 << 20
SCHEMA = ("warc_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
          "payload_bytes long, computed_digest string, payload binary")
# Header columns that a filter can be tested on before the payload is read.
HEADERS = {"warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, record (one WARC record without its closing separator)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("size", F.octet_length("html")).withColumn("digest", F.sha1("html"))
    # Only payloads with copies: combined map-side, so a hot payload costs one row per task.
    copies = written(pages.where((F.col("size") >= min_revisit) & F.col("page_id").isNotNull()).groupBy("digest")
                     .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    rows = pages.join(copies, "digest", "left")
    revisit = F.coalesce(F.col("page_id") != F.col("response_id"), F.lit(False))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    name = lambda page: F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), F.coalesce(name(F.col("page_id")), F.concat(F.lit("<urn:sha1:"), "digest", F.lit(">"))),
        F.lit(f"\r\nWARC-Date: {DATE}"), F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), uri), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("response_id")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit(END), block)
    return rows.select("page_id", record.alias("record"))


def write(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Write the archives of ``pages`` into the new folder ``path``."""
    records(pages, min_revisit).select("record").write.option("lineSep", END).option("compression", "gzip").text(path)


class ArchivePartition(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


class WarcSource(DataSource):
    """Options: path (a folder of archives or one archive), payload (skip, digest
    or bytes), parallelism (partitions worth having if there are archives for them)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], self.options.get("payload", "bytes"), int(self.options.get("parallelism", "1")))


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str, parallelism: int = 1):
        if payload not in ("skip", "digest", "bytes"):
            raise ValueError(f"unknown payload option {payload}")
        self.path, self.payload, self.parallelism, self.wanted = path, payload, parallelism, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.wanted.append((type(f).__name__, HEADERS[f.attribute[0]], f.value))
            else:
                yield f

    def _filesystem(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def partitions(self) -> list[ArchivePartition]:
        from pyarrow import fs

        store, root = self._filesystem()
        found = store.get_file_info([root])
        if found[0].type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted(((f.size, f.path) for f in found if f.is_file and f.base_name[0] not in "._"), reverse=True)
        most = min(PARTITION_BYTES, sum(n for n, _ in files) // max(1, self.parallelism))
        parts, size = [[]], 0
        for n, path in files:
            if parts[-1] and size + n > most:
                parts.append([])
                size = 0
            parts[-1].append(path)
            size += n
        return [ArchivePartition(p) for p in parts]

    def _keeps(self, headers: dict[str, str]) -> bool:
        for kind, name, value in self.wanted:
            have = headers.get(name)
            if have is None:
                return False
            if name == "warc-payload-digest":
                have = have.removeprefix("sha1:")
            if not (have == value if kind == "EqualTo" else have in value if kind == "In" else have.startswith(value)):
                return False
        return True

    def read(self, partition: ArchivePartition) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                            for n, t in (x.split() for x in SCHEMA.split(","))])
        store, _ = self._filesystem()
        rows, size = [], 0
        for path in partition.paths:
            with store.open_input_stream(path, compression=None) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
                for row in parse(stream, path, self._keeps, self.payload):
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if len(rows) == 1_000 or size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _header_lines(stream) -> list[str]:
    lines = []
    while (line := stream.readline()) not in (b"\r\n", b""):
        lines.append(line.decode("utf-8", "replace").rstrip("\r\n"))
    return lines


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _skip(stream, n: int) -> None:
    while n > 0 and (got := len(stream.read(min(n, 1 << 20)))):
        n -= got


def parse(stream, path: str, keeps, payload: str) -> Iterator[tuple]:
    """Rows of the wanted records; blocks of the others are passed over."""
    while True:
        version = stream.readline()
        while version in (b"\r\n", b"\n"):
            version = stream.readline()
        if not version:
            return
        if not version.startswith(b"WARC/"):
            raise ValueError(f"{path} is not a WARC archive, or a record's length is wrong")
        headers = _fields(_header_lines(stream))
        length = int(headers["content-length"])
        if not keeps(headers):
            _skip(stream, length)
            continue
        http = {}
        if "application/http" in headers.get("content-type", ""):
            head = _http_head(stream, length)
            length -= len(head)
            http = _fields(head.decode("utf-8", "replace").split("\r\n")[1:])
        kind = headers.get("warc-type")
        computed, body = None, None
        if payload == "skip" or kind == "revisit":
            _skip(stream, length)
        else:
            body = stream.read(length)
            if len(body) < length:
                raise ValueError(f"{path} ends inside a record")
            computed = hashlib.sha1(body).hexdigest()
            body = body if payload == "bytes" else None
        size = int(http.get("content-length", length)) if kind == "revisit" else length
        digest = headers.get("warc-payload-digest")
        yield (kind, headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-date"), headers.get("warc-refers-to"),
               digest.removeprefix("sha1:") if digest else None, size, computed, body)


def _http_head(stream, length: int) -> bytes:
    """The status line and headers of an HTTP block, with their blank line."""
    head = b""
    while len(head) < length and not head.endswith(b"\r\n\r\n"):
        line = stream.readline(length - len(head))
        if not line:
            break
        head += line
        if line == b"\r\n":
            break
    return head


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, payload: str = "bytes") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).option("parallelism", spark.sparkContext.defaultParallelism).load(path)


def page_number(record_id):
    """The page id inside a record id, NULL for records of rows without one."""
    return F.when(record_id.startswith("<urn:page:"), F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).cast("long"))
