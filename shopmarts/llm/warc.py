"""WARC archives: written with Spark's text sink, read back by a Python data source.

Writing: of records with equal payloads the one with the smallest page id is a response, the others are
revisits that name it and hold no payload. A record is one row of the text sink, whose separator is the
blank line pair that ends a WARC record, so archives can be written to any store that Spark can write.

Reading (``spark.read.format("warc")``): one partition per archive file. A reader parses a record's
headers first, tests record type and headers, and passes over the payload of a record that is not wanted.
Predicates come from the options ``types`` and ``header.<Name>`` or, with the option ``pushdown``, from
filters on ``record_type``, ``record_id`` and ``target_uri`` (Spark hands them over only if
``spark.sql.python.filterPushdown.enabled`` is set, and refuses a reader that asks for them if not; so
``read_archives`` sets the option to match). ``payload=false`` skips every payload. Paths may be local or of any file system that pyarrow opens.

Defined results: a null html is an empty payload; rows that share the smallest id of a payload are all
responses; null ids sort after all others, and a payload of null ids only has responses only; line breaks
in a url are percent-encoded; an empty table writes an archive without records.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition


END = "\r\n\r\n"
BATCH_BYTES = 8 << 20
RECORDS_PER_FILE = 50_000
DATE = "1970-01-01T00:00:00Z"  # pages carry no date
SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, payload_digest string,"
          " payload_bytes long, payload binary")
_HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri"}


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are four base32 digits."""
    digest = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to of every page."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload").cast("binary"))})
    first = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"))
    revisit = (F.col("payload_bytes") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "payload_digest", "left").select(
        *rows.columns, F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first_id")).alias("refers_to"))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE,
                   compression: str = "gzip") -> None:
    """One WARC record per page, in files below ``path``; ``compression`` is the text sink's (none, gzip)."""
    rows = records(pages, min_bytes)
    response = F.col("record_type") == "response"
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
    safe_url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", _urn(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", safe_url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")), line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(response, "").otherwise(line("WARC-Refers-To", _urn(F.col("refers_to")))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.when(response, F.col("payload_bytes")).otherwise(0) + len(http)).cast("string")), F.lit("\r\n" + http),
    )
    out = rows.select(F.concat(header, F.when(response, F.col("payload")).otherwise("")).alias("value"))
    out.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).option("compression", compression).text(path)


def _open(path: str):
    """(file system, path in it); local paths with or without a scheme."""
    from pyarrow import fs

    if (m := re.match(r"file:/+", path)):
        path = "/" + path[m.end() :]
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class ArchiveFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.wanted: dict[str, set] = {}
        if options.get("types"):
            self.wanted["warc-type"] = {t.strip() for t in options["types"].split(",")}
        for name, value in dict(options).items():
            if name.lower().startswith("header."):
                self.wanted.setdefault(name.lower()[len("header."):], {value})

    def partitions(self):
        from pyarrow import fs

        store, path = _open(self.path)
        found = store.get_file_info(fs.FileSelector(path, recursive=True)) if store.get_file_info(path).type == fs.FileType.Directory else [store.get_file_info(path)]
        return [ArchiveFile(f.path) for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and f.size and f.base_name[0] not in "_."]

    def read(self, partition):
        if partition is None:  # no archive file at all
            return
        store, _ = _open(self.path)
        rows, held = [], 0
        plain = store.open_input_file(partition.path)
        with pa.CompressedInputStream(plain, "gzip") if partition.path.endswith(".gz") else pa.BufferedInputStream(plain, 1 << 20) as stream:
            for headers, payload in self._records(stream):
                refers = headers.get("warc-refers-to")
                rows.append((headers.get("warc-record-id"), headers.get("warc-type"), headers.get("warc-target-uri"), refers,
                             headers.get("warc-payload-digest"), int(headers["x-payload-length"]) if "x-payload-length" in headers else None, payload))
                held += 400 + len(payload or b"")
                if held >= BATCH_BYTES:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows):
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        names = ["record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def _records(self, stream):
        """(headers, payload) of the wanted records; lines end in CRLF, a block has Content-Length bytes."""
        ahead = b""

        def fill(n):
            nonlocal ahead
            while len(ahead) < n and (more := stream.read(max(1 << 16, n - len(ahead)))):
                ahead += more
            return len(ahead) >= n

        while fill(5):
            if not ahead.startswith(b"WARC/"):
                raise ValueError("not at the start of a WARC record")
            seen = 0
            while (at := ahead.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
                seen = len(ahead)
                if not fill(seen + 1):
                    raise ValueError("a WARC header does not end")
            lines = ahead[:at].decode("utf-8").split("\r\n")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            ahead = ahead[at + 4 :]
            length = int(headers["content-length"])
            if self.payload and all(headers.get(k) in v for k, v in self.wanted.items()):
                fill(length)
                block, ahead = ahead[:length], ahead[length:]
                if len(block) < length:
                    raise ValueError("a WARC record is cut off")
                yield headers, block.partition(b"\r\n\r\n")[2] if headers.get("warc-type") == "response" else None
            else:
                skip = length - len(ahead)
                if skip > 0:
                    ahead = b""
                    stream.read(skip) if skip < 1 << 16 else self._skip(stream, skip)
                else:
                    ahead = ahead[length:]
                if all(headers.get(k) in v for k, v in self.wanted.items()):
                    yield headers, None
            fill(4)
            ahead = ahead[4:]

    @staticmethod
    def _skip(stream, n):
        while n > 0 and (got := len(stream.read(min(n, 1 << 20)))):
            n -= got


class FilteringWarcReader(WarcReader):
    """Takes filters from Spark's planner; those on other columns go back to it."""

    def pushFilters(self, filters):
        for f in filters:
            name = _HEADERS.get(f.attribute[0]) if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(getattr(f, "value", ()))
            if name:
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return (FilteringWarcReader if str(self.options.get("pushdown", "false")).lower() == "true" else WarcReader)(self.options)


def read_archives(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(WarcDataSource)
    options.setdefault("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    return spark.read.format("warc").options(**options).load(path)


def archived_pages(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write the archives, read them back: one row per record, digests of responses from their payloads."""
    write_archives(pages, path, min_bytes)
    back = read_archives(pages.sparkSession, path)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).try_cast("long")
    there = F.col("payload").isNotNull()
    return back.select(
        page(F.col("record_id")).alias("page_id"),
        F.when(there, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(there, base32_sha1(F.col("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", page(F.col("refers_to")).alias("refers_to"))
