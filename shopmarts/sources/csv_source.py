"""Raw CSV source (S1-S6): presence, header contract, text scan, NA tokens, typed conform.

A raw file may be one file or a folder of part files. The header of every part file is checked against
the contract as a *set* of names; files are read in groups of equal header and united by name, so no
value is ever bound by position. Rows with more fields than the header and values that do not fit their
type are counted in the scan, for the pipeline to gate on. The free-text review file, whose quoted fields
hold line breaks, is cut into records by ``quoted_lines``, so one large file is read by many tasks too.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from shopmarts.functions.exprs import na_to_null
from shopmarts.sources import quoted_lines
from shopmarts.sources.contracts import BOOK, BOOK_ROWS, CONTRACTS, FileContract

ORDINAL = "_file_order"
SURPLUS = "_surplus"          # true for a row with more fields than its header
BOOK_SURPLUS, BOOK_REJECT = f"{BOOK}surplus", f"{BOOK}reject_"
_RAW_ROW = "_raw_row"
_MARK = "\u0002end"
HEADER_THREADS = 16


def raw_path(raw_dir: str, contract: FileContract, prefix: str = "") -> str:
    return f"{raw_dir.rstrip('/')}/{contract.file_name(prefix)}"


def _files(spark: SparkSession, path: str) -> list[str]:
    """Part files below a path (the listing Spark itself reads by); empty if there is nothing to read."""
    try:
        return sorted(spark.read.format("text").load(path).inputFiles())
    except AnalysisException:
        return []


def check_presence(spark: SparkSession, raw_dir: str, contracts=CONTRACTS, prefix: str = "") -> None:
    """One error naming every missing file (not just the first); an empty folder is missing."""
    missing = [c.file_name(prefix) for c in contracts if not _files(spark, raw_path(raw_dir, c, prefix))]
    if missing:
        raise FileNotFoundError(f"No raw data below {raw_dir} for: {', '.join(missing)}")


def presence_report(spark: SparkSession, raw_dir: str, contracts=CONTRACTS, prefix: str = "") -> DataFrame:
    """S1 as data: (file_name, present, header_ok, rows) for every expected file."""
    parts = []
    for c in contracts:
        present = bool(_files(spark, raw_path(raw_dir, c, prefix)))
        rows, good = None, False
        if present:
            try:
                rows, good = read_contract(spark, raw_dir, c, prefix, ordinal=False), True
            except ValueError:
                pass
        head = [F.lit(c.file_name(prefix)).alias("file_name"), F.lit(present).alias("present"), F.lit(good).alias("header_ok")]
        counted = rows.agg(F.count(F.lit(1)).alias("rows")) if good else spark.range(1).select(F.lit(None).cast("long").alias("rows"))
        parts.append(counted.select(*head, "rows"))
    return reduce(DataFrame.unionAll, parts)


def check_header(name: str, actual: list[str], expected) -> None:
    """Set equality; order is free. A name that comes twice never matches."""
    absent, strange = sorted(set(expected) - set(actual)), sorted(set(actual) - set(expected))
    twice = sorted({c for c in actual if actual.count(c) > 1})
    if absent or strange or twice:
        raise ValueError(f"Header of {name} breaks its contract. Missing: {absent}; unexpected: {strange}; repeated: {twice}")


def file_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Header -> part files that have it. First lines are read through the file system, some at a time;
    no data is scanned."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(uri: str) -> tuple[str, tuple[str, ...]]:
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        store = target.getFileSystem(conf)
        stream, codec = store.open(target), codecs.getCodec(target)
        try:
            plain = codec.createInputStream(stream) if codec else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
        finally:
            stream.close()
        return uri, tuple(next(csv.reader([line.removeprefix("\ufeff")]), ())) if line is not None else ()

    groups = defaultdict(list)
    with ThreadPoolExecutor(max_workers=HEADER_THREADS) as pool:
        for uri, header in pool.map(inheritable_thread_target(spark)(first_line), _files(spark, path)):
            groups[header].append(uri)
    return dict(groups)


def read_text(spark: SparkSession, path, multiline: bool = False, columns=None) -> DataFrame:
    """S3: header + all-text scan; doubled quotes are escapes (RFC 4180).

    With ``columns`` (the header's names in order) nothing is inferred, Spark holds every file's header
    against them once more, and ``SURPLUS`` marks rows with more fields than that. A row with fewer fields
    has NULL for the rest.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
              .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if columns is None:
        return reader.csv(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _RAW_ROW]])
    # a pruned parser would not look at the fields that a query leaves out
    df = reader.option("enforceSchema", False).option("columnPruning", False).option("columnNameOfCorruptRecord", _RAW_ROW).schema(schema).csv(path)
    # only a row whose number of fields is wrong keeps its text
    fields = _fields(F.col(_RAW_ROW), len(columns))
    return df.withColumn(SURPLUS, F.when(F.col(_RAW_ROW).isNotNull(), ~_complete(fields, len(columns))).otherwise(False)).drop(_RAW_ROW)


def _fields(record: F.Column, n: int) -> F.Column:
    """The first n + 1 fields of a record and a mark behind it."""
    return F.from_csv(F.concat(record, F.lit(f",{_MARK}")), ", ".join(f"f{i} string" for i in range(n + 1)), {"escape": '"', "multiLine": "true"})


def _complete(fields: F.Column, n: int) -> F.Column:
    """Whether the mark is among the n + 1 fields: the record has n fields at most."""
    return F.coalesce(F.array_contains(F.array(*[fields[f"f{i}"] for i in range(n + 1)]), _MARK), F.lit(False))


def read_quoted_text(spark: SparkSession, path, columns) -> DataFrame:
    """S3 for files with line breaks in quoted fields: as ``read_text`` with ``columns``, read in ranges; also
    the file, the range and the place in it of each record (``_file``, ``_block``, ``_place``)."""
    rows = quoted_lines.records(spark, path).where("block > 0 or number > 0")  # without the header
    rows = rows.select(F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("number").alias("_place"), _fields(F.col("value"), len(columns)).alias("f"))
    field = lambda i: F.when(F.col(f"f.f{i}") != _MARK, F.col(f"f.f{i}"))
    return rows.select("_file", "_block", "_place", *[field(i).alias(c) for i, c in enumerate(columns)], (~_complete(F.col("f"), len(columns))).alias(SURPLUS))


def read_contract(spark: SparkSession, raw_dir: str, contract: FileContract, prefix: str = "",
                  na_tokens: bool = True, ordinal: bool = True, surplus: bool = False) -> DataFrame:
    """S3 + S2 + S5: text columns named by each file's header, checked, NA tokens as NULL.

    ``ordinal`` adds the file-order struct (file path, split start, row id within the split) that
    "first row" semantics need; ``monotonically_increasing_id`` alone is only ordered within a split.
    ``surplus`` adds the mark of rows with too many fields.
    """
    path = raw_path(raw_dir, contract, prefix)
    groups = file_headers(spark, path)
    if not groups:
        raise FileNotFoundError(f"No raw data at {path}")
    for header in groups:
        check_header(contract.file_name(prefix), list(header), contract.columns)
    cols = [na_to_null(c).alias(c) if na_tokens else F.col(c) for c in contract.columns]
    if ordinal:
        place = ("_file", "_block", "_place") if contract.multiline else ("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
        cols.append(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(place, "fbr")]).alias(ORDINAL))
    if surplus:
        cols.append(F.col(SURPLUS))
    read = read_quoted_text if contract.multiline else read_text
    parts = [read(spark, path if len(groups) == 1 else files, columns=header).select(*cols) for header, files in sorted(groups.items())]
    return reduce(DataFrame.unionByName, parts)


def conform(df: DataFrame, contract: FileContract, keep_text=(T.TimestampNTZType,)) -> DataFrame:
    """Cast each raw column by name to the published type (``try_cast``: bad value -> NULL).

    Timestamp columns stay text here; the cleaning step parses them with an explicit format (C1).
    """
    target = {f.name: f.dataType for f in contract.schema.fields}
    out = []
    for raw in contract.columns:
        dtype = target[contract.renames.get(raw, raw)]
        c = F.col(raw)
        out.append(c.alias(raw) if isinstance(dtype, keep_text) or isinstance(dtype, T.StringType)
                   else c.try_cast(dtype).alias(raw))
    extra = [F.col(c) for c in df.columns if c not in contract.columns]
    return df.select(*out, *extra)


def _cast_targets(contract: FileContract, keep_text=(T.TimestampNTZType,)):
    target = {f.name: f.dataType for f in contract.schema.fields}
    for raw in contract.columns:
        dtype = target[contract.renames.get(raw, raw)]
        if not isinstance(dtype, (T.StringType, *keep_text)):
            yield raw, dtype


def _rejected(raw: str, dtype: T.DataType) -> str:
    """SQL: the text is there and does not fit the type."""
    return f"(try_cast(`{raw}` AS {dtype.simpleString()}) IS NULL AND `{raw}` IS NOT NULL)"


def booked(raw: DataFrame, contract: FileContract) -> DataFrame:
    """The rows with their book columns instead of the ``SURPLUS`` mark: one record each, whether it has
    surplus fields, and which values do not fit their type."""
    books = {BOOK_ROWS: F.lit(1).cast("long"), BOOK_SURPLUS: F.col(SURPLUS).cast("long")}
    books |= {f"{BOOK_REJECT}{column}": F.expr(_rejected(column, dtype)).cast("long") for column, dtype in _cast_targets(contract)}
    return raw.withColumns(books).drop(SURPLUS)


def quarantined(raw: DataFrame, contract: FileContract) -> DataFrame:
    """(table, file, block, place, column, reason, value, record): one row for each value that does not fit its
    type and each record with surplus fields, and where it stands: its file, the range of the file and the place
    in it. ``raw`` has the ordinal and the ``SURPLUS`` mark; ``record`` holds all its fields as JSON."""
    found = [F.struct(F.lit("*").alias("column"), F.lit("surplus fields").alias("reason"), F.lit(None).cast("string").alias("value"), F.col(SURPLUS).alias("bad"))]
    found += [F.struct(F.lit(column).alias("column"), F.lit(f"not {dtype.simpleString()}").alias("reason"), F.col(column).alias("value"),
                       F.expr(_rejected(column, dtype)).alias("bad")) for column, dtype in _cast_targets(contract)]
    bad = F.filter(F.array(*found), lambda x: x["bad"])
    place = [F.col(f"{ORDINAL}.{f}").alias(n) for f, n in zip("fbr", ("file", "block", "place"))]
    rows = raw.select(F.lit(contract.table).alias("table"), *place, F.to_json(F.struct(*contract.columns)).alias("record"), F.explode(bad).alias("bad"))
    return rows.select("table", "file", "block", "place", "bad.column", "bad.reason", "bad.value", "record")


def reject_exprs(contract: FileContract) -> list:
    """Per cast column: values non-NULL as text but NULL after the cast (aggregate expressions)."""
    return [F.expr(f"sum(CAST({_rejected(raw, dtype)} AS BIGINT)) AS `{raw}`") for raw, dtype in _cast_targets(contract)]


def rejects_report(df: DataFrame, contract: FileContract) -> DataFrame:
    """(column, target_type, rejects) for every cast column, computed in one aggregate pass; with the
    ``SURPLUS`` mark in the frame, also a row '*' for records with too many fields."""
    rows = [(raw, dtype.simpleString()) for raw, dtype in _cast_targets(contract)]
    aggregates = reject_exprs(contract)
    if SURPLUS in df.columns:
        rows.append(("*", "fields"))
        aggregates.append(F.sum(F.col(SURPLUS).cast("long")).alias("*"))
    stack = ", ".join(f"'{column}', '{kind}', coalesce(`{column}`, 0L)" for column, kind in rows)
    return df.agg(*aggregates).selectExpr(f"stack({len(rows)}, {stack}) AS (column, target_type, rejects)")
