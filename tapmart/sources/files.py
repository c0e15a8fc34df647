"""Flat trip files: CSV, JSON and workbooks, with headers that may differ from file to file.

Spark matches CSV columns to a schema by position, and reads a JSON array and JSON lines by
different settings, giving wrong rows without an error where they are mixed up. So each file is
looked at first: only its first line, or first character, is read. Files of the same layout are
then read together by name, as one distributed scan per layout.
"""

from __future__ import annotations

import csv
import os
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapmart import presets
from tapmart.functions.casts import without_tokens
from tapmart.operators.cleaning import ensure_columns
from tapmart.operators.trips import BAD_RECORD
from tapmart.sources.workbooks import read_workbooks, workbook_headers

FORMATS = {".csv": "csv", ".json": "json", ".xlsx": "excel"}
FILE_COLUMNS = (*presets.REQUIRED_FILE_COLUMNS, *presets.OPTIONAL_FILE_COLUMNS)
ARRIVAL = ("source_file", "file_block", "row_number")
_LOOKS_AT_ONCE = 32
_BLANK = "\ufeff \t\r\n"


@dataclass(frozen=True)
class Layout:
    """What has to be equal for files to be read together. ``whole_file``: by one task each."""

    kind: str
    columns: tuple[str, ...] = ()
    whole_file: bool = False


@dataclass(frozen=True)
class FileCheck:
    """A file with its layout, or with the reason why it cannot be read."""

    path: str
    layout: Layout | None
    problem: str | None = None


def file_kind(path: str) -> str:
    """The format by file extension; others are refused."""
    extension = os.path.splitext(path)[1].lower()
    if extension not in FORMATS:
        raise ValueError(f"unsupported file format: {extension or path}")
    return FORMATS[extension]


def list_files(spark: SparkSession, folder: str, extensions: Iterable[str] = FORMATS) -> list[str]:
    """The matching files of a folder, in name order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().toString() for status in system.listStatus(path) if status.isFile()]
    wanted = tuple(extensions)
    return sorted(name for name in names if name.lower().endswith(wanted))


def _clean_header(names: Sequence[str]) -> tuple[str, ...]:
    """P14."""
    return tuple(name.strip().replace(" ", "") for name in names)


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line with text in it, read through the cluster's own file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = spark._jvm.java.io.InputStreamReader(system.open(hadoop_path), "UTF-8")
    reader = spark._jvm.java.io.BufferedReader(stream)
    try:
        line = reader.readLine()
        while line is not None and not line.strip(_BLANK):
            line = reader.readLine()
        return (line or "").strip(_BLANK)
    finally:
        reader.close()


def _text_layout(spark: SparkSession, path: str) -> Layout:
    kind = file_kind(path)
    line = _first_line(spark, path)
    if not line:
        raise ValueError("the file is empty")
    if kind == "json":
        return Layout(kind, whole_file=line.startswith("["))
    return Layout(kind, _clean_header(next(csv.reader([line]))))


def _checked(path: str, layout: Layout, required: Sequence[str]) -> FileCheck:
    absent = [name for name in required if name not in layout.columns]
    if absent and layout.columns:
        return FileCheck(path, None, f"required columns are missing: {', '.join(absent)}")
    if len(set(layout.columns)) < len(layout.columns):
        return FileCheck(path, None, "column names are not unique")
    return FileCheck(path, layout)


def _text_check(spark: SparkSession, path: str, required: Sequence[str]) -> FileCheck:
    try:
        return _checked(path, _text_layout(spark, path), required)
    except Exception as error:  # one unreadable file must not stop the others
        return FileCheck(path, None, str(error).strip())


def _workbook_checks(spark: SparkSession, paths: Sequence[str], required: Sequence[str]):
    for path, header, problem in workbook_headers(spark, paths):
        if problem:
            yield FileCheck(path, None, problem)
        else:
            yield _checked(path, Layout("excel", _clean_header(header), True), required)


def _without_missing_keys(
    spark: SparkSession, checks: Sequence[FileCheck], required: Sequence[str]
) -> list[FileCheck]:
    """JSON has no header: a required column is missing when no record of the file has it."""
    counts = [F.count(F.col(name)).alias(name) for name in required]
    problems: dict[str, str] = {}
    for whole_file in (True, False):
        paths = [c.path for c in checks if c.layout == Layout("json", whole_file=whole_file)]
        if not paths or not required:
            continue
        per_file = read_json(spark, paths, whole_file, required).groupBy("source_file")
        per_file = per_file.agg(*counts, F.count(BAD_RECORD).alias(BAD_RECORD))
        nothing = [F.when(F.col(name) == 0, F.lit(name)) for name in required]
        absent = F.concat_ws(", ", *nothing)
        # Only files with a fault come back. Files that hold broken records alone are read, so
        # that their records are listed as rejected.
        faulty = per_file.where((absent != "") & (F.col(BAD_RECORD) == 0))
        for row in faulty.select("source_file", absent.alias("absent")).toLocalIterator():
            problem = f"required columns are missing: {row['absent']}"
            problems[_file_name(spark, unquote(row["source_file"]))] = problem
    if not problems:
        return list(checks)
    bad = [problems.get(_file_name(spark, c.path)) if c.layout else None for c in checks]
    return [FileCheck(c.path, None, p) if p else c for c, p in zip(checks, bad)]


def _with_open_cells(spark: SparkSession, checks: Sequence[FileCheck]) -> list[FileCheck]:
    """Mark the CSV files that have a cell with a line break; these are read by one task each.

    Such a cell leaves an odd number of quotes in a line. The lines are counted by Spark, and only
    the names of the files concerned come back.
    """
    paths = [c.path for c in checks if c.layout and c.layout.kind == "csv"]
    if not paths:
        return list(checks)
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(paths).where(quotes % 2 == 1)
    names = lines.select(F.col("_metadata.file_path").alias("name")).distinct()
    found = {_file_name(spark, unquote(row["name"])) for row in names.toLocalIterator()}
    if not found:
        return list(checks)
    return [
        FileCheck(c.path, replace(c.layout, whole_file=True))
        if c.layout and c.layout.kind == "csv" and _file_name(spark, c.path) in found
        else c
        for c in checks
    ]


def _file_name(spark: SparkSession, path: str) -> str:
    """One spelling of a path, with its scheme, whichever way it was written."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop_path).toString()


def check_files(
    spark: SparkSession,
    paths: Sequence[str],
    required: Sequence[str] = presets.REQUIRED_FILE_COLUMNS,
) -> list[FileCheck]:
    """Look at every file before reading any: its format, its header, its required columns.

    Of CSV files the first line is read, which is metadata work like listing them; of workbooks
    the first row. JSON records are searched for the required keys, and CSV lines for cells that
    go on in the next line, by Spark. Checks come in the order of ``paths``.
    """
    kinds = [FORMATS.get(os.path.splitext(path)[1].lower()) for path in paths]
    texts = [path for path, kind in zip(paths, kinds) if kind != "excel"]
    with ThreadPoolExecutor(_LOOKS_AT_ONCE) as pool:
        of_texts = list(pool.map(lambda path: _text_check(spark, path, required), texts))
    of_texts = _without_missing_keys(spark, of_texts, required)
    of_texts = iter(_with_open_cells(spark, of_texts))
    books = [path for path, kind in zip(paths, kinds) if kind == "excel"]
    of_books = iter(list(_workbook_checks(spark, books, required)) if books else [])
    return [next(of_books if kind == "excel" else of_texts) for kind in kinds]


def _with_arrival(rows: DataFrame) -> DataFrame:
    """Where a row stands: file, block of the file, and order within the block.

    A block is read by one task from start to end, so the order is that of the file.
    """
    return rows.select(
        *[F.col(f"`{name}`") for name in rows.columns],
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("row_number"),
    )


def read_csv(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """S3: CSV files of one header, as texts.

    In columns whose text counts, "no value" texts become null; conversions do it in the others.
    Cells with line breaks need ``multi_line``, at the price of one task per file. A record with a
    field too many or too few stands whole in ``bad_record``; every record is parsed to its end,
    whichever columns are used, so that this does not depend on the query.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*header, BAD_RECORD)])
    reader = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
    reader = reader.option("columnNameOfCorruptRecord", BAD_RECORD).option("columnPruning", False)
    # The names given here are those of the header, cleaned; the header itself need not match.
    reader = reader.option("enforceSchema", True).option("escape", '"')
    rows = reader.option("multiLine", multi_line).csv(list(paths))
    rows = _with_arrival(rows)
    no_value = ["", *presets.NA_TOKENS]
    texts = [name for name in header if name in presets.TEXT_FILE_COLUMNS]
    return rows.withColumns({c: without_tokens(F.col(c), no_value) for c in texts})


def read_json(
    spark: SparkSession,
    paths: Sequence[str],
    whole_file: bool,
    columns: Sequence[str] = FILE_COLUMNS,
) -> DataFrame:
    """JSON arrays (``whole_file``) or JSON lines, as texts; null stays null.

    A record that is no JSON stands whole in ``bad_record``.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*columns, BAD_RECORD)])
    reader = spark.read.schema(schema).option("multiLine", whole_file)
    rows = reader.option("columnNameOfCorruptRecord", BAD_RECORD).json(list(paths))
    return _with_arrival(rows)


def read_layout(
    spark: SparkSession, layout: Layout, paths: Sequence[str], multi_line: bool = False
) -> DataFrame:
    if layout.kind == "csv":
        return read_csv(spark, paths, layout.columns, multi_line or layout.whole_file)
    if layout.kind == "json":
        return read_json(spark, paths, layout.whole_file)
    return read_workbooks(spark, paths, layout.columns, BAD_RECORD)


def read_checked(
    spark: SparkSession, checks: Sequence[FileCheck], multi_line: bool = False
) -> DataFrame:
    """The rows of all readable files, under the columns of a trip file plus ``ARRIVAL``, and
    ``bad_record`` with the whole text of a record that cannot be read.

    Absent optional columns become null, except the direction, which becomes 0; columns that no
    operator uses are left unread.
    """
    groups: dict[Layout, list[str]] = {}
    for check in checks:
        if check.layout is not None:
            groups.setdefault(check.layout, []).append(check.path)
    if not groups:
        raise ValueError("no readable files")
    null = F.lit(None).cast("string")
    absent = {name: F.lit("0") if name == "direction" else null for name in FILE_COLUMNS}
    absent[BAD_RECORD] = null
    frames = []
    for layout, paths in groups.items():
        frame = read_layout(spark, layout, paths, multi_line)
        frames.append(ensure_columns(frame, absent).select(*FILE_COLUMNS, *ARRIVAL, BAD_RECORD))
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    return rows


def read_file(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The rows of one file; a bad file is an error."""
    (check,) = check_files(spark, [path])
    if check.problem:
        raise ValueError(f"{path}: {check.problem}")
    return read_checked(spark, [check], multi_line)


def source_tag(source_file: Column) -> Column:
    """The lineage tag of a row is the format of its file."""
    extension = F.lower(F.regexp_extract(source_file, r"(\.[^./]+)$", 1))
    tag = F.lit("file")
    for suffix, kind in FORMATS.items():
        tag = F.when(extension == suffix, F.lit(kind)).otherwise(tag)
    return tag
