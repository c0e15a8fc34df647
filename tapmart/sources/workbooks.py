"""First sheet of Excel workbooks (.xlsx), one file per task.

A workbook is a zip of XML files and a sheet has at most 1,048,576 rows by its format, so one
file always fits one task; many files are read by many tasks.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# XML names of the workbook format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_DATE_CODES = re.compile(r"[ymdhs]", re.IGNORECASE)
_BUILT_IN_DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_DAY_ZERO = pd.Timestamp("1899-12-30")
_ROWS_PER_BATCH = 20_000


class BadRow(list):
    """The texts of a row's cells, as they stand in the file."""


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _text(element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{_MAIN}t"))


def _parts(book: zipfile.ZipFile):
    """Path of the first sheet, the shared texts, and the style numbers that mean a date."""
    sheet = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets")[0]
    relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in relations if r.get("Id") == sheet.get(f"{_REL}id"))
    path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    names = set(book.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
        shared = [_text(item) for item in root]
    dates = set()
    if "xl/styles.xml" in names:
        root = ElementTree.fromstring(book.read("xl/styles.xml"))
        custom = {
            int(f.get("numFmtId"))
            for f in root.iter(f"{_MAIN}numFmt")
            if _DATE_CODES.search(re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode")))
        }
        formats = root.find(f"{_MAIN}cellXfs")
        for number, style in enumerate(formats if formats is not None else []):
            if int(style.get("numFmtId", 0)) in _BUILT_IN_DATE_FORMATS | custom:
                dates.add(number)
    return path, shared, dates


def _value(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return _text(cell)
    value = cell.find(f"{_MAIN}v")
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind in ("str", "d"):
        return value.text
    if kind == "b":
        return "true" if value.text == "1" else "false"
    if kind == "e":
        return None
    number = float(value.text)
    if int(cell.get("s", 0)) in dates:
        moment = _DAY_ZERO + pd.Timedelta(round(number * 86_400_000), unit="ms")
        return str(moment)
    return str(int(number)) if number.is_integer() else repr(number)


def _shown(cell) -> str:
    return "".join(cell.itertext())


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as texts. A row with a cell that can't be read is a ``BadRow``."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        path, shared, dates = _parts(book)
        with book.open(path) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_MAIN}row":
                    continue
                values: list[str | None] = []
                try:
                    for cell in row:
                        reference = cell.get("r")
                        place = _column_number(reference) if reference else len(values)
                        values.extend([None] * (place + 1 - len(values)))
                        values[place] = _value(cell, shared, dates)
                except (ValueError, LookupError, AttributeError, OverflowError):
                    values = BadRow(_shown(cell) for cell in row)
                row.clear()
                yield values


def workbook_headers(
    spark: SparkSession, paths: Sequence[str]
) -> list[tuple[str, list[str], str | None]]:
    """Path, names in the first row, and what is wrong with the file if it cannot be read."""

    def first_rows(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                header, problem = [], None
                try:
                    header = [name or "" for name in next(sheet_rows(content), [])]
                    problem = None if header else "the file is empty"
                except Exception as error:
                    problem = f"not a readable workbook: {error}"
                yield pd.DataFrame({"path": [path], "header": [header], "problem": [problem]})

    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    found = files.mapInPandas(first_rows, "path string, header array<string>, problem string")
    return [(row["path"], list(row["header"]), row["problem"]) for row in found.collect()]


def _rows_to_damage(content: bytes) -> Iterator[list[str | None]]:
    """The rows of a sheet; where the file can't be read on, one last row says so."""
    try:
        yield from sheet_rows(content)
    except Exception as error:
        yield BadRow([f"the workbook cannot be read beyond here: {error}"])


def read_workbooks(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], bad_record: str = "bad_record"
) -> DataFrame:
    """The rows of workbooks of one header, as texts, with their place in the file.

    A row with a cell that can't be read, or with values beyond the header, stands whole in
    ``bad_record`` as a JSON list, and its own columns are null. Of a file that is damaged below
    its header the rows up to the damage are read, and a last bad record tells the rest is lost;
    other files are read as ever.
    """
    names = list(header)
    schema = ", ".join(f"`{n}` string" for n in [*names, bad_record])
    schema += ", source_file string, file_block bigint, row_number bigint"

    def laid_out(row):
        if isinstance(row, BadRow) or any(value is not None for value in row[len(names) :]):
            return [None] * len(names) + [json.dumps(row, ensure_ascii=False)]
        return (row + [None] * len(names))[: len(names)] + [None]

    def frame(rows, path, start):
        data = pd.DataFrame(map(laid_out, rows), columns=[*names, bad_record])
        data["source_file"] = path
        data["file_block"] = 0
        data["row_number"] = range(start, start + len(rows))
        return data

    def read(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows, start = [], 0
                for number, row in enumerate(_rows_to_damage(content)):
                    if number == 0 or not any(value is not None for value in row):
                        continue
                    rows.append(row)
                    if len(rows) == _ROWS_PER_BATCH:
                        yield frame(rows, path, start)
                        start, rows = start + len(rows), []
                if rows:
                    yield frame(rows, path, start)

    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return files.mapInPandas(read, schema)
