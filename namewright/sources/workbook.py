"""One-column XLSX workbooks, on the standard library, in any store that Spark reads.

Spark hands the file's bytes to one task: the format is sequential and holds at most 1,048,576 rows.  The rows then travel as
Arrow batches.  :func:`validate` enforces the source contract (hash, sheets, header, one column, text only) before anything is used.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.config import Source
from namewright.sources.files import Output

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
MOST_ROWS = 1 << 20


def sheets(book: zipfile.ZipFile) -> dict[str, str]:
    """Sheet names and their members in the file, in order."""
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    found = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}sheets")
    return {s.get("name"): "xl/" + targets[s.get(LINK)].removeprefix("/xl/") for s in found}


def cells(book: zipfile.ZipFile, sheet: str) -> Iterator[tuple[int, str, str | None]]:
    """(row, column letters, text) of the sheet's cells; a cell that holds no text is an error."""
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        for _, node in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
            if node.tag == f"{MAIN}si":
                shared.append("".join(t.text or "" for t in node.iter(f"{MAIN}t")))
                node.clear()
    for _, node in ElementTree.iterparse(book.open(sheets(book)[sheet])):
        if node.tag != f"{MAIN}row":
            continue
        number = int(node.get("r"))
        for cell in node.iter(f"{MAIN}c"):
            column = re.match("[A-Z]+", cell.get("r"))[0]
            kind, value = cell.get("t"), cell.find(f"{MAIN}v")
            if kind == "inlineStr":
                yield number, column, "".join(t.text or "" for t in cell.iter(f"{MAIN}t"))
            elif value is None:
                yield number, column, None
            elif kind == "s":
                yield number, column, shared[int(value.text)]
            elif kind == "str":
                yield number, column, value.text or ""
            else:
                raise ValueError(f"row {number} holds a value that is not text")
        node.clear()


def rows(book: zipfile.ZipFile, sheet: str) -> Iterator[tuple[int, str | None]]:
    """Numbered values of the first column, from row 2 on; rows that are left out are null."""
    last = 1
    for row, column, text in cells(book, sheet):
        if column != "A":
            raise ValueError(f"row {row} has more than one column")
        if row > 1:
            yield from ((gap, None) for gap in range(last + 1, row))
            last = row
            yield row, text


def read(spark: SparkSession, path: str, sheet: str = "Sheet1") -> DataFrame:
    """(source_row_number, nombre_original) of a workbook; rows are numbered from 2."""
    kind = pa.schema([("source_row_number", pa.int64()), ("nombre_original", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                found: list[tuple[int, str | None]] = []
                for row in rows(zipfile.ZipFile(io.BytesIO(content.as_py())), sheet):
                    found.append(row)
                    if len(found) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kind.types, strict=True)], schema=kind)
                        found = []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kind.types, strict=True)], schema=kind)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(work, "source_row_number long, nombre_original string")


def validate(spark: SparkSession, path: str, config: Source) -> str:
    """The file's SHA-256 in upper case, after the whole contract has been checked where the file is read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                book, fault = zipfile.ZipFile(io.BytesIO(content.as_py())), ""
                names = tuple(sheets(book))
                if names != config.expected_sheet_names:
                    fault = f"the workbook's sheets are {names}"
                else:
                    head = next(((c, t) for r, c, t in cells(book, config.sheet_name) if r == 1), ("A", None))
                    if head != ("A", config.column):
                        fault = f"the header is {head[1]!r}"
                    else:
                        try:
                            for _ in rows(book, config.sheet_name):
                                pass
                        except ValueError as error:
                            fault = f"the sheet has more than one column, or no text: {error}"
                yield pa.RecordBatch.from_pylist([{"fault": fault}], pa.schema([("fault", pa.string())]))

    book = spark.read.format("binaryFile").load(path)
    digest = book.select(F.upper(F.sha2("content", 256))).first()[0]
    if config.expected_sha256 and digest != config.expected_sha256.upper():
        raise ValueError(f"the workbook's SHA-256 is {digest}")
    if fault := book.select("content").mapInArrow(work, "fault string").first()[0]:
        raise ValueError(fault)
    return digest


def write(spark: SparkSession, values: DataFrame, path: str, config: Source) -> None:
    """A workbook with one sheet of one text column, in the order of ``values``; streamed by the driver, as the format allows a million rows."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    link = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook {main} {link}><sheets><sheet name="{escape(config.sheet_name)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        with book.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f"<worksheet {main}><sheetData>".encode())
            number = 1
            sheet.write(_row(number, config.column))
            for r in values.toLocalIterator():
                number += 1
                if number > MOST_ROWS:
                    raise ValueError("a sheet holds 1,048,576 rows at most")
                sheet.write(_row(number, r[0]))
            sheet.write(b"</sheetData></worksheet>")
    out = Output(spark, path)
    out.write(raw.getvalue())
    out.publish()


def _row(number: int, text: str | None) -> bytes:
    if text is None:
        return f'<row r="{number}"/>'.encode()
    return f'<row r="{number}"><c r="A{number}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c></row>'.encode()
