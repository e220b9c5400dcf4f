"""XLSX workbooks as tables, one Spark task per file."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from io import BytesIO
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

# Names the file format prescribes.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_BATCH_ROWS, _BATCH_TEXT = 4096, 1 << 21  # rows, and code points of their texts, that leave a task together
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def _unescape(value: str) -> str:
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), value)


def _text(node) -> str:
    """Text of a string item, rich runs joined, phonetic hints left out."""
    own = node.findall(f"{_MAIN}t") + node.findall(f"{_MAIN}r/{_MAIN}t")
    return _unescape("".join(t.text or "" for t in own))


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers that show a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {}
    for f in root.iter(f"{_MAIN}numFmt"):
        bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode"))
        custom[int(f.get("numFmtId"))] = bool(re.search(r"[dmyhs]", bare, re.IGNORECASE))
    formats = root.find(f"{_MAIN}cellXfs")
    ids = [int(x.get("numFmtId", 0)) for x in formats] if formats is not None else []
    return {i for i, n in enumerate(ids) if custom.get(n, n in _DATE_FORMATS)}


def _sheet_path(book: zipfile.ZipFile, sheet: str | None) -> str:
    sheets = list(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"))
    chosen = sheets[0] if sheet is None else next((s for s in sheets if s.get("name") == sheet), None)
    if chosen is None:
        raise ValueError(f"Worksheet named '{sheet}' not found")
    for relation in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if relation.get("Id") == chosen.get(_RELATION):
            target = relation.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("broken workbook: sheet without a part")


def _cell(cell, strings: list[str], dates: set[int]):
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _text(cell.find(f"{_MAIN}is"))
    raw = cell.findtext(f"{_MAIN}v")
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(raw)]
    if kind == "b":
        return raw == "1"
    if kind == "str":
        return _unescape(raw)
    number = float(raw)
    if int(cell.get("s", 0)) in dates:
        return datetime(1899, 12, 30) + timedelta(seconds=round(number * 86400))
    return int(raw) if re.fullmatch(r"-?\d+", raw) else number


def _streamed(part, around: str, tag: str) -> Iterator:
    """Elements of a part one by one; what has been handed out is let go, so the tree never grows."""
    parent = None
    for event, node in ElementTree.iterparse(part, ("start", "end")):
        if event == "start":
            parent = node if node.tag == _MAIN + around else parent
        elif node.tag == _MAIN + tag:
            yield node
            parent.clear()


def read_workbook(content: bytes, sheet: str | None = None) -> Iterator[list]:
    """Rows of one sheet, the header first, streamed from the sheet's XML."""
    with zipfile.ZipFile(BytesIO(content)) as book:
        strings = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as part:
                strings = [_text(si) for si in _streamed(part, "sst", "si")]
        dates = _date_styles(book)
        with book.open(_sheet_path(book, sheet)) as part:
            for node in _streamed(part, "sheetData", "row"):
                row: list = []
                for cell in node.iter(f"{_MAIN}c"):
                    at = _column_index(cell.get("r")) if cell.get("r") else len(row)
                    row += [None] * (at - len(row))
                    row.append(_cell(cell, strings, dates))
                yield row


def _as_type(value, kind: str):
    """A cell as a column's type; null where it is no such value, as in a CSV file.

    Integer columns take whole numbers only, number columns also numbers written as text.
    """
    if value is None:
        return None
    if kind == "string":
        return str(value)
    try:
        if kind in ("bigint", "int", "smallint"):
            return int(value) if isinstance(value, (bool, int)) or float(value).is_integer() else None
        if kind in ("double", "float"):
            return float(value)
    except (TypeError, ValueError):
        return None
    if kind == "boolean":
        return value if isinstance(value, bool) else None
    return value if isinstance(value, datetime) else None


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder).select("content")


def workbook_schema(spark: SparkSession, folder: str, sheet: str | None = None) -> StructType:
    """The columns of all workbooks of a folder: every header, and the narrowest type that holds its cells.

    Whole numbers are longs, other numbers doubles, truth values booleans, dates timestamps;
    a column of several kinds holds strings. Headers come in the order of the first file
    that has them; only distinct headers and kinds leave the tasks.
    """

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = read_workbook(content.as_py(), sheet)
                header = [str(name) if name is not None else None for name in next(rows, [])]
                seen: dict[tuple[int, str, str | None], None] = {(i, n, None): None for i, n in enumerate(header) if n}
                for row in rows:
                    seen.update(((i, n, _kind(v)), None) for i, (n, v) in enumerate(zip(header, row)) if n and v is not None)
                places, names, found = zip(*seen) if seen else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places, pa.int32()), pa.array(names, pa.string()), pa.array(found, pa.string())], ["place", "name", "kind"]
                )

    met = _files(spark, folder).mapInArrow(kinds, "place int, name string, kind string")
    columns = met.groupBy("name").agg(F.min("place").alias("place"), F.collect_set("kind").alias("kinds")).orderBy("place", "name")
    return StructType([StructField(r["name"], _TYPES[_widest(set(r["kinds"]))]) for r in columns.collect()])


_TYPES = {"long": LongType(), "double": DoubleType(), "boolean": BooleanType(), "timestamp": TimestampType(), "string": StringType()}


def _kind(value) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "long"
    return "double" if isinstance(value, float) else "timestamp" if isinstance(value, datetime) else "string"


def _widest(kinds: set[str]) -> str:
    if len(kinds) == 1:
        return next(iter(kinds))
    return "double" if kinds == {"long", "double"} else "string"


def scan_workbooks(
    spark: SparkSession, folder: str, schema: StructType | str | None = None, sheet: str | None = None
) -> DataFrame:
    """All ``.xlsx`` files of a folder as one table, columns matched by header name.

    The first sheet is read unless one is named. Without a schema the files are read
    once more to find one. A cell that is no value of its column's type is null. Files
    are read in parallel, rows leave each task in batches.
    """
    if schema is None:
        schema = workbook_schema(spark, folder, sheet)
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    files = _files(spark, folder)
    columns = [(f.name, f.dataType.simpleString()) for f in schema]
    target = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield from _batches(read_workbook(content.as_py(), sheet), columns, target)

    return files.mapInArrow(read, schema)


def _batches(rows: Iterator[list], columns: list[tuple[str, str]], target: pa.Schema) -> Iterator[pa.RecordBatch]:
    header = next(rows, [])
    at = [header.index(name) if name in header else None for name, _ in columns]
    held: list[list] = []
    size = 0

    def batch() -> pa.RecordBatch:
        arrays = [
            pa.array([_as_type(row[i] if i is not None and i < len(row) else None, kind) for row in held], field.type)
            for i, (_, kind), field in zip(at, columns, target)
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=target)

    for row in rows:
        if all(value is None for value in row):
            continue
        held.append(row)
        size += sum(len(value) for value in row if isinstance(value, str))
        if len(held) == _BATCH_ROWS or size >= _BATCH_TEXT:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()
