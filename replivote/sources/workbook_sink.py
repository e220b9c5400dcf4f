"""Tables as XLSX workbooks: a data source whose tasks write files that one commit makes visible."""

from __future__ import annotations

import json
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from decimal import Decimal
from itertools import chain
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from replivote.operators.reshape import quoted

# Names and limits the file format prescribes.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
MAX_ROWS = 1_048_576  # rows of a sheet, the header among them
MAX_COLUMNS = 16_384
MAX_CELL = 32_767  # UTF-16 units of a cell
MAX_BYTES = 1 << 24  # of a file, after which the rows go on in a next one: a reader holds a whole file
_PIECE = 256  # rows of a batch that are Python values at a time
_DATE, _TIME = 1, 2  # cell styles, in the order of _STYLES

_TYPES = (
    f'<Types xmlns="{_PACKAGE}/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    f'<Override PartName="/xl/workbook.xml" ContentType="{_SHEET_TYPE}.sheet.main+xml"/>'
    f'<Override PartName="/xl/styles.xml" ContentType="{_SHEET_TYPE}.styles+xml"/>'
    f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_SHEET_TYPE}.worksheet+xml"/></Types>'
)
_ROOT_RELS = (
    f'<Relationships xmlns="{_PACKAGE}/relationships">'
    f'<Relationship Id="rId1" Type="{_RELATIONS}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
)
_BOOK_RELS = (
    f'<Relationships xmlns="{_PACKAGE}/relationships">'
    f'<Relationship Id="rId1" Type="{_RELATIONS}/worksheet" Target="worksheets/sheet1.xml"/>'
    f'<Relationship Id="rId2" Type="{_RELATIONS}/styles" Target="styles.xml"/></Relationships>'
)
_BOOK = (
    f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELATIONS}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
)
_STYLES = (
    f'<styleSheet xmlns="{_MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
    '<cellStyleXfs count="1"><xf numFmtId="0"/></cellStyleXfs>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>'
)
_CELL_TYPES = (T.StringType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)
_OWN = re.compile(r"part-\d{5}-\d+(-[0-9a-f]{8})?\.xlsx")


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by path or by address."""
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", folder) if ":" in folder else f"file://{folder}")


def _escape(value: str) -> str:
    value = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", value)
    return escape(re.sub("[\x00-\x08\x0b-\x0d\x0e-\x1f\ufffe\uffff]", lambda m: f"_x{ord(m[0]):04X}_", value))


def _letters(index: int) -> str:
    name = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(ord("A") + rest) + name
    return name


def _serial(value: date) -> float:
    """Days since the format's first day; the time of a day is its fraction."""
    if not isinstance(value, datetime):
        return (value - date(1899, 12, 30)).days
    value = value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
    return (value - datetime(1899, 12, 30)).total_seconds() / 86400


def _text_cell(at: str, text: str) -> str:
    if len(text) > MAX_CELL // 2 and len(text.encode("utf-16-le")) // 2 > MAX_CELL:
        raise ValueError(f"a workbook cell holds at most {MAX_CELL} characters; cut the column with long_cells, or write Parquet or CSV")
    return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{_escape(text)}</t></is></c>'


def _xml_row(number: int, values: Sequence) -> str:
    cells = []
    for i, value in enumerate(values):
        if value is None or value != value:
            continue
        at = f'r="{_letters(i)}{number}"'
        if isinstance(value, bool):
            cells.append(f'<c {at} t="b"><v>{int(value)}</v></c>')
        elif isinstance(value, date):  # datetime is one too
            style = _TIME if isinstance(value, datetime) else _DATE
            cells.append(f'<c {at} s="{style}"><v>{_serial(value)!r}</v></c>')
        elif isinstance(value, (int, float, Decimal)) and abs(value) != float("inf"):
            cells.append(f"<c {at}><v>{value}</v></c>")
        else:
            cells.append(_text_cell(at, str(value)))
    return f'<row r="{number}">{"".join(cells)}</row>'


def _write_book(out, names: Sequence[str], rows: Iterator[tuple], most: int, max_bytes: int = MAX_BYTES) -> int:
    """One workbook of the header and up to ``most - 1`` of the rows, or about ``max_bytes``, streamed; returns how many."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("[Content_Types].xml", _TYPES)
        book.writestr("_rels/.rels", _ROOT_RELS)
        book.writestr("xl/workbook.xml", _BOOK)
        book.writestr("xl/_rels/workbook.xml.rels", _BOOK_RELS)
        book.writestr("xl/styles.xml", _STYLES)
        with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as part:
            part.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            part.write(_xml_row(1, names).encode())
            number = 1
            while number < most and (number == 1 or out.tell() < max_bytes) and (row := next(rows, None)) is not None:
                number += 1
                part.write(_xml_row(number, row).encode())
            part.write(b"</sheetData></worksheet>")
    return number - 1


@dataclass
class Written(WriterCommitMessage):
    """Files of one task, by their names after the commit: where each lies and its rows."""

    files: dict[str, tuple[str, int]] = field(default_factory=dict)


class WorkbookWriter(DataSourceArrowWriter):
    """Tasks write into a folder of this write alone; the driver's commit moves what the winning attempts wrote."""

    def __init__(self, schema: T.StructType, folder: str, overwrite: bool, most: int, max_bytes: int = MAX_BYTES):
        odd = [f.name for f in schema if not isinstance(f.dataType, _CELL_TYPES)]
        if odd:
            raise ValueError(f"a workbook cell holds no nested or binary value: {', '.join(odd)}")
        if not 0 < len(schema) <= MAX_COLUMNS or not 2 <= most <= MAX_ROWS:
            raise ValueError(f"a sheet holds 1 to {MAX_COLUMNS} columns and 2 to {MAX_ROWS} rows")
        self.names, self.folder, self.overwrite, self.most = schema.names, folder.rstrip("/"), overwrite, most
        self.max_bytes = max_bytes
        self.id = uuid.uuid4().hex
        system, root = file_system(self.folder)
        # only a write beside earlier ones needs names of its own
        self.suffix = "" if overwrite or not self._own(system, root) else f"-{self.id[:8]}"

    @staticmethod
    def _own(system: fs.FileSystem, root: str) -> list[str]:
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return [f.path for f in found if f.is_file and _OWN.fullmatch(f.base_name)]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        system, root = file_system(self.folder)
        own = f"{root}/_writing-{self.id}/{context.partitionId():05d}-{context.taskAttemptId()}"
        system.create_dir(own)
        pieces = (batch.slice(at, _PIECE) for batch in iterator for at in range(0, batch.num_rows, _PIECE))
        rows = (row for piece in pieces for row in zip(*[c.to_pylist() for c in piece.columns]))
        done = Written()
        first = next(rows, None)
        while first is not None:
            name = f"part-{context.partitionId():05d}-{len(done.files)}{self.suffix}.xlsx"
            with system.open_output_stream(f"{own}/{name}") as out:
                written = _write_book(out, self.names, chain([first], rows), self.most, self.max_bytes)
            done.files[name] = (f"{own}/{name}", written)
            first = next(rows, None)
        return done

    def commit(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.folder)
        files = {name: f for m in messages if m for name, f in m.files.items()}
        if not files:  # the header of an empty table
            name = f"part-00000-0{self.suffix}.xlsx"
            system.create_dir(f"{root}/_writing-{self.id}")
            with system.open_output_stream(f"{root}/_writing-{self.id}/{name}") as out:
                _write_book(out, self.names, iter(()), self.most)
            files[name] = (f"{root}/_writing-{self.id}/{name}", 0)
        if self.overwrite:
            for path in self._own(system, root):
                system.delete_file(path)
        for name, (path, _) in files.items():
            system.move(path, f"{root}/{name}")
        with system.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(json.dumps({name: rows for name, (_, rows) in files.items()}).encode())
        self._clear(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*file_system(self.folder))

    def _clear(self, system: fs.FileSystem, root: str) -> None:
        if system.get_file_info(f"{root}/_writing-{self.id}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_writing-{self.id}")


class WorkbookSink(DataSource):
    """``df.write.format("workbooks").mode("append").save(folder)``, once registered."""

    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def writer(self, schema: T.StructType, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(schema, self.options["path"], overwrite, int(self.options.get("maxRows", MAX_ROWS)), int(self.options.get("maxBytes", MAX_BYTES)))


def write_workbooks(
    table: DataFrame, folder: str, mode: str = "overwrite", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> int:
    """Write a table as workbooks into a folder that all executors reach; returns the number of rows written.

    Each partition becomes a file, or several where a sheet is full or a file has reached ``max_bytes``; rows keep their order, and
    names follow the partitions. Files appear when all tasks are done: an attempt that fails or is
    repeated leaves nothing behind. ``_SUCCESS`` lists the files with their rows. An empty table gives one file of a
    header. ``overwrite`` replaces workbooks that an earlier write put there, and no other file; ``append`` adds to them.

    Nulls and NaN are empty cells, dates and times date cells (UTC), infinities text. A text above 32,767 characters
    fails the write, see ``long_cells``; so does a nested or binary column.
    """
    table.sparkSession.dataSource.register(WorkbookSink)
    table.write.format("workbooks").option("maxRows", max_rows).option("maxBytes", max_bytes).mode(mode).save(folder)
    system, root = file_system(folder.rstrip("/"))
    with system.open_input_stream(f"{root}/_SUCCESS") as done:
        return sum(json.loads(done.read()).values())


def long_cells(table: DataFrame, columns: Sequence[str], part: str = "part", size: int = MAX_CELL // 2) -> DataFrame:
    """Rows whose texts are too long for a cell go on in further rows, numbered from 0 in ``part``.

    Every such row repeats the other columns; a text that has ended is null in the rows after it. Empty and null texts stay
    as they are. ``size`` is in code points, half of what a cell holds, so that it fits whatever they are.
    """
    lengths = [F.coalesce(F.length(quoted(c)), F.lit(0)) for c in columns]
    last = F.greatest(*[F.floor((n - 1) / size) for n in [*lengths, F.lit(1)]]).cast("int") if columns else F.lit(0)
    numbered = table.select("*", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).alias(part))

    def piece(name: str):
        text = quoted(name)
        started = (F.col(part) == 0) | (F.length(text) > F.col(part) * size)
        return F.when(started, F.substring(text, F.col(part) * size + 1, F.lit(size))).alias(name)

    return numbered.select(*[piece(c) if c in columns else quoted(c) for c in table.columns], part)


def whole_cells(table: DataFrame, key: str, columns: Sequence[str], part: str = "part") -> DataFrame:
    """The rows that ``long_cells`` cut, whole again; ``key`` tells the rows of the uncut table apart.

    Pieces of a row meet by a shuffle on the key, a row's own text in one cell as before it was cut.
    """

    def whole(name: str):
        pieces = F.array_sort(F.collect_list(F.when(quoted(name).isNotNull(), F.struct(quoted(part), quoted(name).alias("text")))))
        return F.when(F.size(pieces) > 0, F.array_join(pieces["text"], "")).alias(name)

    pieces = [whole(c) for c in columns]
    others = [F.min_by(quoted(c), quoted(part)).alias(c) for c in table.columns if c not in (key, part, *columns)]
    joined = table.groupBy(quoted(key)).agg(*pieces, *others)
    return joined.select(*[quoted(c) for c in table.columns if c != part])
