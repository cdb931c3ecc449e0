"""Spreadsheet workbooks (``.xlsx``, also ``.xlsx.bz2``), many files in one job.

Each workbook is unpacked inside a task, sheet by sheet and row by row, from XML events: besides the packed
file and its shared strings, which are kept as bytes, a task holds a batch of rows. What comes
out is a frame of sheet rows, ``(file, sheet, row, cells)``; ranges, headers and
sheet choice are plain DataFrame work on it.
"""

from __future__ import annotations

import array
import bz2
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import SOURCE_NAME
from quayside.functions.names import clean_name, quoted, require_unique
from quayside.functions.paths import file_name
from quayside.operators.lookup import lookup
from quayside.operators.schema import clean_columns, rename_positional, union_by_name
from quayside.session import checkpoint
from quayside.sources.frames import Files, Frame

ROWS_SCHEMA = f"{SOURCE_NAME} string, sheet_order int, sheet string, row int, cells array<string>"
#: Rows of a batch, and characters after which it is handed on with fewer.
BATCH_ROWS = 4096
BATCH_CHARS = 1 << 22

# fixed values: names used inside the workbook format
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_OFFICE_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def column_number(letters: str) -> int:
    """``A`` is 1, ``Z`` 26, ``AA`` 27."""
    number = 0
    for letter in letters.upper():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number


def cell_position(address: str) -> tuple[int, int]:
    """``B3`` as (row 3, column 2)."""
    found = re.fullmatch(r"\$?([A-Za-z]+)\$?(\d+)", address.strip())
    if not found:
        raise ValueError(f"not a cell address: {address!r}")
    return int(found[2]), column_number(found[1])


class _Strings:
    """The shared strings of a workbook: one run of bytes and where each ends."""

    def __init__(self) -> None:
        self.data, self.ends = bytearray(), array.array("Q", [0])

    def add(self, text: str) -> None:
        self.data += text.encode("utf-8", "surrogatepass")
        self.ends.append(len(self.data))

    def __getitem__(self, n: int) -> str:
        if not 0 <= n < len(self.ends) - 1:
            raise ValueError(f"no shared string {n}")
        return self.data[self.ends[n] : self.ends[n + 1]].decode("utf-8", "surrogatepass")


def _shared_strings(book: zipfile.ZipFile) -> _Strings:
    strings = _Strings()
    if "xl/sharedStrings.xml" not in book.namelist():
        return strings
    with book.open("xl/sharedStrings.xml") as part:
        root = None
        for event, item in ElementTree.iterparse(part, ("start", "end")):
            root = item if root is None else root
            if event == "end" and item.tag == _MAIN + "si":
                strings.add("".join(t.text or "" for t in item.iter(_MAIN + "t")))
                root.clear()
    return strings


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Sheet names and the workbook parts that hold them, in workbook order."""
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in links.iter(_PACKAGE + "Relationship")}
    listed = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(_MAIN + "sheet")
    parts = [(s.get("name"), targets[s.get(_OFFICE_ID)]) for s in listed]
    return [(n, t.lstrip("/") if t.startswith("/") else "xl/" + t) for n, t in parts]


def _cell_text(cell: ElementTree.Element, strings: _Strings) -> str:
    """Raw text of a cell; an error cell is empty."""
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(_MAIN + "t"))
    value = cell.findtext(_MAIN + "v")
    if value is None or kind == "e":
        return ""
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    return value


def _sheet_rows(part: io.BufferedIOBase, strings: _Strings) -> Iterator[tuple[int, list[str | None]]]:
    number = 0
    for event, node in ElementTree.iterparse(part, ("start", "end")):
        if node.tag == _MAIN + "sheetData" and event == "start":
            rows = node
        if node.tag != _MAIN + "row" or event == "start":
            continue
        number = int(node.get("r", number + 1))
        cells: list[str | None] = []
        for cell in node.iter(_MAIN + "c"):
            at = column_number(re.match("[A-Z]+", cell.get("r"))[0]) if cell.get("r") else len(cells) + 1
            cells += [None] * (at - len(cells))
            cells[at - 1] = _cell_text(cell, strings)
        yield number, cells
        rows.clear()


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [SOURCE_NAME, "sheet_order", "sheet", "row", "cells"]
    for batch in batches:
        for path, content in zip(batch[SOURCE_NAME], batch["content"]):
            raw = bz2.decompress(content) if path.endswith(".bz2") else content
            with zipfile.ZipFile(io.BytesIO(raw)) as book:
                strings = _shared_strings(book)
                for order, (sheet, target) in enumerate(_sheets(book)):
                    pending, chars, empty = [], 0, True
                    with book.open(target) as part:
                        for row, cells in _sheet_rows(part, strings):
                            pending.append((path, order, sheet, row, cells))
                            chars += sum(len(c) for c in cells if c)
                            empty = False
                            if len(pending) == BATCH_ROWS or chars > BATCH_CHARS:
                                yield pd.DataFrame(pending, columns=names)
                                pending, chars = [], 0
                    if empty:  # the sheet still exists; row 0 lies in no range
                        pending.append((path, order, sheet, 0, []))
                    if pending:
                        yield pd.DataFrame(pending, columns=names)


def sheet_rows(workbooks: DataFrame) -> DataFrame:
    """Rows of every sheet. ``workbooks`` has ``meta_source_name`` and ``content``."""
    open_ones = workbooks.where(~F.startswith(file_name(F.col(SOURCE_NAME)), F.lit("~$")))
    return open_ones.select(SOURCE_NAME, "content").mapInPandas(_unpack, ROWS_SCHEMA)


def workbook_files(spark: SparkSession, files: Files) -> DataFrame:
    scan = files.load(spark, "binaryFile")
    return scan.select(F.col("_metadata.file_path").alias(SOURCE_NAME), "content")


@dataclass(frozen=True)
class SheetRange:
    """A rectangle of a sheet: from ``start`` to ``end``, or to the last cell."""

    start: str
    end: str | None
    has_header: bool

    def __post_init__(self):
        cell_position(self.start)
        if self.end:
            cell_position(self.end)

    def read(self, rows: DataFrame, carried: Sequence[str] = (SOURCE_NAME,)) -> list[DataFrame]:
        """One frame per distinct header (or width) among the given sheets' rows."""
        top, left = cell_position(self.start)
        bottom, right = cell_position(self.end) if self.end else (None, None)
        inside = F.col("row") >= top
        if bottom:
            inside &= F.col("row") <= bottom
        width = (right - left + 1) if right else None
        cells = F.slice("cells", left, width if width else F.greatest(F.size("cells"), F.lit(1)))
        block = rows.where(inside).select(SOURCE_NAME, "sheet", *_others(carried), "row", cells.alias("cells"))
        if self.has_header:
            return self._with_header(block, top, width, carried)
        span = width or block.agg(F.max(F.size("cells"))).first()[0] or 0
        names = [f"_c{n}" for n in range(span)]
        return [_columns(block, names, carried)]

    def _with_header(self, block: DataFrame, top: int, width: int | None, carried) -> list[DataFrame]:
        # the header is the first row present, which may lie below the start cell
        keys = [SOURCE_NAME, "sheet"]
        heads = block.groupBy(*keys).agg(F.min_by("cells", "row").alias("_head"), F.min("row").alias("_head_row"))
        heads = checkpoint(heads)
        layouts = heads.select("_head").distinct().collect()
        frames = []
        for layout in sorted((r["_head"] for r in layouts), key=lambda h: [c or "" for c in h]):
            same = F.to_json(F.struct(F.col("_head"))) == F.to_json(F.struct(_array(layout).alias("_head")))
            data = lookup(block, heads.where(same), keys).where(F.col("row") > F.col("_head_row"))
            names = [c if c else f"_c{n}" for n, c in enumerate(layout)]
            frames.append(_columns(data, names, carried, keep_unnamed=False))
        return frames


def _array(values: Sequence[str | None]) -> Column:
    return F.array(*[F.lit(v).cast("string") for v in values]) if values else F.array().cast("array<string>")


def _others(carried: Sequence[str]) -> list[str]:
    return [c for c in carried if c != SOURCE_NAME]


def _columns(block: DataFrame, names: Sequence[str], carried, keep_unnamed: bool = True) -> DataFrame:
    chosen = [(n, name) for n, name in enumerate(names) if keep_unnamed or not name.startswith("_c")]
    require_unique((name for _, name in chosen), "a sheet header")
    return block.select(*[F.get("cells", F.lit(n)).alias(name) for n, name in chosen], *carried)


@dataclass(frozen=True)
class NamedRange:
    type_name: str
    start: str
    has_header: bool
    end: str | None = None
    sheet: str | None = None
    header_columns: Sequence[str] | None = None
    required: bool = True

    @property
    def address(self) -> str:
        sheet = f"'{self.sheet}'!" if self.sheet else ""
        return sheet + self.start + (f":{self.end}" if self.end else "")


@dataclass(frozen=True)
class WorkbookRanges:
    """Fixed ranges of each workbook, one frame per range."""

    source_system: str
    ranges: Sequence[NamedRange]

    source_type = "excel"

    def __post_init__(self):
        if not self.ranges:
            raise ValueError("ranges must not be empty")
        for r in self.ranges:
            SheetRange(r.start, r.end, r.has_header)
            require_unique(map(clean_name, r.header_columns or ()), f"range {r.type_name}")

    def type_tokens(self) -> list[dict[str, str]]:
        return [
            {
                "type": r.type_name,
                "sourceOffset": r.address,
                "sheet": r.sheet or "Sheet1",
                "startCell": r.start,
                "endCell": r.end or "unbound",
                "required": str(r.required).lower(),
            }
            for r in self.ranges
        ]

    def read(self, spark: SparkSession, files: Files) -> list[Frame]:
        return self.extract(checkpoint(sheet_rows(workbook_files(spark, files))))

    def extract(self, rows: DataFrame) -> list[Frame]:
        frames = []
        for r, tokens in zip(self.ranges, self.type_tokens()):
            for frame in self._extract(rows, r):
                layout = tuple(frame.columns)
                if r.header_columns:
                    frame = rename_positional(frame, r.header_columns)
                frames.append(Frame(frame, tokens, layout))
        return frames

    @staticmethod
    def _extract(rows: DataFrame, r: NamedRange) -> list[DataFrame]:
        chosen = F.col("sheet") == r.sheet if r.sheet else F.col("sheet_order") == 0
        if r.required:
            lacking = rows.groupBy(SOURCE_NAME).agg(F.bool_or(chosen).alias("found")).where("not found").take(5)
            if lacking:
                raise ValueError(f"no sheet {r.sheet!r} in {[row[0] for row in lacking]}")
        return SheetRange(r.start, r.end, r.has_header).read(rows.where(chosen))


@dataclass(frozen=True)
class SheetOption:
    """How to read the sheets whose name contains a match of ``pattern``."""

    pattern: str
    start: str
    has_header: bool
    end: str | None = None
    custom_name: str | None = None
    columns: Sequence[str] | None = None

    def __post_init__(self):
        re.compile(self.pattern)


@dataclass(frozen=True)
class WorkbookUnion:
    """All matching sheets of each workbook in one frame, with a sheet-name column.

    Sheets of one workbook must have the same columns. Workbooks with other columns give frames of their own. The first matching option reads a sheet. Its label is the custom name, else the
    first capture group of the pattern, else the sheet name.
    """

    source_system: str
    sheet_column: str
    options: Sequence[SheetOption]

    source_type = "excel_full_file"

    def __post_init__(self):
        if not self.options:
            raise ValueError("options must not be empty")
        for o in self.options:
            require_unique(map(clean_name, o.columns or ()), f"sheet option {o.pattern!r}")

    def type_tokens(self) -> list[dict[str, str]]:
        return [{"sourceOffset": ""}]

    def read(self, spark: SparkSession, files: Files) -> list[Frame]:
        return self.extract(checkpoint(sheet_rows(workbook_files(spark, files))))

    def extract(self, rows: DataFrame) -> list[Frame]:
        matches = [F.when(F.col("sheet").rlike(o.pattern), F.lit(n)) for n, o in enumerate(self.options)]
        chosen = rows.withColumn("_option", F.coalesce(*matches))
        frames = []
        for n, option in enumerate(self.options):
            label = self._label(option).alias(self.sheet_column)
            sheets = chosen.where(F.col("_option") == n).select("*", label)
            carried = [self.sheet_column, SOURCE_NAME]
            for frame in SheetRange(option.start, option.end, option.has_header).read(sheets, carried):
                if option.columns:
                    names = list(option.columns)
                    names += [] if self.sheet_column in names else [self.sheet_column]
                    frame = rename_positional(frame, names)
                frames.append(clean_columns(frame))
        if not frames:
            return [Frame(rows.sparkSession.createDataFrame([], f"{SOURCE_NAME} string"), self.type_tokens()[0])]
        by_columns: dict[tuple[str, ...], list[DataFrame]] = {}
        for frame in frames:
            by_columns.setdefault(tuple(sorted(frame.columns)), []).append(frame)
        if len(by_columns) > 1:
            self._require_one_layout(by_columns)
        # sheets without rows count only where there are no others
        wholes = {columns: union_by_name(group) for columns, group in by_columns.items()}
        filled = {columns: df for columns, df in wholes.items() if len(wholes) == 1 or not df.isEmpty()}
        chosen = filled or dict(list(wholes.items())[:1])
        return [Frame(df, self.type_tokens()[0], columns) for columns, df in chosen.items()]

    @staticmethod
    def _require_one_layout(by_columns: dict[tuple[str, ...], list[DataFrame]]) -> None:
        """Raise if a workbook has sheets of different columns."""
        columns = list(by_columns)
        used = [f.select(SOURCE_NAME, F.lit(n).alias("layout")).distinct() for n, c in enumerate(columns) for f in by_columns[c]]
        mixed = reduce(DataFrame.union, used).groupBy(SOURCE_NAME).agg(F.collect_set("layout").alias("layouts")).where(F.size("layouts") > 1)
        if found := mixed.first():
            first, second = sorted(found["layouts"])[:2]
            lacking = sorted(set(columns[first]) ^ set(columns[second]))
            raise ValueError(f"sheets of {found[SOURCE_NAME]} differ in columns {lacking}")

    @staticmethod
    def _label(option: SheetOption) -> Column:
        if option.custom_name is not None:
            return F.lit(option.custom_name)
        if re.compile(option.pattern).groups:
            return F.regexp_extract("sheet", option.pattern, 1)
        return F.col("sheet")
