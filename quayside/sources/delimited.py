"""Delimited text: plain files, skipped lines, multi-line records, record types."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import LINE_NUMBER, SOURCE_NAME
from quayside.functions.names import clean_name, quoted, require_unique
from quayside.functions.text import line_breaks, tag_matches
from quayside.operators.numbering import (
    BLOCK,
    block_table,
    exclusive_running_sum,
    number_rows,
    with_positions,
)
from quayside.operators.schema import rename_positional
from quayside.session import checkpoint
from quayside.sources.frames import Files, Frame, stage_kinds

_BLANK = r"^[\x00-\x20]*$"
#: Records that may span lines are summed up in chunks of two to the power of so many.
RECORD_BITS = 12


@dataclass(frozen=True)
class Delimited:
    """One delimited file kind. All columns come out as trimmed strings.

    Files may differ in their header line; each distinct header gives one frame.
    Finding the headers costs no extra scan, except with ``skip_lines`` and
    ``has_header`` together, where the header is not the first line of a file.
    """

    source_system: str
    delimiter: str = ","
    has_header: bool = True
    encoding: str = "UTF-8"
    skip_lines: int | None = None
    header_columns: Sequence[str] | None = None
    multi_line: bool = False
    escape: str = "\\"

    source_type = "csv"

    def __post_init__(self):
        if self.header_columns:
            require_unique(map(clean_name, self.header_columns), f"header_columns of {self.source_system}")

    @property
    def offset(self) -> str:
        return "" if self.skip_lines is None else str(self.skip_lines)

    def type_tokens(self) -> list[dict[str, str]]:
        return [{"sourceOffset": self.offset}]

    def options(self) -> dict[str, str]:
        return {
            "sep": self.delimiter,
            "escape": self.escape,
            "ignoreLeadingWhiteSpace": "true",
            "ignoreTrailingWhiteSpace": "true",
        }

    def read(self, spark: SparkSession, files: Files) -> list[Frame]:
        multi_line = self.multi_line and self.skip_lines is None
        frames = self._read_records(spark, files) if multi_line else self._read_lines(spark, files)
        tokens, names = self.type_tokens()[0], self.header_columns
        return [Frame(rename_positional(f, names) if names else f, tokens, tuple(f.columns)) for f in frames]

    # one record per line: number the raw lines, then parse them

    def _read_lines(self, spark: SparkSession, files: Files) -> list[DataFrame]:
        lines = with_positions(text_lines(spark, files, self.encoding))
        blocks = block_table(lines, _layout(self.has_header, self.delimiter))
        numbered = number_rows(lines, blocks)
        skipped = self.skip_lines or 0
        if skipped:
            layout = _layout(self.has_header, self.delimiter)
            first_lines = numbered.where(F.col(LINE_NUMBER) == skipped + 1)
            layouts = checkpoint(first_lines.select(SOURCE_NAME, layout.alias("_layout")))
        else:
            layouts = _first_layouts(blocks)
        data = numbered.where((F.col(LINE_NUMBER) > skipped + self.has_header) & ~F.col("value").rlike(_BLANK))

        examples = _distinct_layouts(layouts)
        frames = []
        for example in examples:
            these = layouts.where(F.col("_layout") == example["_layout"]).select(SOURCE_NAME)
            if len(examples) > 1:
                # number these files alone, rather than go through all of them once per layout
                frames += self._read_lines(spark, Files.named(r[0] for r in these.toLocalIterator()))
                continue
            names = self._names(spark, self._line(spark, example["file"], skipped + 1))
            frames.append(self._parse(data, names))
        return frames

    def _parse(self, lines: DataFrame, names: Sequence[str]) -> DataFrame:
        record = F.from_csv("value", _ddl(names), self.options())
        parsed = lines.select(record.alias("_record"), LINE_NUMBER, SOURCE_NAME)
        fields = [F.col("_record").getField(n).alias(n) for n in names]
        return parsed.select(*fields, LINE_NUMBER, SOURCE_NAME)

    def _line(self, spark: SparkSession, file: str, number: int) -> str:
        """One line of one file. The first line comes from the first block alone."""
        lines = with_positions(text_lines(spark, Files.named([file]), self.encoding))
        if number == 1:
            found = lines.where(F.col(BLOCK) == 0)
        else:
            found = number_rows(lines, block_table(lines)).where(F.col(LINE_NUMBER) == number)
        return found.select("value").first()["value"]

    def _names(self, spark: SparkSession, header: str) -> list[str]:
        sample = spark.sparkContext.parallelize([header], 1)
        reader = spark.read.options(header=self.has_header, inferSchema=False, **self.options())
        return reader.csv(sample).columns

    # records that span lines: let the file source find them, then count line breaks

    def _read_records(self, spark: SparkSession, files: Files) -> list[DataFrame]:
        lines = with_positions(text_lines(spark, files, self.encoding))
        blocks = block_table(lines, _layout(self.has_header, self.delimiter))
        layouts = _first_layouts(blocks)
        examples = _distinct_layouts(layouts)
        options = {"header": self.has_header, "multiLine": True, "encoding": self.encoding, **self.options()}
        frames = []
        for example in examples:
            schema = Files.named([example["file"]]).load(spark, "csv", inferSchema=False, **options).schema
            group = files
            if len(examples) > 1:
                these = layouts.where(F.col("_layout") == example["_layout"]).select(SOURCE_NAME)
                group = Files.named(r[0] for r in these.toLocalIterator())
            scan = group.reader(spark).schema(schema).options(**options).csv(list(group.paths))
            frames.append(_number_records(scan, self.has_header))
        return frames


def text_lines(spark: SparkSession, files: Files, encoding: str = "UTF-8") -> DataFrame:
    """Raw lines with the file metadata column still attached."""
    if encoding.upper().replace("_", "-") in ("UTF-8", "UTF8", "US-ASCII"):
        return files.load(spark, "text")
    wide = encoding.upper().startswith(("UTF-16", "UTF-32"))
    lines = files.load(spark, "text", encoding=encoding if wide else None, lineSep="\n" if wide else None)
    decoded = F.decode(F.col("value").cast("binary"), encoding)
    return lines.withColumn("value", F.regexp_replace(decoded, "^\\uFEFF|\\r$", ""))


def _number_records(scan: DataFrame, has_header: bool) -> DataFrame:
    """Physical line of each record: its number plus all line breaks inside earlier records."""
    names = scan.columns
    positions = with_positions(scan)
    records = number_rows(positions, block_table(positions), offset=int(has_header))
    counted = records.withColumn("_breaks", line_breaks([F.col(quoted(n)) for n in names]))
    # whole records go through the windows, so chunks are of fewer rows
    summed = exclusive_running_sum(counted, "_breaks", LINE_NUMBER, "_earlier", (SOURCE_NAME,), RECORD_BITS)
    return summed.select(
        *map(quoted, names), (F.col(LINE_NUMBER) + F.col("_earlier")).alias(LINE_NUMBER), SOURCE_NAME
    )


def _layout(has_header: bool, delimiter: str):
    """A number equal for lines with the same columns: header text, or column count."""
    if has_header:
        return F.xxhash64("value")
    return F.size(F.split("value", "\\Q" + delimiter + "\\E", -1)).cast("long")


def _first_layouts(blocks: DataFrame) -> DataFrame:
    """The layout of each file by its first line."""
    first = blocks.where((F.col("_before") == 0) & (F.col("_rows") > 0))
    return first.select(SOURCE_NAME, F.col("_first_row").alias("_layout"))


def _distinct_layouts(layouts: DataFrame) -> list:
    """One example file per layout: each becomes a frame of its own, so the driver must know them all."""
    examples = layouts.groupBy("_layout").agg(F.min(SOURCE_NAME).alias("file")).collect()
    return sorted(examples, key=lambda r: r["file"])


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"{quoted(n)} string" for n in names)


@dataclass(frozen=True)
class RecordType:
    """A kind of line: its tag pattern and its column names."""

    type_name: str
    pattern: str
    columns: Sequence[str]


@dataclass(frozen=True)
class DelimitedRecords:
    """Delimited lines of several kinds in one file, told apart by one column.

    ``record_type_index`` is 1-based. A line may belong to several kinds or none.
    """

    source_system: str
    delimiter: str
    record_type_index: int
    types: Sequence[RecordType]
    encoding: str = "UTF-8"
    multi_line: bool = False

    source_type = "delimitedHeaderFooter"

    def __post_init__(self):
        if not self.types or any(not t.columns for t in self.types):
            raise ValueError("record types and their columns must not be empty")
        for kind in self.types:
            require_unique(map(clean_name, kind.columns), f"record type {kind.type_name}")
            if not 1 <= self.record_type_index <= len(kind.columns):
                raise ValueError(f"record_type_index outside the columns of {kind.type_name}")

    def type_tokens(self) -> list[dict[str, str]]:
        return [{"sourceOffset": "", "type": t.type_name} for t in self.types]

    def read(self, spark: SparkSession, files: Files) -> list[Frame]:
        records = self._records(spark, files)
        return [Frame(self.split(records, t), tokens) for t, tokens in zip(self.types, self.type_tokens())]

    def read_once(self, spark: SparkSession, files: Files, path: str) -> list[Frame]:
        """The same frames, the files parsed once for all of them and the records staged below ``path``."""
        staged = stage_kinds(self._records(spark, files), [self._is(t) for t in self.types], path)
        return [Frame(self._named(df, t), tokens, rows=rows) for (df, rows), t, tokens in zip(staged, self.types, self.type_tokens())]

    def _records(self, spark: SparkSession, files: Files) -> DataFrame:
        width = max(len(t.columns) for t in self.types)
        names = [f"col{n}" for n in range(1, width + 1)]
        csv = Delimited(self.source_system, self.delimiter, False, self.encoding, multi_line=self.multi_line)
        if self.multi_line:
            schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
            options = {"multiLine": True, "encoding": self.encoding, **csv.options()}
            scan = files.reader(spark).schema(schema).options(**options).csv(list(files.paths))
            return _number_records(scan, has_header=False)
        lines = with_positions(text_lines(spark, files, self.encoding))
        numbered = number_rows(lines, block_table(lines))
        return csv._parse(numbered.where(~F.col("value").rlike(_BLANK)), names)

    def split(self, records: DataFrame, kind: RecordType) -> DataFrame:
        """The records of one kind, under its own column names."""
        return self._named(records.where(self._is(kind)), kind)

    def _is(self, kind: RecordType) -> Column:
        return tag_matches(F.col(f"col{self.record_type_index}"), kind.pattern)

    @staticmethod
    def _named(records: DataFrame, kind: RecordType) -> DataFrame:
        renamed = [F.col(f"col{n}").alias(name) for n, name in enumerate(kind.columns, 1)]
        return records.select(*renamed, LINE_NUMBER, SOURCE_NAME)
