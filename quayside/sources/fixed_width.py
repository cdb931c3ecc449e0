"""Fixed-width text: one layout per file, or several told apart by a tag."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import LINE_NUMBER, SOURCE_NAME
from quayside.functions.names import clean_name, require_unique
from quayside.functions.text import CONTROL, tag_matches, trim_controls
from quayside.operators.numbering import block_table, number_rows, with_positions
from quayside.sources.delimited import text_lines
from quayside.sources.frames import Files, Frame, stage_kinds


@dataclass(frozen=True)
class FixedColumn:
    name: str
    width: int


def cut(line: Column, columns: Sequence[FixedColumn], trim: Callable[[Column], Column]) -> list[Column]:
    """Slices of the line, left to right. What a short line lacks comes out empty."""
    start, slices = 1, []
    for column in columns:
        slices.append(trim(F.substring(line, start, column.width)).alias(column.name))
        start += column.width
    return slices


def numbered_lines(spark: SparkSession, files: Files) -> DataFrame:
    lines = with_positions(text_lines(spark, files))
    return number_rows(lines, block_table(lines))


@dataclass(frozen=True)
class FixedWidth:
    source_system: str
    columns: Sequence[FixedColumn]

    source_type = "fixedWidth"

    def __post_init__(self):
        require_unique((clean_name(c.name) for c in self.columns), f"columns of {self.source_system}")

    def type_tokens(self) -> list[dict[str, str]]:
        return [{"sourceOffset": ""}]

    def read(self, spark: SparkSession, files: Files) -> list[Frame]:
        # trimming control characters is slow, and few lines have any: look once per line
        lines = numbered_lines(spark, files).withColumn("_control", F.col("value").rlike(CONTROL))
        slices = cut(F.col("value"), self.columns, lambda c: F.when(F.col("_control"), trim_controls(c)).otherwise(F.trim(c)))
        return [Frame(lines.select(*slices, LINE_NUMBER, SOURCE_NAME), self.type_tokens()[0])]


@dataclass(frozen=True)
class FixedType:
    """A kind of line: its tag pattern, its columns, and its own tag width if different."""

    type_name: str
    pattern: str
    columns: Sequence[FixedColumn]
    tag_width: int | None = None


@dataclass(frozen=True)
class FixedWidthRecords:
    """Fixed-width lines of several kinds, told apart by a tag at a fixed place."""

    source_system: str
    tag_start: int
    tag_width: int
    types: Sequence[FixedType]

    source_type = "headerFooter"

    def __post_init__(self):
        if not self.types or any(not t.columns for t in self.types):
            raise ValueError("record types and their columns must not be empty")
        for kind in self.types:
            require_unique((clean_name(c.name) for c in kind.columns), f"record type {kind.type_name}")

    def type_tokens(self) -> list[dict[str, str]]:
        place = {"delimiterIndex": str(self.tag_start), "delimiterWidth": str(self.tag_width)}
        return [{"sourceOffset": self._offset(t), "type": t.type_name, **place} for t in self.types]

    def read(self, spark: SparkSession, files: Files) -> list[Frame]:
        lines = numbered_lines(spark, files)
        return [Frame(self.split(lines, t), tokens) for t, tokens in zip(self.types, self.type_tokens())]

    def read_once(self, spark: SparkSession, files: Files, path: str) -> list[Frame]:
        """The same frames, the files scanned once for all of them and the lines staged below ``path``."""
        lines = numbered_lines(spark, files).select("value", LINE_NUMBER, SOURCE_NAME)
        staged = stage_kinds(lines, [self._is(t) for t in self.types], path)
        return [Frame(self._cut(df, t), tokens, rows=rows) for (df, rows), t, tokens in zip(staged, self.types, self.type_tokens())]

    def split(self, lines: DataFrame, kind: FixedType) -> DataFrame:
        return self._cut(lines.where(self._is(kind)), kind)

    def _is(self, kind: FixedType) -> Column:
        return tag_matches(F.substring("value", self.tag_start, kind.tag_width or self.tag_width), kind.pattern)

    @staticmethod
    def _cut(lines: DataFrame, kind: FixedType) -> DataFrame:
        return lines.select(*cut(F.col("value"), kind.columns, F.trim), LINE_NUMBER, SOURCE_NAME)

    @staticmethod
    def _offset(kind: FixedType) -> str:
        start, parts = 1, []
        for column in kind.columns:
            parts.append(f"trim(substring(value, {start}, {column.width})) AS {column.name}")
            start += column.width
        return ", ".join(parts)
