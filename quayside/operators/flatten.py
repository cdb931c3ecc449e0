"""Opening nested columns: arrays become rows, structs become columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.names import quoted, require_unique
from quayside.operators.schema import CARRIED


@dataclass(frozen=True)
class FlattenTarget:
    column: str
    include_others: bool = True


def flatten_all(df: DataFrame) -> DataFrame:
    """Open columns until neither array nor struct is left.

    Rows with a null or empty array stay. Sibling arrays multiply, as they are
    opened one after the other.
    """
    while nested := [f for f in df.schema if _is_nested(f.dataType)]:
        for field in nested:
            df = _open(df, field, include_others=True)
    return df


def flatten_targets(df: DataFrame, targets: Sequence[FlattenTarget]) -> DataFrame:
    """Open only the named top-level columns, each down to its first plain columns."""
    for target in targets:
        if not _find(df, target.column):
            raise ValueError(f"no column {target.column!r} to flatten in {df.columns}")
        while field := _find(df, target.column):
            if not _is_nested(field.dataType):
                break
            df = _open(df, field, target.include_others)
    return df


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.StructType))


def _find(df: DataFrame, name: str) -> T.StructField | None:
    return next((f for f in df.schema if f.name.lower() == name.lower()), None)


def _open(df: DataFrame, field: T.StructField, include_others: bool) -> DataFrame:
    column = F.col(quoted(field.name))
    kept = [c for c in df.columns if c != field.name and (include_others or c in CARRIED)]
    if isinstance(field.dataType, T.ArrayType):
        return df.select(*map(quoted, kept), F.explode_outer(column).alias(field.name))
    parts = [column.getField(p).alias(f"{field.name}_{p}") for p in field.dataType.names]
    selected = []
    for name in df.columns:
        if name == field.name:
            selected += parts
        elif name in kept:
            selected.append(F.col(quoted(name)))
    opened = df.select(*selected)
    require_unique(opened.columns, f"the flattened column {field.name!r}")
    return opened
