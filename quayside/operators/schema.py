"""Renaming and re-typing columns through one positional cast per column.

The plan stays relational, so pruning and pushdown go through these operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import LINE_NUMBER, SOURCE_NAME
from quayside.functions.names import clean_name, quoted, require_unique

CARRIED = (LINE_NUMBER, SOURCE_NAME)


def cleaned_type(kind: T.DataType) -> T.DataType:
    """The same type with every struct field name cleaned, at any array depth."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(cleaned_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.StructType):
        fields = [T.StructField(clean_name(f.name), cleaned_type(f.dataType), f.nullable) for f in kind]
        require_unique((f.name for f in fields), kind.simpleString())
        return T.StructType(fields)
    return kind


def string_leaves(kind: T.DataType) -> T.DataType:
    """The same shape with string leaves. A map is a leaf."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(string_leaves(kind.elementType), kind.containsNull)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, string_leaves(f.dataType), f.nullable) for f in kind])
    return T.StringType()


def _recast(field: T.StructField, kind: T.DataType, name: str) -> Column:
    column = F.col(quoted(field.name))
    return (column if kind == field.dataType else column.cast(kind)).alias(name)


def clean_columns(df: DataFrame) -> DataFrame:
    """Clean every column and nested field name."""
    names = [clean_name(f.name) for f in df.schema]
    require_unique(names, "the cleaned schema")
    return df.select([_recast(f, cleaned_type(f.dataType), n) for f, n in zip(df.schema, names)])


def cast_leaves_to_string(df: DataFrame) -> DataFrame:
    """Clean names, then make every leaf a string. Carried columns keep their type."""
    cleaned = clean_columns(df)
    return cleaned.select(
        [_recast(f, f.dataType if f.name in CARRIED else string_leaves(f.dataType), f.name) for f in cleaned.schema]
    )


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the data columns new names by position; carried columns stay as they are."""
    data = [c for c in df.columns if c not in CARRIED]
    if not data:
        return df
    if len(data) != len(names):
        raise ValueError(f"{len(names)} names given for {len(data)} columns: {list(names)} for {data}")
    new = dict(zip(data, names))
    return df.toDF(*[new.get(c, c) for c in df.columns])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame | None:
    """Union of the non-empty frames; a missing column is an error."""
    kept = [f for f in frames if not f.isEmpty()]
    if not kept:
        return frames[0] if frames else None
    whole = kept[0]
    for frame in kept[1:]:
        whole = whole.unionByName(frame)
    return whole


def schema_from_fields(fields: list[dict]) -> T.StructType:
    """A declared schema from its field list; ``nullable`` may be left out of a field."""

    def complete(node):
        if isinstance(node, list):
            return [complete(n) for n in node]
        if not isinstance(node, dict):
            return node
        done = {k: complete(v) for k, v in node.items()}
        if done.get("type") == "struct":
            return done
        if done.get("type") == "array":
            return {"containsNull": True, **done}
        if done.get("type") == "map":
            return {"valueContainsNull": True, **done}
        return {"nullable": True, "metadata": {}, **done} if "name" in done else done

    return T.StructType.fromJson({"type": "struct", "fields": complete(fields)})
