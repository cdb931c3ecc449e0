"""Adding columns that a function of Arrow arrays computes, whatever the other columns are called."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.words import slices


def col(name: str) -> Column:
    """A column by its whole name, dots and back ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def add_columns(df: DataFrame, text: str, new: str, function: Callable[[pa.Array], Sequence[pa.Array]]) -> DataFrame:
    """Add the columns of the DDL ``new``, which ``function`` computes from texts, a few megabytes at a time.

    Columns that have the name of a new one are replaced; others pass through.
    """
    added = T.StructType.fromDDL(new)
    kept = [c for c in df.columns if c not in added.names]
    place = kept.index(text)
    schema = T.StructType(
        [T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(kept)] + [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(added)]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, f"c{place}"):
                yield pa.RecordBatch.from_arrays([*batch.columns, *function(batch.column(place))], schema.names)

    out = df.select(*(col(c).alias(f"c{i}") for i, c in enumerate(kept))).mapInArrow(step, schema)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), *(F.col(f"n{i}").alias(c) for i, c in enumerate(added.names)))
