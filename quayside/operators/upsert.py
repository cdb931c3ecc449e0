"""Merging a batch of updates into an existing table by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import SNAPSHOT, SOURCE_NAME
from quayside.functions.names import quoted


def merge_by_key(
    existing: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    delete_unmatched: bool = False,
    evolve: bool = True,
) -> DataFrame:
    """The table after the merge.

    A matched row takes the update unless its own snapshot is newer; an unmatched
    update is inserted; an unmatched existing row stays, or goes with
    ``delete_unmatched``. Null keys match nothing. Repeated update keys fail the
    query when they match an existing row. With ``evolve``, columns only in the
    updates are added; columns only in the table keep their value.

    Existing rows are joined once to the updates, as the left side: updates small
    enough are broadcast and the table is not shuffled, otherwise adaptive execution
    can split hot table keys, as they lie on the outer side. Only the key columns of the table are read
    a second time, to find the updates to insert. Rows with null keys are kept out
    of both joins, so they never pile up in one task.
    """
    new_columns = [c for c in updates.columns if c not in existing.columns] if evolve else []
    out_columns = [*existing.columns, *new_columns]
    kinds = {f.name: f.dataType for f in [*updates.schema, *existing.schema]}
    complete = _all_set(keys)

    # one row per update key, so a repeated key is collapsed before the shuffle
    fields = [F.col(quoted(c)) for c in updates.columns if c in out_columns]
    by_key = updates.where(complete).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), F.first(F.struct(*fields)).alias("_update")
    )
    keyed = existing.where(complete)
    joined = keyed.join(by_key, list(keys), "inner" if delete_unmatched else "left")
    clash = F.concat(F.lit("several updates for existing key "), F.to_json(F.struct(*keys)))
    joined = joined.where(
        F.when(F.col("_copies") > 1, F.raise_error(clash).cast("boolean")).otherwise(F.lit(True))
    )

    replace = F.col("_update").isNotNull() & (F.col(quoted(SNAPSHOT)) <= F.col("_update")[SNAPSHOT])

    def merged(name: str) -> Column:
        kept = F.col(quoted(name)) if name in existing.columns else F.lit(None).cast(kinds[name])
        if name not in updates.columns:
            return kept.alias(name)
        return F.when(replace, F.col("_update")[name].cast(kinds[name])).otherwise(kept).alias(name)

    parts = [joined.select([merged(c) for c in out_columns])]

    known = keyed.select(*keys).join(by_key.select(*keys), list(keys), "left_semi").distinct()
    inserted = updates.where(complete).join(known, list(keys), "left_anti")
    parts += [inserted, updates.where(~complete)]
    if not delete_unmatched:
        parts.append(existing.where(~complete))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(_shaped(part, out_columns, kinds))
    return whole


def latest_per_key(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of several files in one batch, keep each key's rows from the newest file only."""
    complete = _all_set(keys)
    newest = updates.where(complete).groupBy(*keys).agg(
        F.max(F.struct(SNAPSHOT, SOURCE_NAME)).alias("_newest")
    )
    kept = (
        updates.where(complete)
        .join(newest, list(keys))
        .where((F.col(SNAPSHOT) == F.col("_newest")[SNAPSHOT]) & (F.col(SOURCE_NAME) == F.col("_newest")[SOURCE_NAME]))
    )
    return kept.select(*updates.columns).unionByName(updates.where(~complete))


def _all_set(keys: Sequence[str]) -> Column:
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(quoted(key)).isNotNull()
    return complete


def _shaped(df: DataFrame, names: Sequence[str], kinds: dict) -> DataFrame:
    return df.select(
        [
            (F.col(quoted(n)) if n in df.columns else F.lit(None)).cast(kinds[n]).alias(n)
            for n in names
        ]
    )
