"""Finding the load spec, the covering request and the environment of each file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.lookup import lookup, row_bytes
from quayside.session import checkpoint


def depth_of(path: Column) -> Column:
    """Number of path segments, a leading slash counting as one empty segment."""
    return F.length(path) - F.length(F.translate(path, "/", "")) + 1


def match_prefix(
    files: DataFrame,
    table: DataFrame,
    path: str,
    prefix: str,
    values: Sequence[str],
    on: Sequence[str] = (),
    longest: bool = True,
) -> DataFrame:
    """Attach the values of the longest (or shortest) table prefix covering each path.

    Prefixes end at a segment boundary; ``on`` names further columns both sides
    must share. There is one equi-join per prefix depth present in the table, so
    files are neither exploded into ancestors nor grouped again.
    """
    known_here = table.isLocal()
    table = table.select(prefix, *[c for c in [*on, *values] if c != prefix])
    table = table if known_here else checkpoint(table)
    keys = [prefix, *on]
    facts = table.agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_distinct(F.struct(*keys)).alias("distinct"),
        F.collect_set(depth_of(F.col(prefix))).alias("depths"),
        row_bytes().alias("size"),
    ).first()
    if facts["distinct"] < facts["entries"]:
        repeated = table.groupBy(*keys).count().where("count > 1").select(*keys).take(5)
        raise ValueError(f"more than one entry for {[tuple(r) for r in repeated]}")

    found = files
    slots = []
    for depth in sorted(facts["depths"], reverse=longest):
        slot = f"_at_{depth}"
        level = table.where(depth_of(F.col(prefix)) == depth).select(
            F.col(prefix).alias("_prefix"), *on, F.struct(*values).alias(slot)
        )
        ancestor = F.when(depth_of(F.col(path)) >= depth, F.substring_index(path, "/", depth))
        found = lookup(found.withColumn("_prefix", ancestor), level, ["_prefix", *on], size=facts["size"]).drop("_prefix")
        slots.append(F.col(slot))
    if not slots:
        kinds = {f.name: f.dataType for f in table.schema}
        return files.select("*", *[F.lit(None).cast(kinds[v]).alias(v) for v in values])
    best = F.coalesce(*slots)
    return found.select(*files.columns, *[best[v].alias(v) for v in values])


def match_key(files: DataFrame, table: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Attach the values that the table holds under the whole key, null without an entry; null keys match nothing. An entry that repeats is an error."""
    facts = table.agg(F.count(F.lit(1)).alias("entries"), F.count_distinct(F.struct(*key)).alias("distinct"), row_bytes().alias("size")).first()
    if facts["distinct"] < facts["entries"]:
        repeated = table.groupBy(*key).count().where("count > 1").select(*key).take(5)
        raise ValueError(f"more than one entry for {[tuple(r) for r in repeated]}")
    return lookup(files, table.select(*key, *values), list(key), size=facts["size"])


def roll_up(requests: DataFrame) -> DataFrame:
    """Replace each requested path by the shortest requested folder that holds it.

    ``requests`` has ``path`` and ``is_folder``; duplicates collapse.
    """
    folders = requests.where("is_folder").select(F.col("path").alias("folder")).distinct()
    folders = folders.withColumn("parent", F.col("folder"))
    covered = match_prefix(requests, folders, "path", "folder", ["parent"], longest=False)
    return covered.select(F.coalesce("parent", "path").alias("path")).distinct()


def first_environment(
    path: Column, environments: Sequence[tuple[str, str]], ignore_case: bool = False
) -> Column:
    """Name of the first ``(name, text)`` whose text the path contains.

    A single environment takes everything, unless letter case is ignored (the
    arrival stream), where the account must be named in the topic.
    """
    if len(environments) == 1 and not ignore_case:
        return F.lit(environments[0][0])
    subject = F.lower(path) if ignore_case else path
    chosen = F.lit(None).cast("string")
    for name, text in reversed(environments):
        wanted = text.lower() if ignore_case else text
        chosen = F.when(F.contains(subject, F.lit(wanted)), F.lit(name)).otherwise(chosen)
    return chosen


def unresolved_severity(spec_id: Column, requested_as_file: Column) -> Column:
    """``error`` for a requested file without a spec, ``warning`` for one found in a folder."""
    return F.when(spec_id.isNull(), F.when(requested_as_file, F.lit("error")).otherwise(F.lit("warning")))
