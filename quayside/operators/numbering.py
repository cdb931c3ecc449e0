"""Line numbers and running sums without a single-task sort.

A scan assigns ``_position`` (``monotonically_increasing_id``) right above the
files, before any shuffle. Inside one file block positions are consecutive, so a
small table with the first position and row count of each block is enough to turn
positions into line numbers: one join to that table and no shuffle of the lines.

The table is joined by one number for file and block, so a block takes ``BLOCK_BYTES`` of a broadcast. A table of more than ``PART_BLOCKS`` blocks
is broadcast in parts, one join after another; the lines stay where they are. Only beyond ``MOST_PARTS`` parts, a gigabyte in all, are they shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside import LINE_NUMBER, SOURCE_NAME
from quayside.operators.lookup import lookup
from quayside.session import checkpoint

BLOCK = "_block"
POSITION = "_position"
CHUNK_BITS = 16
BLOCK_BYTES = 32
PART_BLOCKS = (64 << 20) // BLOCK_BYTES
MOST_PARTS = 16


def with_positions(scan: DataFrame) -> DataFrame:
    """Add file, block and position. ``scan`` must be a bare file scan."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_NAME),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(POSITION),
    )


def block_table(positions: DataFrame, first_row: Column | None = None) -> DataFrame:
    """One row per file block: first position, rows before it in the file.

    ``first_row`` is a numeric expression kept for the first row of each block.
    The table is checkpointed, since it is read again by every later scan.
    """
    measures = [F.min(POSITION).alias("_first"), F.count(F.lit(1)).alias("_rows")]
    if first_row is not None:
        measures.append(F.min_by(first_row, POSITION).alias("_first_row"))
    blocks = positions.groupBy(SOURCE_NAME, BLOCK).agg(*measures)
    earlier = Window.partitionBy(SOURCE_NAME).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return checkpoint(blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))))


def _with_blocks(positions: DataFrame, blocks: DataFrame, part_blocks: int) -> DataFrame:
    """Add what the table says of each row's block."""
    key = F.xxhash64(SOURCE_NAME, BLOCK)
    table = blocks.select(SOURCE_NAME, BLOCK, "_first", "_before", key.alias("_key"))
    size = table.agg(F.count(F.lit(1)).alias("blocks"), F.count_distinct("_key").alias("keys")).first()
    parts = -(-size["blocks"] // part_blocks)
    if parts > MOST_PARTS or size["keys"] < size["blocks"]:
        return lookup(positions, table.drop("_key"), [SOURCE_NAME, BLOCK], salt=F.col(POSITION))
    joined, found = positions.withColumn("_key", key), [F.lit(None).cast("struct<_first:bigint,_before:bigint>")]
    for part in range(parts):
        these = table.where(F.pmod("_key", F.lit(parts)) == part).select("_key", F.struct("_first", "_before").alias(f"_part_{part}"))
        joined = joined.join(F.broadcast(these), "_key", "left")
        found.append(F.col(f"_part_{part}"))
    block = F.coalesce(*found)
    return joined.withColumn("_first", block["_first"]).withColumn("_before", block["_before"])


def number_rows(positions: DataFrame, blocks: DataFrame, offset: int = 0, part_blocks: int = PART_BLOCKS) -> DataFrame:
    """Replace block and position by the 1-based row number in the file, plus ``offset``."""
    columns = [c for c in positions.columns if c not in (BLOCK, POSITION)]
    joined = _with_blocks(positions, blocks, part_blocks)
    # positions only compare within one task; a changed file layout must not pass unseen
    task = F.shiftright(F.col(POSITION), 33)
    number = F.when(
        task == F.shiftright(F.col("_first"), 33),
        F.col(POSITION) - F.col("_first") + F.col("_before") + F.lit(1 + offset),
    ).otherwise(F.raise_error(F.lit("file layout changed between two scans")).cast("long"))
    return joined.select(*columns, number.alias(LINE_NUMBER))


def exclusive_running_sum(
    df: DataFrame, value: str, order: str, out: str, partition: tuple[str, ...] = (), bits: int = CHUNK_BITS
) -> DataFrame:
    """Sum of ``value`` over all rows with a smaller ``order`` (an integer column).

    Rows are cut into chunks of ``2 ** bits`` order values. A window runs inside
    each chunk, and the sum before each chunk is joined back. Chunk totals go
    through one window when there are no more of them than fit a chunk, and
    otherwise through this function again, so no task sees more than a chunk.
    """
    cut = [*partition, "_chunk"]
    chunked = df.withColumn("_chunk", F.shiftright(F.col(order).cast("long"), bits))
    totals = checkpoint(chunked.groupBy(*cut).agg(F.sum(value).alias("_total")))
    if totals.count() <= 1 << bits:
        earlier = Window.partitionBy(*partition).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        bases = totals.select(*cut, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    else:
        summed = exclusive_running_sum(totals.withColumnRenamed("_chunk", "_at"), "_total", "_at", "_base", partition, bits)
        bases = checkpoint(summed.select(*partition, F.col("_at").alias("_chunk"), "_base"))

    inside = Window.partitionBy(*cut).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    within = chunked.withColumn("_within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return lookup(within, bases, cut).select(*df.columns, (F.col("_within") + F.col("_base")).alias(out))
