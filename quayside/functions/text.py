"""Column functions on text values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what counts as a line break, and what edge trimming removes
LINE_BREAK = r"\r\n|\r|\n"
CONTROL = r"[\x00-\x1F]"
CONTROL_AND_SPACE = "".join(chr(c) for c in range(33))


def line_breaks(columns: list[Column]) -> Column:
    """Line breaks over all the given values together; nulls count as empty text."""
    whole = F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.regexp_count(whole, F.lit(LINE_BREAK)).cast("long")


def trim_controls(text: Column) -> Column:
    """Trim spaces, tabs and every other control character."""
    return F.btrim(text, F.lit(CONTROL_AND_SPACE))


def tag_matches(tag: Column, pattern: str) -> Column:
    """Record-type test: the trimmed tag contains a match of the pattern."""
    return F.trim(tag).rlike(pattern)


#: Base-36 digits worked out at a time: a remainder times 2**32 stays below 2**63.
_STEP = 5


def sha1_base36(value: Column) -> Column:
    """SHA-1 as an unsigned number in base 36: long division of five 32-bit words, five digits at a time."""
    by, word = 36**_STEP, 1 << 32
    digest = F.sha1(value.cast("binary"))
    words = F.array(*(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(5)))

    def divide(done: Column, low: Column) -> Column:
        number = done["rest"] * F.lit(word) + low
        quotient = F.concat(done["words"], F.array(F.call_function("div", number, F.lit(by))))
        return F.struct(quotient.alias("words"), (number % by).alias("rest"))

    def step(done: Column, _: Column) -> Column:
        none = F.struct(F.array().cast("array<bigint>").alias("words"), F.lit(0).cast("bigint").alias("rest"))
        return F.aggregate(
            done["words"], none, divide,
            lambda made: F.struct(made["words"].alias("words"), F.concat(F.lpad(F.conv(made["rest"].cast("string"), 10, 36), _STEP, "0"), done["text"]).alias("text")),
        )

    rounds = F.sequence(F.lit(1), F.lit(7))
    text = F.aggregate(rounds, F.struct(words.alias("words"), F.lit("").alias("text")), step)["text"]
    return F.when(value.isNotNull(), F.regexp_replace(text, "^0+(?=.)", ""))
