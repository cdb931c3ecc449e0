"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

A shingle is five words in a row (all words of a shorter text). As the threshold is the same for all
documents, a fingerprint grows with its document, the fingerprint of a union is the union of the
fingerprints, and the share of one fingerprint inside another estimates how much of one document
the other contains, however unequal their lengths.

The query has a floor: a text of at most ``FEW`` shingles is written with all its hashes, any other with those below the threshold. A written fingerprint begins with the
threshold below which it is complete, as a part of the hash range, and two of them are compared by their hashes below the lower one of their thresholds. So a likeness depends
on the two written fingerprints alone, and a union is complete below that threshold too.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.frames import add_columns, col
from quayside.llm.registry import query
from quayside.llm.words import runs, slices, whole_runs, words_of

SHINGLE = 5
#: The part of all shingles that is kept.
FRACTION = 0.25
#: Texts of at most so many shingles are written with all of them; a sketch of more is empty with a probability of 1e-8.
FEW = 64
#: Bits of a hash that a fingerprint holds.
BITS = 48


def sketches(texts: pa.Array, fraction: float = FRACTION) -> list[np.ndarray]:
    """The kept hashes of each text, distinct and in order."""
    words = words_of(texts, "plain_lower")
    inside = whole_runs(words.at, len(words.hashes), SHINGLE)
    keys = [runs(words.hashes, SHINGLE)[inside]]
    texts_of = [words.text_of()[: len(inside)][inside]]
    sizes = np.diff(words.at)
    for size in range(1, SHINGLE):
        short = np.flatnonzero(sizes == size)
        keys.append(runs(words.hashes, size)[words.at[short]])
        texts_of.append(short)
    key, text_of = np.concatenate(keys), np.concatenate(texts_of)
    kept = key < np.uint64(min(int(fraction * 2**64), 2**64 - 1))
    key, text_of = key[kept] >> np.uint64(64 - BITS), text_of[kept]
    order = np.lexsort((key, text_of))
    key, text_of = key[order], text_of[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text_of[1:] != text_of[:-1])
    key, text_of = key[new], text_of[new]
    return np.split(key, np.searchsorted(text_of, np.arange(1, len(texts))))


def written(sketch: np.ndarray, fraction: float) -> str:
    """A fingerprint as text: the threshold, a colon, and its hashes in order, six bytes each, in base 64, so eight characters a hash."""
    return f"{fraction:g}:" + base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def read(text: str) -> tuple[np.ndarray, float]:
    """The hashes and the threshold of a written fingerprint."""
    fraction, _, hashes = text.partition(":")
    parts = np.frombuffer(base64.b64decode(hashes), np.uint8).reshape(-1, 6)
    whole = np.zeros((len(parts), 8), np.uint8)
    whole[:, 2:] = parts
    return whole.reshape(-1).view(">u8").astype(np.uint64), float(fraction)


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """The share of the smaller fingerprint that the other contains; two empty ones are alike, an empty and another are not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def scaled(whole: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The hashes of a text, in order, that are below the threshold."""
    return whole[: np.searchsorted(whole, np.uint64(int(fraction * 2**BITS)))]


def floored(whole: np.ndarray) -> tuple[np.ndarray, float]:
    """All hashes of a text of few shingles, the scaled sketch of another, and the threshold below which they are all its hashes."""
    return (whole, 1.0) if len(whole) <= FEW else (scaled(whole), FRACTION)


def nearness(a: tuple[np.ndarray, float], b: tuple[np.ndarray, float]) -> float:
    """The overlap of two fingerprints below the lower one of their thresholds."""
    least = min(a[1], b[1])
    return overlap(scaled(a[0], least), scaled(b[0], least))


def fingerprint(docs: DataFrame, text: str = "text", fraction: float = FRACTION, to: str = "sketch") -> DataFrame:
    """Add the sketch of each text, an array of numbers in order.

    Null, empty and wordless texts have an empty sketch, and so may a text of few words, if no hash of it is below the threshold.
    Equal texts have equal sketches. A column already called ``to`` is replaced.
    """
    kind = pa.list_(pa.int64())
    return add_columns(docs, text, f"`{to}` array<bigint>", lambda texts: [pa.array([s.view(np.int64) for s in sketches(texts, fraction)], kind)])


def merge(df: DataFrame, *keys: str, sketch: str = "sketch") -> DataFrame:
    """The sketch of all documents of a group together, as rows of one hash: distinct, so copies are dropped before the shuffle."""
    return df.select(*map(col, keys), F.explode(col(sketch)).alias(sketch)).distinct()


def containment(a: Column, b: Column) -> Column:
    """How much of the document with sketch ``a`` the one with sketch ``b`` contains, null if ``a`` is empty."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0))


def _with_next(docs: DataFrame, blocks: int) -> DataFrame:
    """Documents dealt to blocks of neighbouring ids; a block ends with a copy of the first document of the next.

    Blocks are cut at quantiles of the ids, so they are about equal; the driver sees two numbers per block.
    A null id comes after all others. Rows of one id are ordered by text.
    """
    least = -(2**63)
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(least)).alias("place"))
    ids = rows.select("place")
    cuts = sorted(set(ids.approxQuantile("place", [i / blocks for i in range(1, blocks)], 1 / (4 * blocks)))) if blocks > 1 else []
    rows = _cut(rows, cuts)
    tops = {r.block: r.top for r in rows.groupBy("block").agg(F.max("place").alias("top")).collect()}
    above = dict(zip(sorted(tops), [*sorted(tops)[1:], *sorted(tops)[:1]]))
    numbers = range(len(cuts) + 1)
    top, to = _listed([tops.get(b, least) for b in numbers], "bigint"), _listed([above.get(b, 0) for b in numbers], "int")
    here = F.struct("block", F.lit(0).alias("copy"))
    both = F.array(here, F.struct(to.alias("block"), F.lit(1).alias("copy")))
    dealt = rows.withColumn("at", F.explode(F.when(F.col("place") == top, both).otherwise(F.array(here))))
    dealt = dealt.select("doc_id", "text", "place", "at.block", "at.copy")
    return dealt.repartitionById(len(cuts) + 1, F.col("block")).sortWithinPartitions("block", "copy", F.desc("place"), "text")


def _cut(rows: DataFrame, cuts: list[float]) -> DataFrame:
    """Add the block of each place: how many cuts are at or below it."""
    cutter = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="number", outputCol="bucket") if cuts else None
    if cutter is None:
        return rows.withColumn("block", F.lit(0))
    cut = cutter.transform(rows.withColumn("number", F.col("place").cast("double")))
    return cut.withColumn("block", F.col("bucket").cast("int")).drop("number", "bucket")


def _listed(values: list[int], kind: str) -> Column:
    """The value of a row's block."""
    return F.element_at(F.split(F.lit(",".join(map(str, values))), ","), F.col("block") + 1).cast(kind)


SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document beside its edited text and the next document, which is the next row."""
    last: list[tuple] = []
    for whole in batches:
        for batch in slices(whole, "text"):
            rows = last + list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("copy").to_pylist()))
            last = rows[-1:]
            texts = [t or "" for _, t, _ in rows]
            pairs = [i for i in range(len(rows) - 1) if not rows[i][2]]
            if not pairs:
                continue
            edited = [texts[i][: len(texts[i]) - len(texts[i]) // 3] + texts[i + 1][: len(texts[i]) // 3] for i in pairs]
            own, changed = ([floored(s) for s in sketches(pa.array(t, pa.large_string()), 1.0)] for t in (texts, edited))
            columns = [
                [rows[i][0] for i in pairs],
                [len(texts[i]) for i in pairs],
                [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                [written(*own[i]) for i in pairs],
                [written(*s) for s in changed],
                [nearness(own[i], s) for i, s in zip(pairs, changed)],
                [nearness(own[i], own[i + 1]) for i in pairs],
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in SCHEMA.split(", ")])


@query()
def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, and how near it is to an edited text and to the next document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _with_next(docs, blocks).mapInArrow(_compare, SCHEMA)
