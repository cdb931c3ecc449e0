"""Benchmark decontamination by winnowing.

A window is a run of ``n`` words of a benchmark item; an item of fewer words is one window.
Of the hashes of all ``k`` words in a row inside a window, the least is its fingerprint.
Equal windows have equal fingerprints, so a document that holds a window of an item also holds its
fingerprint, ``k`` words wide, somewhere inside the window: no shared span of ``n`` words is missed.
Documents' fingerprints are joined with those of the items, and each hit is extended to the
left and right as far as the words agree; every stretch of ``n`` words or more is a leak.
Items of fewer than ``k`` words and up to ``n`` have one fingerprint, over their first ``k`` words
or all of them.

The fingerprint index travels to the tasks as a broadcast. Its size is measured first: items are
cut into as many parts as keep each below ``PART_BYTES`` and documents pass through
all parts, one after the other, in the same job. Nothing is shuffled, so hot sources and
repeated documents cost no more than others.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.registry import query
from quayside.llm.words import Words, runs, slices, sliding_min, whole_runs, words_of

#: Bytes of item text in one broadcast part; one item alone may be longer.
PART_BYTES = 16 << 20

HITS = "array<struct<start:bigint,end:bigint,item:string>>"


class Index:
    """Fingerprints of some items: where each one stands in which item."""

    def __init__(self, items: list[tuple[str | None, str]], n: int, k: int):
        self.n, self.k = n, k
        self.ids = [item for item, _ in items]
        words = words_of(pa.array([text for _, text in items], pa.string()), "plain_lower")
        self.words, self.at = words.hashes, words.at
        sizes = np.diff(self.at)
        chosen = _fingerprints(words, n, k)
        by_width = {k: [chosen]}
        for item in np.flatnonzero((sizes > 0) & (sizes < n)):
            width = int(min(k, sizes[item]))
            by_width.setdefault(width, []).append(self.at[item : item + 1])
        self.tables = {}
        for width, places in by_width.items():
            places = np.unique(np.concatenate(places))
            if len(places):
                keys = runs(self.words, width)[places]
                order = np.argsort(keys, kind="stable")
                self.tables[width] = (keys[order], places[order])
        self.item_of = words.text_of()


def _fingerprints(words: Words, n: int, k: int) -> np.ndarray:
    """Places of the least run of ``k`` words in each run of ``n`` words, all equal ones of a window."""
    width = n - k + 1
    keys = runs(words.hashes, k)
    least = sliding_min(keys, width)[whole_runs(words.at, len(words.hashes), n)[: max(len(keys) - width + 1, 0)]]
    if not len(least):
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(whole_runs(words.at, len(words.hashes), n))
    kept = np.zeros(len(keys), bool)
    for step in range(width):
        kept[starts + step] |= keys[starts + step] == least
    return np.flatnonzero(kept)


def _hits(words: Words, index: Index, document_prints: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(document, first word, end, item) of every maximal stretch that a document shares with an item."""
    document_of = words.text_of()
    reached: dict[tuple[int, int, int], int] = {}  # by document, item, and item word against document word: up to where they were compared
    for width, (keys, places) in index.tables.items():
        own = runs(words.hashes, width)
        if not len(own):
            continue
        candidates = document_prints if width == index.k else np.flatnonzero(whole_runs(words.at, len(words.hashes), width))
        low = np.searchsorted(keys, own[candidates], "left")
        high = np.searchsorted(keys, own[candidates], "right")
        for c in np.flatnonzero(high > low):
            here = int(candidates[c])
            document = int(document_of[here])
            first, end = int(words.at[document]), int(words.at[document + 1])
            for there in places[low[c] : high[c]]:
                item = int(index.item_of[there])
                if reached.get((document, item, here - int(there)), 0) > here:
                    continue
                left, right = _extend(words.hashes, here, first, end, index.words, int(there), int(index.at[item]), int(index.at[item + 1]))
                reached[document, item, here - int(there)] = right
                if right - left >= min(index.n, int(index.at[item + 1] - index.at[item])):
                    yield document, left - first, right - first, item


def _extend(a: np.ndarray, i: int, a_low: int, a_high: int, b: np.ndarray, j: int, b_low: int, b_high: int) -> tuple[int, int]:
    """The stretch around places i and j on which the words agree, as places in ``a``."""
    back = min(i - a_low, j - b_low)
    differ = np.flatnonzero(a[i - back : i] != b[j - back : j])
    left = i - back + (int(differ[-1]) + 1 if len(differ) else 0)
    ahead = min(a_high - i, b_high - j)
    differ = np.flatnonzero(a[i : i + ahead] != b[j : j + ahead])
    return left, i + (int(differ[0]) if len(differ) else ahead)


def _search(index: Index, text: str, hits: str, count: str):
    """A step that adds what the index finds in each text to its hits."""
    short = any(0 < size < index.n for size in np.diff(index.at))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                words = words_of(batch.column(text), "plain_lower")
                if short:  # an item shorter than n can stand anywhere, not only at a fingerprint of n words
                    prints = np.flatnonzero(whole_runs(words.at, len(words.hashes), index.k))
                else:
                    prints = _fingerprints(words, index.n, index.k)
                found: dict[int, set] = {}
                for document, left, right, item in _hits(words, index, prints):
                    found.setdefault(document, set()).add((left, right, index.ids[item]))
                place = batch.schema.get_field_index(hits)
                before = batch.column(place).to_pylist() if found else None
                column = batch.column(place)
                if found:
                    for document, spans in found.items():
                        before[document] = (before[document] or []) + [
                            {"start": s, "end": e, "item": i} for s, e, i in sorted(spans, key=lambda x: (x[0], x[1], x[2] or ""))
                        ]
                    column = pa.array(before, batch.schema.field(place).type)
                batch = batch.set_column(place, batch.schema.field(place), column)
                place = batch.schema.get_field_index(count)
                yield batch.set_column(place, batch.schema.field(place), pa.array(np.diff(words.at), pa.int64()))

    return step


def find_leaks(
    docs: DataFrame, items: DataFrame, n: int = 10, k: int = 5, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    hits: str = "leaks", count: str = "n_words", part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Add to each document its stretches of words that agree with an item, and its number of words.

    A hit has the first word, the word after the last, and the item id as text. Hits of a document may overlap;
    each is the whole stretch on which document and item agree, ``n`` words at least (all words of a shorter item).
    A null or empty text has no words and no hits; an item without words has no window. Repeated documents and items are
    each treated alike; an item without an id is found with a null id. Documents keep all their
    columns; a column that has the name of a new one is replaced.
    """
    columns = [c for c in docs.columns if c not in (hits, count)]
    inner = {c: f"c{i}" for i, c in enumerate(columns)}
    out = docs.select(*(F.col(_quoted(c)).alias(inner[c]) for c in columns), F.lit(None).cast(HITS).alias("hits"), F.lit(0).cast("bigint").alias("words"))
    chosen = items.select(F.col(_quoted(item_id)).cast("string").alias("id"), F.col(_quoted(item_text)).cast("string").alias("t")).where("t is not null")
    size = chosen.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(1, math.ceil(size / part_bytes))
    for part in range(parts):
        rows = chosen.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == part).collect()
        out = out.mapInArrow(_search(Index([(r.id, r.t) for r in rows], n, k), inner[text], "hits", "words"), out.schema)
    return out.select(*(F.col(inner[c]).alias(c) for c in columns), F.coalesce("hits", F.array().cast(HITS)).alias(hits), F.col("words").alias(count))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words inside hits and items of a document."""
    for batch in batches:
        n_hit, n_items, digests = [], [], []
        for spans in batch.column("leaks").to_pylist():
            covered, end = 0, 0
            for low, high in sorted((s["start"], s["end"]) for s in spans):
                covered += max(0, high - max(low, end))
                end = max(end, high)
            ids = sorted({s["item"] for s in spans if s["item"] is not None})
            n_hit.append(covered)
            n_items.append(len(ids))
            digests.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digests, pa.string()), pa.array([h > 0 for h in n_hit], pa.bool_())],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


ORACLE = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), b as (
  select cast(item_id as varchar) as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
  select distinct id, least(10, len(w)) as n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') as x
  from (select id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as s from b where len(w) > 0)
), places as (
  select r, s, n, array_to_string(w[s:s + n - 1], ' ') as x
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as s from d, (select distinct n from windows) where len(w) >= n)
), found as (
  select r, s, p.n, id from places p join windows v on p.n = v.n and p.x = v.x
), hit as (
  select r, count(distinct place) as n_hit from (select r, unnest(range(s, s + n)) as place from found) group by r
), named as (
  select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, id from found) group by r
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join named using (r)
"""


@query(ORACLE)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that stand in a window of ten words of a benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_leaks(docs, items).select("doc_id", "n_words", "leaks")
    schema = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    return found.mapInArrow(_digest, T.StructType.fromDDL(schema))
