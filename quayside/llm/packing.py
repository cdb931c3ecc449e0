"""Best-fit packing by linear grouping.

Documents become token ids; only those longer than a sequence are cut. What remains to be packed is a number of
pieces of each length below the sequence length, so the plan is made from a histogram of at most that many
numbers, however many documents there are:

1. Pieces longer than a given part of a sequence are put in order of length and cut into groups of equal
   numbers; in the plan each has the length of the longest of its group.
2. For these few lengths the cheapest mix of configurations (which lengths share a sequence) is the solution of a
   linear program. Configurations are generated as they are needed: the best new one for the
   present prices is a knapsack.
3. Whole numbers of each configuration are filled with actual pieces of the groups. A piece is no longer than its group says,
   so every configuration fits, mostly with room to spare.
4. The other pieces, longest first, go where they leave the least room: into the rest of any sequence, or a new one.

What counts as large decides how much room the groups' rounding costs and how much the small pieces can fill, so a
plan is made for each part in ``SMALL`` and the one with the fewest sequences is used.

Spark counts the pieces, and numbers those of each length: each task numbers its own while it makes them, and sums
over tasks give each task its first number. The plan says which numbers of which length go where.
"""

from __future__ import annotations

import bisect
import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.llm.frames import col
from quayside.llm.registry import query
from quayside.llm.words import slices
from quayside.session import scratch_path

LENGTH = 2048
#: Groups that the large pieces are cut into.
GROUPS = 32
#: Pieces of up to this part of a sequence are small: the parts that are tried.
SMALL = (1 / 8, 1 / 4, 1 / 3, 1 / 2)
#: Words whose ids a task keeps at a time, twice.
KEPT_WORDS = 300_000
#: Letters of western Europe, and marks after them, which never share a token with letters.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*|]*)")


class Tokens(dict):
    """Ids of words as bytes, unsigned 32-bit and little-endian; a word is encoded when it is first met.

    Words met since the last clearing, and those of the time before, are kept; so memory is bounded and common words stay.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.old = Tokenizer.from_file(file), {}
        self.symbols: dict[str, str] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of letters in a row. What comes before the merges is done letter by letter and remembered: they are in composed form
        and not split, and each has one lower case."""
        for letter in set(word) - self.symbols.keys():
            (symbol, _), = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(letter))
            self.symbols[letter] = symbol
        merged = self.tokenizer.model.tokenize("".join(map(self.symbols.__getitem__, word)))
        return np.array([token.id for token in merged], "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KEPT_WORDS:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(word)
        if ids is None:
            plain = PLAIN.fullmatch(word)
            if plain is None:
                ids = self.encode(word)
            elif plain[2]:
                ids = self[plain[1]] + self[plain[2]]
            else:
                ids = self._letters(word)
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        """Ids of a text. White space ends a token and leaves none, so a text's ids are those of its words.

        Python counts four control characters as white space that the tokenizer does not, and
        names of special tokens count as tokens only where nothing stands between their parts: such texts are encoded whole.
        """
        if "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.encode(text)
        return b"".join(map(self.__getitem__, text.split()))


@functools.lru_cache(1)
def _tokens(file: str) -> Tokens:
    """One for all tasks of a worker."""
    return Tokens(file)


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", end: int = 0) -> DataFrame:
    """The pieces of each document: its ids and ``end``, cut at every ``length``.

    Returns doc_id, piece (from 0), start, length, ids_crc32, and part and number: the piece is the ``number``-th of its length in task
    ``part``. A null or empty text is the end id alone. Repeated rows are packed each.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = _tokens(tokenizer), TaskContext.get().partitionId()
        counted: Counter[int] = Counter()
        last = np.array([end], "<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, "t"):
                row_of, rows = [], []
                for row, value in enumerate(batch.column(1).to_pylist()):
                    ids = tokens.of(value or "") + last
                    for piece, low in enumerate(range(0, len(ids), 4 * length)):
                        own = ids[low : low + 4 * length]
                        size = len(own) // 4
                        row_of.append(row)
                        rows.append((piece, low // 4, size, zlib.crc32(own), part, counted[size]))
                        counted[size] += 1
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()])]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row_of)), *columns], names)

    rows = docs.select(col(doc_id).alias("d"), col(text).cast("string").alias("t"))
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, number bigint")


# -- the plan


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size make the greatest value within the capacity."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    ordered, worth = sizes[order], values[order]
    for room in range(1, capacity + 1):
        fit = int(np.searchsorted(ordered, room, "right"))
        best[room] = best[room - 1]
        if fit:
            totals = best[room - ordered[:fit]] + worth[:fit]
            top = int(totals.argmax())
            if totals[top] > best[room] + 1e-12:
                best[room], choice[room] = totals[top], order[top]
    chosen, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            chosen[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return chosen


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often to use each so that the demand is met with the fewest sequences: a linear program.

    The simplex method with generated columns. It ends when no configuration is worth more than a sequence.
    """
    k = len(sizes)
    columns = [np.eye(k, dtype=np.int64)[i] * (capacity // int(sizes[i])) for i in range(k)]
    inverse = np.diag([1 / c[i] for i, c in enumerate(columns)])
    amounts = inverse @ demand
    for _ in range(rounds):
        prices = inverse.sum(0)
        new = _knapsack(sizes, prices, capacity)
        if prices @ new <= 1 + 1e-9:
            break
        direction = inverse @ new
        positive = np.flatnonzero(direction > 1e-9)
        leaving = positive[np.argmin(np.maximum(amounts[positive], 0) / direction[positive])]
        columns[leaving] = new
        pivot = inverse[leaving] / direction[leaving]
        inverse -= np.outer(direction, pivot)
        inverse[leaving] = pivot
        amounts = inverse @ demand
    return [(c, float(a)) for c, a in zip(columns, amounts) if a > 0]


def plan(counts: dict[int, int], capacity: int = LENGTH, groups: int = GROUPS, parts: Sequence[float] = SMALL) -> list[tuple[int, list[int]]]:
    """Sequences to make, as (how many, lengths of the pieces in each), from the number of pieces of each length."""
    return min((_plan(counts, capacity, groups, small) for small in parts), key=lambda made: sum(n for n, _ in made))


def _plan(counts: dict[int, int], capacity: int, groups: int, small: float) -> list[tuple[int, list[int]]]:
    left = {size: n for size, n in counts.items() if n > 0}
    made: list[tuple[int, list[int]]] = []
    if capacity in left:
        made.append((left.pop(capacity), [capacity]))
    large = sorted((s for s in left if s > small * capacity), reverse=True)
    total = sum(left[s] for s in large)
    open_bins: list[tuple[int, list[int]]] = []
    if total >= groups:
        edges = [total * g // groups for g in range(groups + 1)]
        # each group: its longest length, and its pieces as (length, number), longest first
        contents: list[list[list[int]]] = [[] for _ in range(groups)]
        place = 0
        for size in large:
            n = left[size]
            while n:
                g = bisect.bisect_right(edges, place) - 1
                take = min(n, edges[g + 1] - place)
                contents[g].append([size, take])
                place, n = place + take, n - take
        sizes = np.array([c[0][0] for c in contents])
        demand = np.diff(edges)
        for configuration, amount in sorted(configurations(sizes, demand.astype(float), capacity), key=lambda x: -x[1]):
            open_bins += _substitute(configuration, int(amount + 1e-6), contents, left)
    return made + _best_fit(open_bins, left, capacity)


def _substitute(configuration: np.ndarray, times: int, contents: list[list[list[int]]], left: dict[int, int]) -> list[tuple[int, list[int]]]:
    """Fill a configuration with actual pieces, as many times as the groups have them."""
    slots = [g for g in np.flatnonzero(configuration) for _ in range(int(configuration[g]))]
    for g in set(slots):
        times = min(times, sum(n for _, n in contents[g]) // int(configuration[g]))
    made = []
    while times > 0:
        # a slot takes from the long end of its group, the next from the short end, so that rooms differ less
        taken = [contents[g][0] if i % 2 == 0 else contents[g][-1] for i, g in enumerate(slots)]
        uses = Counter(map(id, taken))
        n = min([times, *(entry[1] // uses[id(entry)] for entry in taken)])
        if n == 0:  # a length with fewer pieces than slots that want it
            n, taken = 1, []
            for g in slots:
                entry = contents[g][0]
                taken.append(entry[:])
                entry[1] -= 1
                if not entry[1]:
                    contents[g].pop(0)
        else:
            for entry in taken:
                entry[1] -= n
            for g in set(slots):
                contents[g] = [e for e in contents[g] if e[1]]
        made.append((n, [e[0] for e in taken]))
        for size in made[-1][1]:
            left[size] -= n
        times -= n
    return made


def _best_fit(open_bins: list[tuple[int, list[int]]], left: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Put the pieces that are left, longest first, where they leave the least room."""
    by_room: dict[int, list[tuple[int, list[int]]]] = {}
    for n, sizes in open_bins:
        by_room.setdefault(capacity - sum(sizes), []).append((n, sizes))
    rooms = sorted(by_room)
    for size in sorted((s for s in left if left[s] > 0), reverse=True):
        n = left[size]
        while n:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                bins, sizes = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
                fit = max(1, min(n // bins, room // size))  # pieces of this length for each of these sequences
            else:
                fit = min(n, capacity // size)
                bins, sizes, room = n // fit, [], capacity
            used = min(bins, n // fit)
            for b, s, r in ((used, sizes + [size] * fit, room - size * fit), (bins - used, sizes, room)):
                if b:
                    if r not in by_room:
                        by_room[r] = []
                        bisect.insort(rooms, r)
                    by_room[r].append((b, s))
            n -= used * fit
    return [entry for entries in by_room.values() for entry in entries]


class Places:
    """Where the pieces of each length go: for runs of their numbers, the sequences and the place inside."""

    def __init__(self, made: list[tuple[int, list[int]]]):
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        given: Counter[int] = Counter()
        first = 0
        for n, sizes in made:
            at = 0
            for size, times in sorted(Counter(sizes).items(), reverse=True):
                runs.setdefault(size, []).append((given[size], first, at, times))
                given[size] += n * times
                at += size * times
            first += n
        self.sequences = first
        self.runs = {size: np.array(rows, np.int64).T for size, rows in runs.items()}

    def of(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            low, first, at, times = self.runs[int(length)]
            run = np.searchsorted(low, numbers[rows], "right") - 1
            inside = numbers[rows] - low[run]
            sequence[rows] = first[run] + inside // times[run]
            offset[rows] = at[run] + inside % times[run] * length
        return sequence, offset


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack documents into sequences of at most ``length`` tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Pieces fill a sequence from 0 without gaps. An
    empty table gives no rows. Pieces, a few numbers each, are written to the shared folder once, as they are counted first and placed
    then.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    pieces(docs, tokenizer, length, doc_id, text).write.parquet(path)
    made = spark.read.parquet(path)
    by_part = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(counts, length))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    firsts = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.of(np.asarray(batch.column("length")), np.asarray(batch.column("number")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:5]), pa.array(sequence), pa.array(offset)], names)

    kind = made.schema["doc_id"].dataType.simpleString()
    numbered = made.join(firsts, ["part", "length"]).select(*names[:5], (F.col("first") + F.col("number")).alias("number"))
    return numbered.mapInArrow(place, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


@query()
def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
