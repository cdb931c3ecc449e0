"""Periodic runs of words, found by catchers over completed blocks of 2**k words.

A text is appended word after word, or many words at a time. Once a block of ``b = 2**k`` words that starts at a multiple of ``b``
is complete, its catcher waits for the block to return ``q`` words later, for the distances ``q`` of its level. Every appended word
completes one suffix of ``b`` words per level, and the suffix is compared with the blocks that wait for it. A return is the seed of squares
of period ``q``: equal words are followed back from the block and forward to the end of the text. Squares of one period that overlap are one
stretch, and a stretch that reaches the end of the text grows with the words appended later.

Levels and distances fit each other: a stretch of period ``q`` that is long enough to count holds, within its first ``length - q`` words, a whole
block of the level of ``q``, which therefore returns. So no run is lost, and each level compares each word about once: a text of
``n`` words takes ``n log n`` comparisons whatever its words are. Returns inside a stretch of a shorter period ``p``, where ``p`` is at most the block's length, have that
shorter period and are dropped.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quayside.llm.registry import query
from quayside.llm.words import WORD_BASE, mix, slices, words_of

#: A run counts from so many words on, and from so many periods on.
LEAST = 24
PERIODS = 3
#: Words appended at a time.
STEP = 1 << 16

Run = tuple[int, int, int]  # start, length, period


def block_length(period: int, least: int = LEAST, periods: int = PERIODS) -> int:
    """The block length of a period's level: the longest of which a run's words but the last period hold a whole aligned block."""
    room = max((periods - 1) * period, least - period)
    return 1 << ((room + 1) // 2).bit_length() - 1


class _Grown:
    """An array that grows at its end. Numbers before a place can be given up; the others keep their places."""

    def __init__(self) -> None:
        self.room, self.first, self.end = np.empty(64, np.uint64), 0, 0

    def add(self, values: np.ndarray) -> None:
        size = self.end - self.first
        if size + len(values) > len(self.room):
            room = np.empty(max(2 * len(self.room), size + len(values)), np.uint64)
            room[:size] = self.room[:size]
            self.room = room
        self.room[size : size + len(values)] = values
        self.end += len(values)

    def of(self, low: int, high: int | None = None) -> np.ndarray:
        """The numbers from place ``low`` on, up to ``high``."""
        high = self.end if high is None else min(high, self.end)
        return self.room[low - self.first : max(high, low) - self.first]

    def drop(self, before: int) -> None:
        if before - self.first > len(self.room) // 2:
            self.room, self.first = self.of(before).copy(), before


class Catchers:
    """The periodic stretches of a text that is appended piece by piece. A word is a number; equal words have equal numbers.

    No period is longer than one part in ``periods`` of ``longest`` words, where that is given. Besides the words, a level
    keeps what its last few blocks need.
    """

    def __init__(self, least: int = LEAST, periods: int = PERIODS, longest: int | None = None):
        if periods < 3 or least < 2 * periods:
            raise ValueError("a run has three periods at least, and room for two words a period")
        self.least, self.periods, self.longest = least, periods, longest
        self.n = 0
        self._suffixes = [_Grown()]  # by level: the hash of the 2**level words from each word on
        self._stretches: dict[int, list[list[int]]] = {}  # by period: [start, end]
        self._open: list[tuple[int, list[int]]] = []  # those that reach the end of the text

    def _plan(self) -> Iterator[tuple[int, int, int]]:
        """The levels: block length, least and greatest period."""
        period = 1
        while True:
            length = block_length(period, self.least, self.periods)
            last = period
            while last < self.least and block_length(last + 1, self.least, self.periods) == length:
                last += 1
            if last >= self.least:
                last = (4 * length - 2) // (self.periods - 1)
            yield length, period, last
            period = last + 1

    def append(self, words: np.ndarray) -> None:
        """Add words at the end of the text."""
        before = self.n
        self._suffixes[0].add(words)
        self.n = n = before + len(words)
        still = []
        for period, stretch in self._open:
            stretch[1] = self._forward(stretch[1] - period, period) + period
            if stretch[1] == n:
                still.append((period, stretch))
        self._open = still
        most = n if self.longest is None else min(n, self.longest) // self.periods
        for b, low, high in self._plan():
            if low > most or (self.longest is None and low + b > n):
                break
            self._catch(b, low, high, before)
        for level, names in enumerate(self._suffixes[1:], 1):
            names.drop(max(n - (4 << level) - 2 * self.least, 0))

    def runs(self) -> list[Run]:
        """The runs of the text so far, by start and period."""
        found = ((s, e - s, q) for q, stretches in self._stretches.items() for s, e in stretches)
        return sorted((r for r in found if r[1] >= max(self.least, self.periods * r[2])), key=lambda r: (r[0], r[2]))

    def _names(self, level: int) -> _Grown:
        """The hashes of all runs of 2**level words that are complete."""
        for step in range(len(self._suffixes), level + 1):
            self._suffixes.append(_Grown())
        for upper in range(1, level + 1):
            names, step = self._suffixes[upper], 1 << upper - 1
            if names.end + 2 * step <= self.n:
                new = self._suffixes[upper - 1].of(names.end)
                names.add(mix(new[:-step] * np.uint64(WORD_BASE) + new[step:]))
        return self._suffixes[level]

    def _catch(self, b: int, low: int, high: int, before: int) -> None:
        """Compare the blocks of one level with what ended since the text had ``before`` words, ``low`` to ``high`` words later."""
        n = self.n
        names = self._names(b.bit_length() - 1)
        first = max(before - b - high, 0) // b * b
        count, width = (n - b - low - first) // b + 1, high - low + 1
        if count <= 0:
            return
        later = names.of(first + low, first + low + (count - 1) * b + width)
        lacking = (count - 1) * b + width - len(later)
        if lacking:
            later = np.concatenate([later, np.zeros(lacking, np.uint64)])
        windows = np.lib.stride_tricks.as_strided(later, (count, width), (b * later.strides[0], later.strides[0]), writeable=False)
        row, column = np.nonzero(windows == names.of(first, first + count * b)[::b, None])
        if not len(row):
            return
        at, period = first + row * b, column + low
        ended = at + period + b
        new = (ended > before) & (ended <= n)
        at, period = at[new], period[new]
        order = np.argsort(period, kind="stable")
        at, period = self._uncovered(at[order], period[order], b, 1, low - 1)
        settled = low - 1
        while len(at):
            q = int(period[0])
            if settled < min(q - 1, b):
                at, period = self._uncovered(at, period, b, settled + 1, q - 1)
                settled = min(q - 1, b)
                continue
            size = int(np.searchsorted(period, q, "right"))
            self._follow(at[:size], q, b)
            at, period = at[size:], period[size:]

    def _uncovered(self, at: np.ndarray, period: np.ndarray, b: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """The returns that are not inside a stretch with a period from ``low`` to ``high`` that is no longer than the block."""
        known = sorted((s, e) for q, stretches in self._stretches.items() if low <= q <= min(high, b) for s, e in stretches)
        if not known:
            return at, period
        starts, ends = np.array(known, np.int64).T
        ends = np.maximum.accumulate(ends)
        place = np.searchsorted(starts, at, "right")
        out = (place == 0) | (ends[place - 1] < at + period + b)
        return at[out], period[out]

    def _follow(self, at: np.ndarray, q: int, b: int) -> None:
        """Merge the returns of blocks at ``at``, ``q`` words later, into stretches."""
        stretches = self._stretches.setdefault(q, [])
        i = 0
        while i < len(at):
            start = int(at[i])
            known = next((s for s in reversed(stretches) if s[0] <= start), None)
            if known is None or known[1] < start + q + b:
                # the hash says that the block returns, its words decide
                known = [self._back(start, q), self._forward(start, q) + q]
                if known[1] >= start + q + b:
                    stretches.append(known)
                    if known[1] == self.n:
                        self._open.append((q, known))
            i = max(i + 1, int(np.searchsorted(at, known[1] - q - b, "right")))

    def _back(self, start: int, q: int) -> int:
        """The first word from which on the words equal those q later, up to ``start``."""
        words, step = self._suffixes[0].of(0), 64
        while start:
            low = max(start - step, 0)
            differ = np.flatnonzero(words[low:start] != words[low + q : start + q])
            if len(differ):
                return low + int(differ[-1]) + 1
            start, step = low, 2 * step
        return 0

    def _forward(self, start: int, q: int) -> int:
        """The first word from ``start`` on that differs from the one q later, or has none."""
        words, step, last = self._suffixes[0].of(0), 64, self.n - q
        while start < last:
            high = min(start + step, last)
            differ = np.flatnonzero(words[start:high] != words[start + q : high + q])
            if len(differ):
                return start + int(differ[0])
            start, step = high, 2 * step
        return max(start, last)


def find_runs(texts: list[np.ndarray], least: int = LEAST, periods: int = PERIODS, step: int = STEP) -> list[list[Run]]:
    """The runs of each text, given the numbers of its words.

    Texts of about one length are appended to the same catchers, behind each other. A number that stands nowhere else ends
    each of them, and as each word of a stretch of two periods returns in it, no run holds such a number.
    """
    classes: dict[int, list[int]] = {}
    for i, words in enumerate(texts):
        if len(words) >= least:
            classes.setdefault(len(words).bit_length(), []).append(i)
    found: list[list[Run]] = [[] for _ in texts]
    for members in classes.values():
        ends = mix(np.arange(len(members), dtype=np.uint64) | np.uint64(1 << 63))
        joined = np.concatenate([part for j, i in enumerate(members) for part in (texts[i], ends[j : j + 1])])
        bounds = np.cumsum([0, *(len(texts[i]) + 1 for i in members)])
        catchers = Catchers(least, periods, int(np.diff(bounds).max()) - 1)
        for low in range(0, len(joined), step):
            catchers.append(joined[low : low + step])
        for start, length, period in catchers.runs():
            j = int(np.searchsorted(bounds, start, "right")) - 1
            found[members[j]].append((start - int(bounds[j]), length, period))
    return found


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stay: not those of a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a document that is to be looped, the number of the word that stands at each place; else None."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string, n_words bigint, n_dropped bigint"
)


def _describe(doc_id: int | None, words: list[bytes], runs: list[Run]) -> tuple:
    if any(start + length > len(words) or words[start : start + length - q] != words[start + q : start + length] for start, length, q in runs):
        # different words of equal hashes: words as numbers of a dictionary instead
        numbers: dict[bytes, int] = {}
        runs = find_runs([np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64)])[0]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    kept = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))] if runs else words
    of_best = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    hashes = (hashlib.sha256(t).hexdigest() for t in (listed.encode(), b" ".join(kept)))
    return (doc_id, len(runs), *of_best, *hashes, len(words), len(words) - len(kept))


def collapse_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", loop: bool = False) -> DataFrame:
    """Per document the runs of its words: how many, the one with most periods, and hashes of all of them and of the words that stay.

    Words are what ASCII white space separates. A run counts from ``LEAST`` words and ``PERIODS`` periods on; of runs with equally many
    periods the first is named, then the one with the shorter period. Words of a run after its first period are dropped, so a word is
    dropped if any run drops it. Null and empty texts have no words and no runs, and null ``key`` stays null. Every row is described by
    itself, repeated ones too; an empty table gives none. Of the columns only ``key`` and ``text`` are read. A text is cut nowhere: a task
    holds one long text at a time, a few dozen bytes a word. With ``loop`` the words of some documents are first made periodic (see ``looped``).
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
        for whole in batches:
            for batch in slices(whole, "text"):
                found, ids = words_of(batch.column("text"), "spaced"), batch.column("doc_id").to_pylist()
                data = found.data.tobytes()
                words = [data[a:b].split() for a, b in zip(found.offsets, found.offsets[1:])]
                hashes = np.split(found.hashes, found.at[1:-1])
                for d, doc_id in enumerate(ids if loop else []):
                    if (places := looped(doc_id, len(words[d]))) is not None:
                        words[d], hashes[d] = [words[d][i] for i in places], hashes[d][places]
                rows = map(_describe, ids, words, find_runs(hashes))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    quoted = ["`" + c.replace("`", "``") + "`" for c in (key, text)]
    return docs.selectExpr(f"cast({quoted[0]} as bigint) as doc_id", f"cast({quoted[1]} as string) as text").mapInArrow(step, SCHEMA)


@query()
def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, after one in ten is made periodic."""
    return collapse_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), loop=True)
