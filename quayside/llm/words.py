"""Words of many texts at once, as 64-bit hashes.

Texts arrive as Arrow batches. Their bytes are hashed without a Python loop: every
byte is looked up in a table of fixed random numbers (zero for bytes between words),
multiplied by the power of its place, and summed by word. Dividing by the power of the
word's first place (multiplying by its inverse modulo 2**64) makes the sum the same wherever the
word stands. Runs of words are hashed in the same way, from the hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Odd multipliers of the byte and word polynomials, and of the final mixing.
BYTE_BASE = 0x9E3779B97F4A7C17
WORD_BASE = 0xD6E8FEB86659FD93
MIX_1 = 0xFF51AFD7ED558CCD
MIX_2 = 0xC4CEB9FE1A85EC53

MASK = (1 << 64) - 1
#: Bytes hashed at a time; a longer word or text is hashed in one go.
CHUNK = 1 << 19


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of the numbers over all bits. One number stays one number."""
    values = values ^ (values >> np.uint64(33))
    values *= np.uint64(MIX_1)
    values ^= values >> np.uint64(33)
    values *= np.uint64(MIX_2)
    values ^= values >> np.uint64(33)
    return values


class Powers:
    """Powers of an odd number modulo 2**64 and their inverses, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> Powers:
        if len(self.up) < n:
            size = 1 << max(n - 1, 1).bit_length()
            for name, number in (("up", self.base), ("down", self.inverse)):
                table = np.full(size, number, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))
        return self


BYTE_POWERS, WORD_POWERS = Powers(BYTE_BASE), Powers(WORD_BASE)


def byte_values(is_word: np.ndarray, lower: bool) -> np.ndarray:
    """A random number for each byte of a word, zero for the others."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(WORD_BASE)) | np.uint64(1)
    if lower:
        table[65:91] = table[97:123]
    return np.where(is_word, table, np.uint64(0))


def _marks(ranges: list[tuple[int, int]]) -> np.ndarray:
    marks = np.zeros(256, bool)
    for low, high in ranges:
        marks[low : high + 1] = True
    return marks


SPACED = ~_marks([(0x20, 0x20), (0x09, 0x0D)])
PLAIN = _marks([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])

#: The kinds of words: which bytes belong to them and the numbers of these.
KINDS = {
    "spaced": (SPACED, byte_values(SPACED, lower=False)),
    "spaced_lower": (SPACED, byte_values(SPACED, lower=True)),
    "plain_lower": (PLAIN, byte_values(PLAIN, lower=True)),
}


@dataclass
class Words:
    """Words of some texts: the words of text d are ``at[d]`` to ``at[d + 1]``."""

    hashes: np.ndarray  # uint64
    at: np.ndarray  # int64, one more than texts
    starts: np.ndarray  # first byte of each word in ``data``
    ends: np.ndarray
    data: np.ndarray  # uint8
    offsets: np.ndarray  # first byte of each text in ``data``, one more than texts

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the place of each text in them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words_of(texts: pa.Array, kind: str) -> Words:
    data, offsets = text_bytes(texts)
    is_word, values = KINDS[kind]
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none, data, offsets)
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = offsets[offsets < n]
    first[bounds] = inside[bounds]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.zeros(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        begin = starts[low]
        high = max(int(np.searchsorted(ends, begin + CHUNK, "right")), low + 1)
        size = int(ends[high - 1] - begin)
        powers = BYTE_POWERS.upto(size)
        part = values[data[begin : begin + size]]
        part *= powers.up[:size]
        at = starts[low:high] - begin
        hashes[low:high] = np.add.reduceat(part, at) * powers.down[at]
        low = high
    return Words(mix(hashes), np.searchsorted(starts, offsets), starts, ends, data, offsets)


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """The hash of ``length`` words from each word on; shorter by ``length - 1`` than the words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers = WORD_POWERS.upto(length)
    total = words[:n] * powers.up[length - 1]
    for i in range(1, length):
        total += words[i : i + n] * powers.up[length - 1 - i] if length - 1 - i else words[i : i + n]
    return mix(total)


def long_runs(words: np.ndarray, length: int) -> np.ndarray:
    """As ``runs``, from sums of all words up to a place: cheaper for long runs, with other hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for low in range(0, n, CHUNK):
        high = min(low + CHUNK, n)
        powers = WORD_POWERS.upto(high - low + length)
        sums = np.zeros(high - low + length, np.uint64)
        np.cumsum(words[low : high + length - 1] * powers.up[: high - low + length - 1], out=sums[1:])
        out[low:high] = (sums[length:] - sums[: high - low]) * powers.down[: high - low]
    return mix(out)


def whole_runs(at: np.ndarray, n_words: int, length: int) -> np.ndarray:
    """Which of the runs of ``length`` words stay inside one text."""
    n = max(n_words - length + 1, 0)
    inside = np.ones(n, bool)
    if n:
        for back in range(1, length):
            cut = at[1:-1] - back
            inside[cut[(cut >= 0) & (cut < n)]] = False
    return inside


def sliding_min(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each ``window`` neighbours, by doubling."""
    n = len(values) - window + 1
    if n <= 0:
        return values[:0]
    width = 1
    while 2 * width <= window:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return values[:n] if width == window else np.minimum(values[:n], values[window - width : window - width + n])


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a part have ``limit`` bytes, or are one text."""
    sizes = batch.column(column)
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(sizes), 0), np.int64)
    part = np.cumsum(lengths) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        if high > low:
            yield batch.slice(low, high - low)
