"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. Three symbols in a row, letters or the gap between
words, are bound into one vector: the first letter's vector is rotated by two places, the second's by one,
and the three are multiplied. A text's vector is the sum of its trigrams' vectors, and a language's
profile the sum over all its training texts. A text has the language whose profile makes the
smallest angle with its own vector.

Training is a sum, so every task adds up its texts to one vector per language and Spark adds the
vectors; what reaches the driver is one vector per language, whatever the number of texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.frames import add_columns, col
from quayside.llm.registry import query
from quayside.llm.words import MIX_1, mix, slices

#: Length of the vectors.
DIMENSIONS = 1024
#: Profiles are broadcast: so many languages at most, of 8 KB each.
MAX_LANGUAGES = 4096
#: What a text without letters is said to be.
NONE = "und"
GAP = 0


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else the gap."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


@functools.lru_cache(maxsize=1 << 14)
def _letter_vector(point: int) -> np.ndarray:
    seeds = np.arange(DIMENSIONS // 64, dtype=np.uint64) + np.uint64((point + 1) << 20)
    bits = np.unpackbits(mix(seeds * np.uint64(MIX_1)).view(np.uint8))
    return bits.astype(np.int8) * 2 - 1


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams as rows of three symbols; of each occurrence its text and its trigram."""
    strings = ["" if t is None else t for t in texts.to_pylist()]
    points = np.frombuffer((" " + " ".join(strings) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    text_of = np.repeat(np.arange(len(strings)), [len(t) + 1 for t in strings])
    symbols = _letters()[points]
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != GAP) | (symbols[:-1] != GAP)
    keep[np.cumsum([0] + [len(t) + 1 for t in strings[:-1]])] = True
    symbols, text_of = symbols[keep], np.append(text_of, len(strings) - 1)[keep]
    inside = (text_of[2:] == text_of[:-2]) & ((symbols[2:] != GAP) | (symbols[1:-1] != GAP))
    alphabet, coded = np.unique(symbols, return_inverse=True) if len(symbols) < 4096 else _code(symbols)
    size = len(alphabet)
    codes = (coded[:-2].astype(np.int64) * size + coded[1:-1]) * size + coded[2:]
    codes, text_of = codes[inside], text_of[:-2][inside]
    if size**3 <= 1 << 22:
        used = np.zeros(size**3, bool)
        used[codes] = True
        distinct = np.flatnonzero(used)
        places = np.cumsum(used) - 1
        which = places[codes]
    else:
        distinct, which = np.unique(codes, return_inverse=True)
    rows = np.stack([alphabet[distinct // size**2], alphabet[distinct // size % size], alphabet[distinct % size]], 1)
    return rows, text_of, which


def _code(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    used = np.zeros(0x110000, bool)
    used[symbols] = True
    alphabet = np.flatnonzero(used)
    table = np.zeros(0x110000, np.int32)
    table[alphabet] = np.arange(len(alphabet))
    return alphabet, table[symbols]


def _bound(trigrams: np.ndarray) -> np.ndarray:
    """The vector of each trigram."""
    alphabet, coded = np.unique(trigrams, return_inverse=True)
    letters = np.stack([_letter_vector(int(p)) for p in alphabet]) if len(alphabet) else np.zeros((0, DIMENSIONS), np.int8)
    coded = coded.reshape(trigrams.shape)
    vectors = np.roll(letters, 2, 1)[coded[:, 0]]
    vectors *= np.roll(letters, 1, 1)[coded[:, 1]]
    vectors *= letters[coded[:, 2]]
    return vectors.astype(np.float32)


def text_vectors(texts: pa.Array) -> np.ndarray:
    """One vector per text, zero for a text without letters."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    if len(texts):
        trigrams, text_of, which = _trigrams(texts)
        vectors, n = _bound(trigrams), len(trigrams)
        step = max(1, (1 << 22) // max(n, 1))
        for low in range(0, len(texts) if n else 0, step):
            high = min(low + step, len(texts))
            a, b = np.searchsorted(text_of, [low, high])
            counts = np.bincount((text_of[a:b] - low) * n + which[a:b], minlength=(high - low) * n)
            out[low:high] = counts.reshape(high - low, n).astype(np.float32) @ vectors
    return out


@dataclass
class Profiles:
    languages: list[str]
    vectors: np.ndarray  # unit length

    def nearest(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        """The language and the cosine of each text; of equal cosines the first name's counts."""
        vectors = text_vectors(texts)
        norms = np.linalg.norm(vectors, axis=1)
        if not self.languages:
            return [NONE] * len(texts), [0.0] * len(texts)
        cosines = vectors @ self.vectors.T / np.maximum(norms, 1e-30)[:, None]
        best = cosines.argmax(1)
        found = norms > 0
        scores = np.where(found, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0).astype(float)
        return [self.languages[b] if f else NONE for b, f in zip(best, found)], scores.tolist()


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of the languages that documents are labelled with. Rows without a language are not used."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in slices(whole, "t"):
                trigrams, text_of, which = _trigrams(batch.column(0))
                names = np.array(batch.column(1).to_pylist(), object)
                vectors = _bound(trigrams)
                for name in set(names):
                    chosen = (names == name)[text_of]
                    counts = np.bincount(which[chosen], minlength=len(trigrams)).astype(np.float64)
                    sums[name] = sums.get(name, 0) + counts @ vectors
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([np.rint(v).astype(np.int64) for v in sums.values()])], ["l", "v"])

    labelled = docs.select(col(text).cast("string").alias("t"), col(lang).cast("string").alias("l")).where("l is not null")
    parts = labelled.mapInArrow(bundle, "l string, v array<bigint>")
    # in doubles, as a sum of whole numbers past 2**63 must not fail
    rows = parts.select("l", F.posexplode("v")).groupBy("l", "pos").agg(F.sum(F.col("col").cast("double")).alias("v"))
    vectors = rows.groupBy("l").agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("v")).select("l", "v.v").limit(MAX_LANGUAGES + 1).collect()
    if len(vectors) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    vectors = sorted((r for r in vectors if any(r.v)), key=lambda r: r.l)
    matrix = np.array([r.v for r in vectors], np.float64).reshape(len(vectors), DIMENSIONS)
    return Profiles([r.l for r in vectors], (matrix / np.linalg.norm(matrix, axis=1)[:, None]).astype(np.float32))


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the cosine from 0 to 1.

    A null text, an empty one and one without letters are ``und`` with score 0, and so is every text if no language was
    learned. Texts are read whole. Equal texts get equal answers; a table without rows gives none. Columns already called so
    are replaced.
    """

    def predict(texts: pa.Array) -> list[pa.Array]:
        languages, scores = profiles.nearest(texts)
        return [pa.array(languages, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(docs, text, "lang_pred string, score double", predict)


@query()
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the labelled documents that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    profiles = train(docs.where(~held_out))
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), profiles).select("doc_id", "held_out", "lang_pred", "score")
