"""Language-model scores from a probabilistic suffix tree.

A text is a row of words and an end. A state of the tree is a context, the last few words before a word. A
context is retained if it is frequent and its distribution of next words diverges from that of the context without its first word:
by the likelihood that it gains, for each next word that it stores. So contexts vary in length. Each state's distribution is smoothed by that of
the next shorter retained context, down to the distribution of words alone, and a word is scored by the longest context
that is retained.

Trees grow level by level: a run of words can only be frequent if both shorter runs in it are, so each level counts only such
runs. What is frequent does not depend on the size of the corpus. Runs are known by hashes, made from those of the two shorter runs in them, and all of them, their
counts and states are tables that are grouped and joined by Spark.

The logarithm of a word's probability is a sum: that of the distribution of words, of each retained context what it leaves to the
shorter one, and of each stored run what it gains over that. So a run has one value, whatever stands before it, and a text's score is the
sum of the values of all runs in it.

What is broadcast has a greatest size and changes no result: ``HOT_WORDS`` words and ``HOT_RUNS`` values of runs at most, the most frequent, and bitmaps. All other
words and runs stay in tables that grow with the corpus and are joined; as the frequent ones are not among these, no key of the joins is hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.bitmap import among, bitmap
from quayside.llm.buckets import discard, written
from quayside.llm.frames import col
from quayside.llm.registry import query
from quayside.llm.words import MIX_1, mix, slices, words_of

#: The longest context, in words.
DEPTH = 3
#: Times that a run of words must occur to be stored.
LEAST = 2
#: What a context must gain over the shorter one, in nats per next word that is stored.
GAIN = 3.0
#: Taken off each stored count, for words that never followed.
DISCOUNT = 0.75
#: Words, and values of runs, that are broadcast.
HOT_WORDS = 400_000
HOT_RUNS = 1 << 21
#: Different words that a task counts before it hands them on.
COUNTED = 400_000
#: The hash of a text's end.
END = np.uint64(0x8F14E45FCEEA167A)
HIGH = np.uint64(0xFFFFFFFF00000000)


def _rows(texts: pa.Array) -> list[list[bytes]]:
    """The words of each text in order, with A to Z in lower case, and the end. White space is what bytes.split takes for it: 0x20 and
    0x09 to 0x0D."""
    rows = [(t or b"").lower().split() for t in texts.cast(pa.binary()).to_pylist()]
    for row in rows:
        row.append(b"")
    return rows


def word_counts(docs: DataFrame, text: Column, learned: Column) -> DataFrame:
    """How often each word occurs in the documents that are learned from, 0 for words only of others. The end is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            made = [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(made, ["word", "n"])

        for whole in batches:
            for batch in slices(whole, "t"):
                for words, learn in zip(_rows(batch.column("t")), batch.column("learned").to_pylist()):
                    if learn:
                        counts.update(words)
                    else:
                        for word in words:
                            if word not in counts:
                                counts[word] = 0
                    if len(counts) > COUNTED:
                        yield rows()
        yield rows()

    rows = docs.select(text.cast("string").alias("t"), F.coalesce(learned, F.lit(False)).alias("learned"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# -- the tree


def longer(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Hashes of runs, from those of the runs without their last and without their first words."""
    return mix(before * np.uint64(MIX_1) + after)


def runs_of(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of 1 to ``length`` words: the hash of the run at each place, the text that it begins in, and whether it ends there too."""
    words = words_of(texts, "spaced_lower")
    first = np.repeat(np.arange(len(texts)), np.diff(words.at) + 1)
    keys = np.insert(words.hashes, words.at[1:], END)
    for size in range(1, length + 1):
        if size > 1:
            keys = longer(keys[:-1], keys[1:])
        text_of = first[: len(keys)]
        yield keys, text_of, text_of == first[len(first) - len(keys) :]


@dataclass
class Level:
    """Stored runs of words of one length, and the states of the contexts that they begin with."""

    keys: np.ndarray  # a bitmap of the runs
    runs: DataFrame  # key, n, value, of runs that have one
    states: DataFrame  # retained contexts: key, n, value


@dataclass
class Tree:
    """The most frequent words, the longer runs, and the most frequent of these."""

    numbers: dict[bytes, int]
    counts: np.ndarray  # by word
    base: np.ndarray  # by word: logarithm to base 10
    values: np.ndarray  # by word: the same and what the word leaves as a context
    levels: list[Level] = field(default_factory=list)


def _counts(rows: DataFrame, known: np.ndarray, level: int) -> DataFrame:
    """How often runs of ``level + 1`` words occur, as rows (context, tail, n) of the hashes of the two shorter runs in them, which must be in a bitmap."""
    known = rows.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "t", 1 << 23):
                *_, (shorter, _, _), (keys, _, inside) = runs_of(batch.column("t"), level + 1)
                may = among(shorter, known.value)
                at = np.flatnonzero(inside & may[:-1] & may[1:])
                # by context and run, half of each, so that equal runs mostly meet and the shuffle packs equal contexts
                at = at[np.argsort(shorter[at] & HIGH | keys[at] >> np.uint64(32))]
                first = np.flatnonzero(np.append(True, keys[at[1:]] != keys[at[:-1]])) if len(at) else at
                n = np.diff(np.append(first, len(at)))
                at = at[first]
                made = [pa.array(shorter[at].view(np.int64)), pa.array(shorter[at + 1].view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(made, ["context", "tail", "n"])

    # rows of a run are few: one from each batch
    counted = rows.mapInArrow(count, "context bigint, tail bigint, n bigint").repartition("context", "tail")
    return counted.groupBy("context", "tail").agg(F.sum("n").alias("n"))


def _keyed(runs: DataFrame) -> DataFrame:
    """Rows (context, tail, n) with the hash of the run."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, after = (np.asarray(batch.column(c)).view(np.uint64) for c in ("context", "tail"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(longer(before, after).view(np.int64))], ["context", "tail", "n", "key"])

    return runs.mapInArrow(key, "context bigint, tail bigint, n bigint, key bigint")


def grow(docs: DataFrame, words: DataFrame, text: Column, learned: Column, depth: int = DEPTH, least: int = LEAST, gain: float = GAIN, discount: float = DISCOUNT) -> list[Level]:
    """The levels of a tree, from rows (key, n, ratio, p) of words. Each context whose distribution diverges is retained. ``discount`` is above 0."""
    rows = docs.where(learned).select(text.cast("string").alias("t"))
    known, bits, levels = words, bitmap(words, "key"), []
    n, total, parent, rest = F.col("n"), F.col("total"), F.col("parent"), F.col("rest")
    for level in range(1, depth + 1):
        # few of the runs that are counted are frequent: written, they leave the disk to the joins
        counted = written(_counts(rows, bits, level).where(n >= least), "counted")
        frequent = _keyed(counted)
        # the distribution of the shorter context, for the same last words; these joins also drop what is in the bitmap by chance
        tails = known.select(F.col("key").alias("tail"), F.col("ratio").alias("parent"), F.col("p").alias("below"))
        contexts = known.select(F.col("key").alias("context"), n.alias("total"))
        runs = written(frequent.join(tails, "tail").join(contexts, "context").select("context", "key", "n", "total", "parent", "below"), "runs")
        discard(counted)
        sums = runs.groupBy("context").agg(
            F.max("total").alias("total"),
            F.count(F.lit(1)).alias("followers"),
            F.sum("n").alias("stored"),
            F.least(F.sum("parent"), F.lit(1 - 1e-9)).alias("parent"),
            F.sum(n * F.log(n / total / parent)).alias("gains"),
            F.sum((n - discount) / total).alias("shares"),
        )
        left = total - F.col("stored")
        gains = F.col("gains") + F.when(left > 0, left * F.log(left / total / (1 - parent))).otherwise(0.0)
        states = written(sums.where(gains >= gain * F.col("followers")).select("context", total.alias("n"), (1 - F.col("shares")).alias("rest")), "states")
        p = F.when(rest.isNull(), F.col("below")).otherwise((n - discount) / total + rest * F.col("below"))
        value = F.when(rest.isNull(), 0.0).otherwise(F.log10("p") - F.log10(rest * F.col("below")))
        valued = runs.join(states.select("context", "rest"), "context", "left").withColumn("p", p)
        valued = written(valued.select("key", "n", (n / total).alias("ratio"), "p", value.alias("value")), "level")
        discard(runs)
        if level > 1:
            discard(known)
        known = valued
        if known.isEmpty():
            break
        bits = bitmap(known, "key")
        own = written(known.where("value <> 0").select("key", "n", "value"), "values")
        levels.append(Level(bits, own, states.select(F.col("context").alias("key"), "n", F.log10("rest").alias("value"))))
    if known is not words:
        discard(known)
    return levels


def _frequent(rows: DataFrame, most: int) -> Column:
    """Which of the rows with counts ``n`` are the most frequent: of whole classes, by the counts' logarithms, and ``most`` rows at most."""
    size = F.floor(F.log2(F.col("n") + F.lit(1)))
    least, number = 64, 0
    for row in sorted(rows.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"]):
        number += row["count"]
        if number > most:
            break
        least = row["size"]
    return size >= least


# -- scores


@dataclass
class Model:
    words: DataFrame  # word, n, base, value
    runs: DataFrame  # key, value; a run that is also a context has two rows
    tree: Tree
    tokens: int
    different: int
    hot: tuple[np.ndarray, np.ndarray]  # keys of the most frequent runs, in order, and their values
    others: np.ndarray  # a bitmap of the other runs


def _word_keys(words: DataFrame) -> DataFrame:
    """Rows (word, n) with the hash of the word."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "word"):
                found = words_of(batch.column("word"), "spaced_lower")
                keys = np.full(batch.num_rows, END)  # the empty word
                keys[np.diff(found.at) > 0] = found.hashes
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64))], ["word", "n", "key"])

    return words.mapInArrow(key, "word string, n bigint, key bigint")


def train(docs: DataFrame, text: str = "text", learned: Column | None = None, **options) -> Model:
    """Count words and grow a tree. ``learned`` says which documents are learned from; of the others words are listed with count 0."""
    spark = docs.sparkSession
    learned = F.lit(True) if learned is None else F.coalesce(learned, F.lit(False))
    counts = written(_word_keys(word_counts(docs, col(text), learned)), "words")
    tokens, different = counts.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    tokens = tokens or 0
    p = (F.col("n") + 1) / F.lit(float(tokens + different + 1))
    words = counts.withColumn("base", F.log10(p))
    least = options.get("least", LEAST)
    levels = grow(docs, counts.where(F.col("n") >= least).select("key", "n", p.alias("ratio"), p.alias("p")), col(text), learned, **options)
    if levels:
        left = levels[0].states.select("key", F.col("value").alias("left"))
        words = words.join(left, "key", "left").withColumn("value", F.col("base") + F.coalesce("left", F.lit(0.0))).drop("left")
    else:
        words = words.withColumn("value", F.col("base"))
    words = written(words.select("word", "n", "base", "value"), "words")
    discard(counts)
    hot = words.where(_frequent(words, HOT_WORDS)).toArrow()
    numbers = {w: i for i, w in enumerate(hot["word"].cast(pa.binary()).to_pylist())}
    tree = Tree(numbers, *(np.asarray(hot[c]) for c in ("n", "base", "value")), levels)
    valued = [x.runs for x in levels] + [x.states for x in levels[1:]]
    runs = reduce(DataFrame.unionByName, valued) if valued else spark.createDataFrame([], "key bigint, n bigint, value double")
    chosen = _frequent(runs, HOT_RUNS)
    table = runs.where(chosen).select("key", "value").toArrow()
    keys, at = np.unique(np.asarray(table["key"], dtype=np.int64).view(np.uint64), return_inverse=True)
    # a run has one count, so both of its rows are frequent or neither is
    runs = runs.where(~chosen).select("key", "value")
    return Model(words, runs, tree, tokens, different, (keys, np.bincount(at, np.asarray(table["value"], dtype=float), len(keys))), bitmap(runs, "key"))


def _run_sums(rows: DataFrame, model: Model) -> DataFrame:
    """The sum of the values of the runs of two and more words in each text, as rows (k1, runs) from rows (k1, t)."""
    known = rows.sparkSession.sparkContext.broadcast((model.hot, model.others, len(model.tree.levels)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (hot, values), others, levels = known.value
        for whole in batches:
            for batch in slices(whole, "t"):
                texts, own = batch.column("t"), np.asarray(batch.column("k1"))
                sums, keys, owners = np.zeros(len(texts)), [own], [own]
                for size, (run, text_of, inside) in enumerate(runs_of(texts, levels + 1)):
                    if not size:
                        continue
                    run, text_of = run[inside], text_of[inside]
                    if len(hot):
                        at = np.minimum(np.searchsorted(hot, run), len(hot) - 1)
                        found = hot[at] == run
                        sums += np.bincount(text_of[found], values[at[found]], len(texts))
                        run, text_of = run[~found], text_of[~found]
                    may = among(run, others)
                    keys.append(run[may].view(np.int64))
                    owners.append(own[text_of[may]])
                keys, owners = np.concatenate(keys), np.concatenate(owners)
                made = [pa.array(owners), pa.array(keys), pa.array(np.append(sums, np.zeros(len(keys) - len(sums))))]
                yield pa.RecordBatch.from_arrays(made, ["k1", "key", "sum"])

    # the sum over frequent runs has the text's own hash for a key, which spreads these rows
    parts = rows.select("k1", "t").mapInArrow(look_up, "k1 bigint, key bigint, sum double").join(model.runs, "key", "left")
    return parts.groupBy("k1").agg(F.sum(F.col("sum") + F.coalesce("value", F.lit(0.0))).alias("runs"))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add n_tokens, n_known, base_score and score to each document.

    A null or empty text has one token, its end. Words never learned count 0. Without documents to learn from every word has probability 1,
    as the base has it. Repeated rows get the same scores. Columns already called so are replaced; an
    empty table stays empty.
    """
    spark = docs.sparkSession
    new = ("n_tokens", "n_known", "base_score", "score")
    kept = [c for c in docs.columns if c not in new]
    known = spark.sparkContext.broadcast(replace(model.tree, levels=[]))
    body = F.struct(*(col(c).alias(f"c{i}") for i, c in enumerate(c for c in kept if c != text)))
    rows = docs.select(body.alias("body"), col(text).cast("string").alias("t"))
    rows = rows.select(F.xxhash64("body", "t").alias("k1"), F.xxhash64(F.lit(1), "body", "t").alias("k2"), "t")
    names = ["k1", "k2", "word", "n", "tokens", "known", "base", "tree"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = known.value
        for whole in batches:
            for batch in slices(whole, "t"):
                texts = _rows(batch.column("t"))
                sizes = np.array([len(words) + 1 for words in texts], np.int64)
                starts = np.cumsum(sizes) - sizes
                words = chain.from_iterable(chain((b"\n",), row) for row in texts)  # a line feed is no word
                ids = np.fromiter(map(tree.numbers.get, words, repeat(-1)), np.int64, int(sizes.sum()))
                hot = ids >= 0
                own = [np.where(hot, x[ids], 0) for x in (tree.counts > 0, tree.base, tree.values)] if len(tree.counts) else [np.zeros(len(ids))] * 3
                sums = [np.add.reduceat(x, starts) for x in own]
                row_of, word_of, times = list(range(len(texts))), [b" %d" % row for row in range(len(texts))], [0] * len(texts)
                for row, (start, words) in enumerate(zip(starts.tolist(), texts)):
                    other = np.flatnonzero(~hot[start + 1 : start + 1 + len(words)]).tolist()
                    if other:
                        cold = Counter(words[i] for i in other)
                        row_of += [row] * len(cold)
                        word_of += cold.keys()
                        times += cold.values()
                at, none = pa.array(row_of), np.zeros(len(row_of) - len(texts))
                columns = [np.append(x, none) for x in ([len(words) for words in texts], *sums)]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
                made = [pa.array(c.astype(np.int64) if k == pa.int64() else c.astype(float), k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column("k1").take(at), batch.column("k2").take(at), pa.array(word_of, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()), *made], names)

    parts = rows.mapInArrow(look_up, "k1 bigint, k2 bigint, word string, n bigint, tokens bigint, known bigint, base double, tree double")
    words = model.words.select("word", F.col("n").alias("count"), F.col("base").alias("word_base"), F.col("value").alias("word_value"))
    joined = parts.join(words, "word", "left")
    # rows without a word hold the sums over frequent words; a repeated row comes as often as it is there, and so does each of its parts
    same = F.sum(F.when(F.col("n") == 0, 1).otherwise(0))
    sums = joined.groupBy("k1", "k2").agg(
        F.max("tokens").alias("n_tokens"),
        ((F.sum("known") + F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0))) / same).cast("bigint").alias("n_known"),
        ((F.sum("base") + F.sum(F.coalesce(F.col("n") * F.col("word_base"), F.lit(0.0)))) / same).alias("base_score"),
        (F.sum("tree") + F.sum(F.coalesce(F.col("n") * F.col("word_value"), F.lit(0.0)))).alias("words"),
        same.alias("same"),
    )
    # the sums are few rows; each is written before the next is made, as all runs of all texts are shuffled for them
    run_sums, word_sums = written(_run_sums(rows, model), "run-sums"), written(sums, "word-sums")
    sums = word_sums.join(run_sums, "k1", "left").withColumn("score", (F.col("words") + F.coalesce("runs", F.lit(0.0))) / F.col("same"))
    keyed = docs.select(*map(col, kept)).withColumn("body of a row", body)
    keyed = keyed.withColumns({"first key": F.xxhash64("body of a row", col(text).cast("string")), "second key": F.xxhash64(F.lit(1), "body of a row", col(text).cast("string"))})
    out = keyed.join(sums, [keyed["first key"] == sums["k1"], keyed["second key"] == sums["k2"]])
    return out.select(*map(col, kept), *new)


@query()
def op9_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by word counts and by the tree, both learned from the documents that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    docs = docs.select("doc_id", held_out.alias("held_out"), "text")
    model = train(docs, learned=~F.col("held_out"))
    tokens = F.lit(model.tokens).cast("bigint").alias("train_tokens")
    return score(docs, model).select("doc_id", "held_out", "n_tokens", "n_known", tokens, "base_score", "score")
