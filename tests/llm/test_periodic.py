"""Periodic runs of words."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from edge import LONG, documents, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import periodic

SF_DIR = "/root/testdata/sf0.001"


def brute_runs(words, least=periodic.LEAST, periods=periodic.PERIODS):
    """Every period is tried on every word; a longer period inside a run of a shorter one that divides it is no smallest period."""
    numbers = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words], np.int64)
    out = []
    for q in range(1, len(w) // periods + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2], edges[1::2] + q):
            if end - start >= max(least, periods * q) and not any(a <= start and end <= a + n and q % p == 0 for a, n, p in out):
                out.append((int(start), int(end - start), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(seed):
    """Words with runs of several kinds."""
    rng, n = random.Random(seed), 0
    kind, out = seed % 5, []
    if kind == 0:
        out = [rng.randrange(2) for _ in range(200)]
    elif kind == 1:
        while len(out) < 250:
            root = [rng.randrange(3) for _ in range(rng.randrange(1, 20))]
            out += (root * 12)[: rng.randrange(1, len(root) * 8 + 2)]
    elif kind == 2:
        a, b = [0], [0, 1]
        while len(b) < 300:
            a, b = b, b + a
        out = b
    elif kind == 3:
        root = [rng.randrange(50) for _ in range(rng.randrange(1, 60))]
        out = [9, 8, *(root * 5)[: 3 * len(root) + rng.randrange(30)], 8, 9, *root]
    else:
        root = [*([rng.randrange(2) for _ in range(rng.randrange(1, 5))] * rng.randrange(1, 9)), 7]
        out = root * 6
    return out


def test_runs_are_those_of_every_period():
    for seed in range(120):
        words = np.array(some_words(seed), np.uint64)
        for least, periods in ((24, 3), (7, 3), (30, 5)):
            want = brute_runs(words.tolist(), least, periods)
            step = random.Random(seed).choice([7, 64, 1 << 16])
            # between others, whose words are the same
            assert periodic.find_runs([words[:40], words, words], least, periods, step)[1] == want


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 20))
def test_runs_do_not_depend_on_how_words_are_appended(seed, step):
    words = np.array(some_words(seed), np.uint64)
    catchers = periodic.Catchers()
    for low in range(0, len(words), step):
        catchers.append(words[low : low + step])
        # the runs of the text so far, at any time
        if low % 3 == 0:
            assert catchers.runs() == brute_runs(words[: low + step].tolist())


def test_work_and_memory_follow_a_long_text():
    catchers = periodic.Catchers()
    for _ in range(40):
        catchers.append(np.zeros(5_000, np.uint64))
    assert catchers.runs() == [(0, 200_000, 1)]
    kept = [len(s.of(s.first)) for s in catchers._suffixes[1:]]
    assert all(size <= 2 * 5_000 + (8 << level) for level, size in enumerate(kept, 1))


def expected(doc_id, text, loop=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if loop and h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (
        doc_id, len(runs), *(best[0] if best else (None,) * 3), 1000 * best[0][1] // best[0][2] if best else None,
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
        n, len(dropped),
    )


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = texts(periodic.op13_periodic(spark, SF_DIR), "*")
    assert got == sorted((expected(r.doc_id, r.text) for r in docs), key=repr)
    assert sum(r[1] > 0 for r in got) > 5


def test_every_case_has_its_rows(spark):
    loop = "a b c d e f g h " * 4
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "x " * 23), (5, "x " * 24), (6, loop), (6, loop), (None, loop), (8, "über\x0b" * 30), (9, LONG)]
    rows += [(10, "\x00   " * 20), (11, "x\x1cy " * 30)]
    got = texts(periodic.collapse_runs(documents(spark, rows)), "*")
    assert got == sorted((expected(*r, loop=False) for r in rows), key=repr)
    assert texts(periodic.collapse_runs(documents(spark, rows), loop=True), "*") == sorted((expected(*r) for r in rows), key=repr)
    assert periodic.collapse_runs(documents(spark, [])).collect() == []


def test_words_of_equal_hashes_are_told_apart():
    words = [b"a", b"b"] * 12
    by_hash = periodic.find_runs([np.zeros(24, np.uint64)])[0]
    assert by_hash == [(0, 24, 1)]
    assert periodic._describe(1, words, by_hash)[1:5] == (1, 0, 24, 2)
