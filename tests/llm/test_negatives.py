"""Hard negatives by blocks in Hilbert order."""

import itertools

import numpy as np
from edge import texts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, grp int, segment int"


def brute(rows, positives=negatives.POSITIVES, keep=negatives.NEGATIVES):
    """Rows of (id, vector, label), all of the same length or filled with zeros: every anchor against every row."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    dims = max((len(r[1]) for r in rows), default=0)
    q = np.zeros((len(rows), dims), np.int64)
    for n, r in enumerate(rows):
        q[n, : len(r[1])] = np.floor(256 * np.asarray(np.float32(r[1]), np.float64))
    out = []
    for a, (i, _, label) in enumerate(rows):
        if i is None or i % 50:
            continue
        scores = q @ q[a]
        order = sorted((n for n in range(len(rows)) if rows[n][0] != i), key=lambda n: (-scores[n], rows[n][0] is None, rows[n][0]))
        for p in [n for n in order if rows[n][2] == label][:positives]:
            fits = [n for n in order if rows[n][2] != label and 50 * scores[p] <= 100 * scores[n] <= 95 * scores[p]]
            out += [(i, rows[p][0], r, rows[n][0], int(scores[p]), int(scores[n])) for r, n in enumerate(fits[:keep], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **sizes):
    frame = spark.createDataFrame([(*r, "clash", n, n) for n, r in enumerate(rows)], SCHEMA)
    return texts(negatives.hard_negatives(frame, "vec_id % 50 = 0", **sizes), "*")


@settings(max_examples=10, deadline=None)
@given(st.integers(2, 4), st.integers(1, 4))
def test_the_curve_goes_from_neighbour_to_neighbour(dims, bits):
    if dims * bits > 12:
        return
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [k.tobytes() for k in negatives.hilbert(cells, bits)]
    walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert len(set(keys)) == len(cells)
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000))
def test_scores_are_between_their_bounds(seed):
    rng = np.random.default_rng(seed)
    anchors, rows = rng.integers(-9, 9, (4, 6)), rng.integers(-9, 9, (20, 6))
    low, high = negatives.score_bounds(anchors, rows.min(0)[None], rows.max(0)[None])
    scores = anchors @ rows.T
    assert (low <= scores).all() and (scores <= high).all()


def clustered(n, seed=1, dims=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (12, dims))
    return [(int(i), [float(x) for x in np.float32(centres[i % 12] + rng.normal(0, 0.05, dims))], int(i % 12 % 4)) for i in rng.permutation(n)]


def test_small_blocks_give_what_all_rows_give(spark):
    rows = clustered(700)
    got = mined(spark, rows, segment_rows=100, block_rows=16)
    assert got == brute(rows) and len(got) > 50


def test_blocks_out_of_reach_are_not_read(spark, tmp_path, monkeypatch):
    rows = [(i, v, l) for i, v, l in clustered(2000)]
    read = []
    choose = negatives._choose

    def counted(index, groups, same):
        chosen = choose(index, groups, same)
        read.append((chosen.agg(F.sum(F.size("chosen"))).first()[0] or 0, groups.count() * index.zones.count()))
        return chosen

    monkeypatch.setattr(negatives, "_choose", counted)
    assert mined(spark, rows, segment_rows=250, block_rows=16) == brute(rows)
    assert len(read) == 2 and all(some < 0.8 * every for some, every in read)


def test_copies_and_ties(spark):
    """A third of the rows are copies with all labels, so their scores tie."""
    rows = clustered(300)
    rows += [(1000 + n, [0.5] * 8, n % 3) for n in range(150)] + [(2000 + n, [0.45] * 8, n % 3) for n in range(30)]
    assert mined(spark, rows, segment_rows=60, block_rows=16) == brute(rows)


def test_every_case(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (50, None, 1), (100, [1.0, None], 1), (150, [nan, 1.0], 1), (200, [inf, 1.0], 2), (250, [1.0, 1.0], None),
        (300, [], 1), (350, [0.0, 0.0], 2), (1, [1.0], 1), (2, [0.7, 0.2, 0.1], 2), (3, [0.6, 0.3], 2), (4, [0.6, 0.3], 3), (None, [0.6, 0.3], 2),
        (None, [0.9, 0.4], 1), (None, [0.6, 0.3], 2), (5, [-1.0, -1.0], 1), (6, [0.6, 0.3], 2), (7, [0.65, 0.3], 2), (7, [0.65, 0.3], 2), (-50, [0.8, 0.8], 3),
    ]
    got = mined(spark, rows)
    assert got == brute(rows) and any(None in r for r in got)


def test_repeated_anchors_and_lone_labels(spark):
    rows = [(50, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.8, 0.0], 2), (100, [1.0, 1.0], 7)]
    assert mined(spark, rows) == brute(rows) == [(50, 1, 1, 2, 256 * 256, 256 * 204)] * 2


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, None, 1)]) == []
    assert mined(spark, [(1, [1.0], 1)]) == []


def test_large_components_are_refused(spark):
    try:
        mined(spark, [(0, [1e12], 1)])
    except ValueError as error:
        assert "too large" in str(error)
    else:
        raise AssertionError
