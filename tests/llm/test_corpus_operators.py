"""Operators that compare documents with each other: lines, substrings, near duplicates, packing, scores."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edge import LONG, documents, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.llm import buckets, components, lines, neardup, packing, scoring, substrings
from quayside.session import shared_dir
from quayside.sinks import storage

WORDS = [f"{a}{b}{c}" for a in "bcdfgl" for b in "aeiou" for c in ("n", "rt", "st", "mble")]


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice(WORDS) for _ in range(n)]


# -- components


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=25))
def test_components_are_those_of_union_find(spark, links):
    parent = list(range(31))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {(x, find(x)) for a, b in links if a != b for x in (a, b)}
    want |= {(find(x), find(x)) for x, _ in want}
    made = components.components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b")
    assert {tuple(r) for r in made.collect()} == want


def test_long_chain_is_one_component(spark):
    made = components.components(spark.createDataFrame([(i, i + 1) for i in range(30)], "a bigint, b bigint"), "a", "b")
    assert {tuple(r) for r in made.collect()} == {(i, 0) for i in range(31)}


def test_every_member_meets_a_near_leader(spark):
    members = spark.createDataFrame([(b, n, n * 7) for b in (1, 2) for n in range(40)], "bucket bigint, k1 bigint, k2 bigint")
    near = lambda pairs: pairs.where("abs(k1 - l1) <= 3")
    pairs = {tuple(r) for r in buckets.near_pairs(members, near).select("k1", "l1").collect()}
    assert all(abs(a - b) <= 3 for a, b in pairs)
    linked = {frozenset(p) for p in pairs}
    group = {n: n for n in range(40)}
    for _ in range(40):
        for a, b in map(tuple, linked):
            group[a] = group[b] = min(group[a], group[b])
    assert set(group.values()) == {0}


def test_two_leaders_are_compared_once(spark):
    members = spark.createDataFrame([(1, n, n * 7) for n in range(10)], "bucket bigint, k1 bigint, k2 bigint")
    asked = []

    def near(pairs):
        asked.extend((r.k1, r.l1) for r in pairs.select("k1", "l1").collect())
        return pairs

    pairs = buckets.near_pairs(members, near, first=16)
    assert len(asked) == len({frozenset(p) for p in asked}) and {n for p in asked for n in p} == set(range(10)) == {n for r in pairs.collect() for n in (r.k1, r.l1)}


def test_rounds_leave_only_their_pairs(spark):
    """Tables that the next round has replaced are deleted."""
    members = spark.createDataFrame([(b, k, 0) for b in range(3) for k in range(b, b + 6)], "bucket bigint, k1 bigint, k2 bigint")
    before = set(storage.child_names(spark, shared_dir(spark)))
    pairs = buckets.near_pairs(members, lambda found: found.where("abs(k1 - l1) <= 1"))
    assert pairs.count()
    left = [n.split("-")[1] for n in set(storage.child_names(spark, shared_dir(spark))) - before]
    assert set(left) == {"near"}


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = buckets.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")).repartition(3), "few")
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and table.count() == 7


def test_the_origin_of_many_copies_leads_them(spark):
    """Copies are near their origin and not each other; each meets the origin in a bucket of its own, and the others in one."""
    rows = [(0, n, n) for n in range(1, 50)] + [(n, k, k) for n in range(1, 50) for k in (99, n)]
    members = spark.createDataFrame([(0, 99, 99), *rows], "bucket bigint, k1 bigint, k2 bigint")
    near = lambda pairs: pairs.where("k1 = 99 or l1 = 99")
    pairs = {frozenset(r) for r in buckets.near_pairs(members, near).select("k1", "l1").collect()}
    assert pairs == {frozenset((99, n)) for n in range(1, 50)}


# -- lines


def brute_lines(rows, similarity=lines.SIMILARITY):
    """Rows of (doc_id, text), different ids: what stays, with SimHash replaced by nothing: pairs of equal lines only."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            key = re.sub(r"[\W_]+", " ", line).strip().lower()
            if not key or key not in seen:
                kept.append(line)
            if key:
                seen.add(key)
        out[doc_id] = "\n".join(kept)
    return out


def test_repeated_lines_go(spark):
    rows = [(2, "Alpha beta!\n\ngamma\nAlpha  BETA"), (1, "gamma.\n---\nown line"), (3, "gamma\nalpha beta"), (4, ""), (5, "--\n!!"), (6, LONG)]
    docs = documents(spark, rows)
    out = lines.dedup_lines(docs)
    assert {r.doc_id: r.text for r in out.collect()} == brute_lines(rows) and out.columns == docs.columns
    assert brute_lines(rows)[3] == "" and brute_lines(rows)[5] == "--\n!!"


def test_near_lines_go(spark):
    base = prose(1, 400)
    near = [*base[:200], "changed", *base[201:]]
    far = prose(2, 400)
    rows = [(1, " ".join(base)), (2, "first\n" + " ".join(near)), (3, " ".join(far)), (4, " ".join(reversed(base)))]
    docs = documents(spark, rows)
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs, distance=5, blocks=7).collect()}
    hashes = {r.at: r.k2 for r in lines.simhash(spark.createDataFrame([(i, w) for i, (_, t) in enumerate(rows) for w in t.split("\n")[-1].split()], "at bigint, word string"), ["at"]).collect()}
    apart = lambda a, b: bin(hashes[a] ^ hashes[b]).count("1")
    assert apart(0, 3) == 0 and apart(0, 1) <= 5 < apart(0, 2)
    assert got[1] == rows[0][1] and got[2] == "first" and got[3] == rows[2][1] and got[4] == rows[3][1]


def test_tables_share_a_bucket_within_the_distance(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(63) for _ in range(40)]
    other = [x ^ sum(1 << b for b in rng.sample(range(63), n % 4)) for n, x in enumerate(base)]
    nodes = spark.createDataFrame([(n, x) for n, x in enumerate(base)] + [(n + 100, x) for n, x in enumerate(other)], "k1 bigint, k2 bigint")
    rows = lines._buckets(nodes, 3, 5)
    a, b = rows.where("k1 < 100"), rows.where("k1 >= 100").selectExpr("bucket", "k1 - 100 as k1")
    assert {r.k1 for r in a.join(b, ["bucket", "k1"]).collect()} == set(range(40))


def test_lines_of_one_simhash_are_linked_by_their_edits_alone(spark):
    """All lines have one SimHash, so they share all buckets; each is near one other line and far from the rest."""
    base = prose(1, 60)
    orders = [base, base[::-1], *(random.Random(100 + n).sample(base, 60) for n in range(20))]
    # two words that change places leave the SimHash as it is
    rows = [(10 * n, " ".join(words)) for n, words in enumerate(orders)]
    rows += [(10 * n + 1, " ".join([words[1], words[0], *words[2:]])) for n, words in enumerate(orders)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, rows)).collect()}
    assert got == {i: "" if i % 10 else t for i, t in rows}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, last + (x != y))
    return row[-1]


def test_recall_of_near_lines_is_near_one(spark):
    """Links with the production defaults against the edit similarity of all pairs, on real lines of up to 120 characters."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 2 = 0")
    found = lines._occurrences(docs, "text", "doc_id").where("char_length(line) <= 120").cache()
    texts_of = {r.k1: r.line for r in found.select("k1", "line").distinct().collect()}
    order = sorted(texts_of, key=lambda k: len(texts_of[k]))
    grams = {k: Counter(texts_of[k][i : i + 3] for i in range(len(texts_of[k]) - 2)) for k in order}
    letters = {k: Counter(texts_of[k]) for k in order}
    want = set()
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            most = int(len(texts_of[b]) * 0.2 + 1e-9)
            if len(texts_of[b]) - len(texts_of[a]) > most:
                break
            # an edit takes three runs of three letters and one letter at most
            if (letters[b] - letters[a]).total() <= most and (grams[b] - grams[a]).total() <= 3 * most and edit_distance(texts_of[a], texts_of[b]) <= most:
                want.add(frozenset((a, b)))
    nodes = lines.simhash(found.select("id", "d1", "d2", "at", "k1", F.explode(F.split("line", " ")).alias("word")), ["id", "d1", "d2", "at", "k1"]).select("k1", "k2").distinct()
    pairs = lines._links(found, nodes, lines.SIMILARITY, lines.DISTANCE, lines.BLOCKS)
    group = {r.node.split()[0]: r.component for r in components.components(pairs.selectExpr("hex(k1) as a", "hex(l1) as b"), "a", "b").collect()}
    hexed = lambda k: f"{k % 2**64:X}"
    linked = sum(len({group.get(hexed(k), hexed(k)) for k in pair}) == 1 for pair in want)
    print(len(texts_of), "lines", len(want), "near pairs", linked, "linked")
    assert len(want) >= 20 and linked >= 0.95 * len(want)


def test_one_word_of_ten_makes_no_other_line(spark):
    rows = []
    for n in range(60):
        words = prose(1000 + n, 10 + n % 30)
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join([*words[:4], "bat", *words[5:]]))]
    got = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, rows)).collect()}
    assert all(got[2 * n] == rows[2 * n][1] for n in range(60)) and sum(got[2 * n + 1] == "" for n in range(60)) >= 59


def test_only_members_of_shared_buckets_are_written(spark):
    """Tables of buckets are made a few at a time, and leave the members that meet another."""
    rows = [("one short line", 1), ("one short lines", 2), ("quite another text", 3)]
    texts_of = spark.createDataFrame(rows, "line string, k1 bigint")
    nodes = spark.createDataFrame([(1, 1 << 10), (2, 1 << 50), (3, -1 >> 1 & (1 << 62) - 1)], "k1 bigint, k2 bigint")
    parts = lines._members(texts_of, nodes, 0.8, 2, 4)
    assert len(parts) == 1 + 2 * lines.TABLES // lines.AT_ONCE
    for part in parts:
        met = Counter(r.bucket for r in part.collect())
        assert all(n > 1 for n in met.values()) and {1, 2} >= {r.k1 for r in part.select("k1").collect()} - {3}
    found = lines._links(texts_of, nodes, 0.8, 2, 4)
    assert {frozenset((r.k1, r.l1)) for r in found.collect()} == {frozenset((1, 2))}


@pytest.mark.parametrize("size", [35, 90])
def test_lines_with_changed_letters_go(spark, size):
    """One letter of ten is another one, anywhere in lines of some 150 and 400 letters."""
    rng, rows = random.Random(size), []
    for n in range(50):
        line = " ".join(prose(3000 + n, size))
        changed = list(line)
        for at in rng.sample(range(len(line)), len(line) // 10):
            changed[at] = rng.choice("jqxz")
        rows += [(2 * n, line), (2 * n + 1, "".join(changed))]
    got = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, rows)).collect()}
    assert all(got[2 * n] == rows[2 * n][1] for n in range(50)) and sum(got[2 * n + 1] == "" for n in range(50)) >= 40


def test_kept_runs_depend_on_letters_alone(spark):
    """A long line's buckets stay when letters are put before it; a short line has one for each run, and a bucket needs two lines."""
    base = " ".join(prose(1, 400))
    rows = [(1, base), (2, "x" * 30 + base), (3, "seventeen letters"), (4, "few"), (5, "ab" * 200)]
    runs = lines._kept_runs(spark.createDataFrame(rows, "k1 bigint, line string"), lines.RUN)
    found = {k: Counter(r.bucket for r in runs.where(F.col("k1") == k).collect()) for k, _ in rows}
    assert 10 < len(found[1]) < 45 and len(set(found[1]) & set(found[2])) >= len(found[1]) - 4
    assert len(found[3]) == 2 and len(found[4]) == 1 and len(found[5]) <= 2
    nodes = spark.createDataFrame([(k, 0) for k, _ in rows], "k1 bigint, k2 bigint")
    shared = lines._shared_runs(runs, nodes).collect()
    assert {r.k1 for r in shared} == {1, 2} and len(shared) == len(set(shared)) == 2 * len(set(found[1]) & set(found[2]))


def test_line_rows_in_all_cases(spark):
    rows = [(1, "a b\nc"), (1, "a b\nc"), (None, "a b\nd"), (2, None), (3, "a b\nd\n-")]
    docs = documents(spark, rows).drop("n_chars")
    got = texts(lines.dedup_lines(docs), "doc_id", "text")
    # the row without an id comes first; of the equal rows one keeps what is its own
    assert got == sorted([(1, "c"), (1, ""), (None, "a b\nd"), (2, None), (3, "-")], key=repr)
    assert lines.dedup_lines(docs.limit(0)).count() == 0


# -- substrings


def brute_windows(rows, length):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    counts = Counter(tuple(w[s : s + length]) for _, w in words for s in range(len(w) - length + 1))
    out = []
    for i, w in words:
        gone = {p for s in range(len(w) - length + 1) if counts[tuple(w[s : s + length])] > 1 for p in range(s, s + length)}
        out.append((i, [x for p, x in enumerate(w) if p not in gone], len(w)))
    return sorted(out, key=repr)


def shared_rows():
    passage, copy = prose(5, 45), prose(6, 80)
    rows = [(i, " ".join(prose(10 + i, 30 + i) + passage[i % 3 :] + prose(40 + i, 20))) for i in range(12)]
    rows += [(20 + i, "\n".join([*copy[: 20 + i], "edit", *copy[21 + i :]])) for i in range(20)]
    rows += [(50, " ".join(copy)), (50, " ".join(copy)), (51, None), (52, ""), (53, "x " * 36), (54, "y z " * 50), (55, " ".join(prose(7, 34))), (None, " ".join(prose(7, 34))), (56, LONG)]
    return rows


@pytest.mark.parametrize("length, hot", [(35, substrings.HOT), (35, 3), (12, 3), (5, substrings.HOT)])
def test_repeated_windows_go(spark, length, hot):
    rows = shared_rows()
    docs = documents(spark, rows).withColumnRenamed("source", "kept_words")
    out = substrings.dedup_substrings(docs, length=length, hot=hot)
    got = sorted(((r.doc_id, r.kept_words, r.n_words) for r in out.collect()), key=repr)
    assert got == brute_windows(rows, length)


def test_no_documents_have_no_windows(spark):
    assert substrings.dedup_substrings(documents(spark, [(1, "a")]).limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), min_size=1, max_size=9), min_size=1, max_size=4, unique_by=tuple), st.integers(1, 4))
def test_automaton_counts_occurrences(strings, length):
    automaton = substrings.Automaton()
    for n, string in enumerate(strings):
        automaton.add(string, n + 1)
    automaton.sum_up()
    counts = Counter()
    for n, string in enumerate(strings):
        for s in range(len(string) - length + 1):
            counts[tuple(string[s : s + length])] += n + 1
    for string in strings:
        assert automaton.occurrences(string, length) == [counts[tuple(string[s : s + length])] for s in range(len(string) - length + 1)]


# -- near duplicates


def brute_weights(rows, common=neardup.COMMON):
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        sets.append(Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or (Counter([tuple(words)]) if words else Counter()))
    n = sum(map(bool, sets))
    df = Counter(s for x in sets for s in x)
    return [{s: c * (1 + math.log(n / max(df[s], common * n))) for s, c in x.items()} for x in sets]


def brute_groups(rows, threshold=neardup.THRESHOLD):
    weighted, parent = brute_weights(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(weighted):
        for j in range(i):
            b = weighted[j]
            least = sum(min(w, b[s]) for s, w in a.items() if s in b)
            same = rows[i][1] is not None and rows[i][1] == rows[j][1]
            if same or least and least >= threshold * (sum(a.values()) + sum(b.values()) - least):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    return sorted(((rows[i][0], min((m for m in members[find(i)] if m is not None), default=None), len(members[find(i)])) for i in range(len(rows))), key=repr)


def near_rows():
    base = prose(1, 300)
    rows = [(i, " ".join([*base[: 3 * i], "edit", *base[3 * i + 1 :]])) for i in range(30)]
    rows += [(100 + i, " ".join(prose(60 + i, 40))) for i in range(25)]
    rows += [(200, "a b c"), (201, "A b, c"), (202, "a b"), (203, ""), (204, ""), (205, None), (206, None), (207, "!!"), (207, "!!"), (None, "lone words here"), (208, LONG), (209, LONG + " end")]
    return rows


def test_near_documents_share_a_class(spark):
    rows = near_rows()
    docs = documents(spark, rows).withColumnRenamed("lang", "class_id")
    assert texts(neardup.groups(docs), "doc_id", "class_id", "class_size") == brute_groups(rows)
    one = neardup.keep_one(docs)
    kept = [r.doc_id for r in one.collect()]
    assert sorted(map(repr, kept)) == sorted({repr((c)) for _, c, _ in brute_groups(rows)}) and one.columns == docs.columns
    assert neardup.groups(docs.limit(0)).count() == neardup.keep_one(docs.limit(0)).count() == 0


def test_every_shingle_weighs_by_its_own_frequency(spark):
    """Two texts are alike but for passages that 4 % of the documents have: linked, as those weigh less. With rare passages they are not."""
    base, passages = prose(1, 300), [" ".join(prose(70 + n, 40)) for n in range(2)]
    rows = [(n, " ".join(base) + " " + passages[n]) for n in range(2)]
    rows += [(10 + n, " ".join(prose(2, 300)) + " " + " ".join(prose(80 + n, 40))) for n in range(2)]
    rows += [(100 + n, " ".join(prose(100 + n, 150)) + (" " + passages[n % 2] if n < 10 else "")) for n in range(126)]
    got = texts(neardup.groups(documents(spark, rows)), "doc_id", "class_id", "class_size")
    assert got == brute_groups(rows)
    assert {(0, 0, 2), (1, 0, 2), (10, 10, 1), (11, 11, 1)} <= set(got)


def test_a_large_group_has_the_threshold_of_a_small_one(spark):
    """A third of the rows are copies of one text, and edited copies with a plain similarity of 0.81 to 0.88 to it."""
    base = prose(1, 300)
    edited = {size: [*base[: 8 * size], *prose(500 + size, size), *base[9 * size :]] for size in (15, 19, 22, 25, 27)}
    shingles = lambda words: {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    plain = {size: len(shingles(base) & shingles(words)) / len(shingles(base) | shingles(words)) for size, words in edited.items()}
    assert all(0.8 < p < 0.89 for p in plain.values())
    rows = [(i, " ".join(base)) for i in range(25)] + [(100 + size, " ".join(words)) for size, words in edited.items()]
    rows += [(1000 + i, " ".join(prose(2000 + i, 60))) for i in range(60)]
    rows += [(2000, " ".join([*prose(9, 200), *prose(10, 50)])), (2001, " ".join([*prose(9, 200), *prose(11, 50)]))]
    got = {r.doc_id: (r.class_id, r.class_size) for r in neardup.groups(documents(spark, rows)).collect()}
    assert {got[i] for i, _ in rows if i < 1000} == {(0, 30)}
    assert all(got[i] == (i, 1) for i, _ in rows if i >= 1000)


def test_samples_agree_as_often_as_sets_are_alike():
    a, b = " ".join(prose(1, 400)), " ".join(prose(1, 400)[:300] + prose(2, 100))
    idf = neardup.Weights(10, np.zeros(0, np.uint64), np.zeros(0), neardup.COMMON)
    text_of, keys, times = neardup.shingle_sets(pa.array([a, b]))
    starts = np.array([0, int((text_of == 0).sum())])
    weight = (times * idf.of(keys)).astype(np.float32)
    same = [len(set(neardup.samples(keys, weight, starts, k).tolist())) == 1 for k in range(800)]
    want = neardup.similarities(pa.array([a]), pa.array([b]), idf)[0]
    assert abs(sum(same) / 800 - want) < 0.06


# -- packing


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 60), max_size=20))
def test_plans_hold_every_piece_once(counts):
    made = packing.plan(counts, 64, groups=4)
    assert all(n > 0 and 0 < sum(sizes) <= 64 for n, sizes in made)
    held = Counter()
    for n, sizes in made:
        for size in sizes:
            held[size] += n
    assert held == Counter({s: n for s, n in counts.items() if n})
    assert sum(n for n, _ in made) <= 2 * math.ceil(sum(s * n for s, n in counts.items()) / 64) + 1


def test_configurations_solve_a_known_program():
    sizes = np.array([45, 36, 31, 14])
    made = packing.configurations(sizes, np.array([97.0, 610, 395, 211]), 100)
    assert abs(sum(a for _, a in made) - 452.25) < 1e-6 and all((c * sizes).sum() <= 100 for c, _ in made)


def test_packed_documents_are_whole(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    odd = "İ I'S it's DON'T ﬁ ½ 12 3 é x y a​b q\x1cr <|endoftext|>x Éè,,; naïve."
    rows = [(1, None), (2, ""), (3, odd), (4, LONG), (5, "a"), (5, "a"), (None, "no id"), *[(10 + i, " ".join(prose(i, 20 + 13 * i))) for i in range(60)]]
    docs = documents(spark, rows).withColumnRenamed("source", "length")
    got = packing.pack(docs, file).collect()
    tokenizer, want = Tokenizer.from_file(file), []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, n, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for n, at in enumerate(range(0, len(ids), 2048))]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= math.ceil(sum(w[3] for w in want) / 2048) + 1
    assert packing.pack(docs.limit(0), file).count() == 0


# -- scores


def test_base_scores_and_tokens_in_all_cases(spark):
    rows = [(1, "The cat sat"), (2, "the CAT ran far"), (3, None), (4, ""), (5, "unseen words"), (5, "unseen words"), (None, LONG)]
    docs = documents(spark, rows).withColumnRenamed("source", "score")
    model = scoring.train(docs, learned=docs["doc_id"] < 4)
    learned = Counter()
    for i, t in rows:
        if i is not None and i < 4:
            learned.update([*(t or "").lower().split(), ""])
    n, v = sum(learned.values()), len(learned)
    out = scoring.score(docs, model)
    assert model.tokens == n and out.columns == [*(c for c in docs.columns if c != "score"), "n_tokens", "n_known", "base_score", "score"]
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out.collect()), key=repr)
    want = []
    for i, t in rows:
        words = [*(t or "").lower().split(), ""]
        want.append((i, len(words), sum(learned[w] > 0 for w in words), round(sum(math.log10((learned[w] + 1) / (n + v + 1)) for w in words), 6)))
    assert got == sorted(want, key=repr)
    nothing = scoring.score(docs, scoring.train(docs.limit(0)))
    assert nothing.count() == len(rows) and scoring.score(docs.limit(0), model).count() == 0


def brute_score(words, learned, least, gain, discount):
    """The score of a text by a tree of dictionaries. ``learned`` are rows of words."""
    counts = Counter(w for row in learned for w in row)
    n, v = sum(counts.values()), len(counts)
    base = lambda w: (counts[w] + 1) / (n + v + 1)
    grams = [counts]
    for size in (2, 3, 4):
        made = Counter(tuple(row[i : i + size]) for row in learned for i in range(len(row) - size + 1))
        shorter = grams[-1] if size > 2 else None
        grams.append({g: c for g, c in made.items() if c >= least and (shorter is None or g[:-1] in shorter and g[1:] in shorter)})
    number = lambda g: counts[g[0]] if len(g) == 1 else grams[len(g) - 1][g]
    states = {}
    for size in (2, 3, 4):
        following = {}
        for g, c in grams[size - 1].items():
            following.setdefault(g[:-1], {})[g[-1]] = c
        for context, stored in following.items():
            total = number(context)
            parent = {w: base(w) if size == 2 else (grams[size - 2][(*context[1:], w)] / number(context[1:])) for w in stored}
            gained = sum(c * math.log(c / total / parent[w]) for w, c in stored.items())
            left = total - sum(stored.values())
            if left > 0:
                gained += left * math.log(left / total / (1 - min(sum(parent.values()), 1 - 1e-9)))
            if gained >= gain * len(stored):
                states[context] = {w: (c - discount) / total for w, c in stored.items()}
    score = 0.0
    for i, w in enumerate(words):
        p = base(w)
        for size in (1, 2, 3):
            context = tuple(words[i - size : i]) if i >= size else None
            if context in states:
                stored = states[context]
                p = stored.get(w, 0.0) + (1 - sum(stored.values())) * p
        score += math.log10(p)
    return score


def test_scores_are_those_of_a_tree_of_dictionaries(spark):
    passage = prose(1, 30)
    rows = [(i, " ".join(prose(10 + i, 15) + passage[i % 4 :] + prose(50 + i, 10))) for i in range(25)]
    rows += [(30, " ".join(prose(99, 5) + ["new", "words"] + passage[5:12])), (31, "")]
    docs = documents(spark, rows)
    model = scoring.train(docs, learned=docs["doc_id"] < 25)
    learned = [[*t.split(), ""] for i, t in rows if i < 25]
    assert any(len(level.keys) for level in model.tree.levels[2:])
    got = {r.doc_id: r.score for r in scoring.score(docs, model).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(brute_score([*t.split(), ""], learned, scoring.LEAST, scoring.GAIN, scoring.DISCOUNT), rel=1e-9)


def test_cold_words_are_joined(spark, monkeypatch):
    rows = [(i, " ".join(prose(i, 40))) for i in range(10)]
    docs = documents(spark, rows)
    whole = {r.doc_id: r.base_score for r in scoring.score(docs, scoring.train(docs)).collect()}
    monkeypatch.setattr(scoring, "HOT_WORDS", 5)
    model = scoring.train(docs)
    assert len(model.tree.numbers) <= 5
    cold = {r.doc_id: r.base_score for r in scoring.score(docs, model).collect()}
    assert cold == pytest.approx(whole)


def test_scores_of_contexts_that_are_joined(spark, monkeypatch):
    """What is broadcast decides nothing: with a few hot words and runs, all others are in contexts and runs as well."""
    monkeypatch.setattr(scoring, "HOT_WORDS", 5)
    monkeypatch.setattr(scoring, "HOT_RUNS", 3)
    passage = prose(1, 30)
    rows = [(i, " ".join(prose(10 + i, 15) + passage[i % 4 :] + prose(50 + i, 10))) for i in range(25)]
    rows += [(30, " ".join(prose(99, 5) + ["new", "words"] + passage[5:12])), (30, " ".join(prose(99, 5) + ["new", "words"] + passage[5:12])), (31, ""), (32, None)]
    docs = documents(spark, rows)
    model = scoring.train(docs, learned=docs["doc_id"] < 25)
    assert len(model.hot[0]) <= 3 and model.runs.count() > 50
    learned = [[*t.split(), ""] for i, t in rows if i < 25]
    got = scoring.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_score([*(r.text or "").split(), ""], learned, scoring.LEAST, scoring.GAIN, scoring.DISCOUNT)
        assert r.score == pytest.approx(want, rel=1e-9)


def test_what_is_stored_does_not_depend_on_the_size_of_the_corpus(spark):
    passage = " ".join(f"rare{i}" for i in range(12))
    docs = spark.createDataFrame([(1, passage), (2, f"once {passage}")], "doc_id bigint, text string")
    # 11 million other words
    many = spark.range(10, 120).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', 100000)").alias("text"))
    out = scoring.score(docs, scoring.train(docs.unionByName(many))).collect()
    assert len(out) == 2
    for r in out:
        # a word of the passage is certain after the word before it, but for the discount
        assert r.score > r.base_score + 11 * 5
