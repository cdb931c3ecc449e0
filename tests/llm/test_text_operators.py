"""Operators that treat each document by itself: language, leaks, shards, fingerprints, pages."""

import base64
import hashlib
import random

import pyarrow as pa
import pytest
from edge import LONG, documents, texts
from pyspark.sql import functions as F

from quayside.llm import decontaminate, fingerprint, html, language, sharding

PASSAGE = "one two three four five six seven eight nine ten eleven"
LEAKY = [(1, f"Zero {PASSAGE.upper()} twelve"), (2, "one two three four five six seven eight nine"), (3, None), (4, ""), (5, "short item!"), (6, f"{LONG} {PASSAGE}"), (1, f"Zero {PASSAGE.upper()} twelve"), (None, PASSAGE)]


def test_leaks_in_all_cases(spark):
    docs = documents(spark, LEAKY)
    items = spark.createDataFrame([(7, PASSAGE), (8, "Short, item"), (9, None), (10, ""), (None, PASSAGE)], "item_id bigint, text string")
    found = decontaminate.find_leaks(docs, items)
    got = {(r.doc_id, r.source): (r.n_words, sorted((s.start, s.end, s["item"] or "") for s in r.leaks)) for r in found.collect()}
    assert got[1, "src"] == (13, [(1, 12, ""), (1, 12, "7")])
    assert got[2, "src"] == (9, []) and got[3, "src"] == got[4, "src"] == (0, [])
    assert got[5, "src"] == (2, [(0, 2, "8")]) and got[6, "src"][1] == [(60_000, 60_011, ""), (60_000, 60_011, "7")]
    assert found.columns == [*docs.columns, "leaks", "n_words"] and found.count() == len(LEAKY)
    parts = decontaminate.find_leaks(docs, items, part_bytes=20)
    again = {(r.doc_id, r.source): (r.n_words, sorted((s.start, s.end, s["item"] or "") for s in r.leaks)) for r in parts.collect()}
    assert again == got
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).where("size(leaks) > 0").count() == 0


def test_repeated_words_are_no_trap(spark):
    docs = spark.createDataFrame([(1, "to " * 3000), (2, "to " * 9)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "to " * 500)], "item_id bigint, text string")
    found = {r.doc_id: r.leaks for r in decontaminate.find_leaks(docs, items).collect()}
    assert found[2] == [] and max(s.end for s in found[1]) == 3000 and min(s.start for s in found[1]) == 0


def test_language_in_all_cases(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("", None), ("123 !?", "de"), (LONG, None), ("the dog", None), ("the dog", None)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("clash"))
    found = language.identify(docs, language.train(docs))
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert got[0][0] == got[6][0] == "en" and got[1][0] == "de" and got[6] == got[7]
    assert got[2] == got[3] == got[4] == ("und", 0.0) and got[5][0] in ("en", "de") and all(0 <= s <= 1 for _, s in got.values())
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    nothing = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"} and language.identify(docs.limit(0), nothing).count() == 0


def test_text_vector_is_the_sum_of_bound_letters():
    import numpy as np

    letter = language._letter_vector
    bound = lambda t: np.roll(letter(ord(t[0]) if t[0] != " " else 0), 2) * np.roll(letter(ord(t[1])), 1) * letter(ord(t[2]) if t[2] != " " else 0)
    want = sum(bound(t).astype(int) for t in (" ab", "ab ", " cd", "cd ")) + np.roll(letter(ord("b")), 2) * np.roll(letter(0), 1).astype(int) * letter(ord("c"))
    assert language.text_vectors(pa.array(["Ab. cd"]))[0].tolist() == want.tolist()


def test_held_out_language_is_right_nine_times_in_ten(spark):
    from quayside.llm.registry import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op1_language"](spark, "/root/testdata/sf0.001").where("held_out").join(docs, "doc_id")
    assert found.where("lang = lang_pred").count() >= 0.9 * found.count() > 0


def brute_hits(doc, items, n=10):
    """Words of a document inside an occurrence of a window of an item, and the items found."""
    hit, found = set(), set()
    for name, item in items:
        size = min(n, len(item))
        windows = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if size else set()
        for i in range(len(doc) - size + 1) if size else ():
            if tuple(doc[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(name)
    return len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(6))
def test_hits_of_items_of_all_lengths(spark, seed):
    """Items of 1 to 25 words beside each other, of few different words, so that places of several items fall on one diagonal."""
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(rng.choice([3, 12, 40]))]
    items = [(f"i{n}", [rng.choice(names) for _ in range(rng.randrange(1, rng.choice([4, 13, 26])))]) for n in range(60)]
    docs = [[rng.choice([*names, "own", "other"]) for _ in range(rng.randrange(0, 90))] for _ in range(60)]
    docs += [docs[0][:5] + items[n][1] + items[-n][1] + ["own"] + items[n][1] for n in range(1, 20)]
    frame = spark.createDataFrame([(n, " ".join(d)) for n, d in enumerate(docs)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id string, text string")
    got = {}
    for row in decontaminate.find_leaks(frame, bench).collect():
        covered = {i for s in row.leaks for i in range(s.start, s.end)}
        got[row.doc_id] = (len(covered), sorted({s.item for s in row.leaks}))
    assert got == {n: brute_hits(d, items) for n, d in enumerate(docs)}


def test_shards_are_even_and_stable(spark):
    names = [f"s{i}" for i in range(20)]
    table, fewer = sharding.fill(names), sharding.fill(names[:-1])
    sizes = [int((table == i).sum()) for i in range(20)]
    assert max(sizes) - min(sizes) <= 1
    moved = ((table != fewer) & (table != 19)).sum()
    assert moved < 0.25 * sharding.SLOTS
    docs = documents(spark, [(1, "a"), (1, "b"), (None, "c")]).withColumn("shard", F.lit(0))
    got = texts(sharding.assign(docs, F.col("doc_id"), names), "doc_id", "shard")
    want = lambda key: names[table[int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SLOTS]]
    assert got == [(1, want("1")), (1, want("1")), (None, want(""))]
    assert sharding.assign(docs.limit(0), F.col("doc_id")).count() == 0
    with pytest.raises(ValueError):
        sharding.fill(["a", "a"])
    with pytest.raises(ValueError):
        sharding.fill(["a"], 10)


def test_shards_are_written_apart(spark, tmp_path):
    docs = documents(spark, [(i, "t") for i in range(50)])
    sharding.write_shards(docs, str(tmp_path / "out"), F.col("doc_id"), ["a", "b"], 11)
    assert texts(spark.read.parquet(str(tmp_path / "out")), "doc_id") == texts(docs, "doc_id")


def brute_sketch(text):
    words = [w for w in "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)} - {()}


def test_fingerprints_keep_their_share(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (4, LONG), (5, LONG), (6, " ".join(LONG.split()[:9000]))]
    docs = documents(spark, rows).withColumn("sketch", F.lit(0))
    got = {r.doc_id: r.sketch for r in fingerprint.fingerprint(docs).collect()}
    assert got[1] == got[2] == [] and len(got[3]) <= 1 and got[4] == got[5]
    assert abs(len(got[4]) / len(brute_sketch(LONG)) - fingerprint.FRACTION) < 0.02
    assert set(got[6]) <= set(got[4])
    whole = {r.doc_id: r.sketch for r in fingerprint.fingerprint(docs, fraction=1.0).collect()}
    assert len(whole[4]) == len(brute_sketch(LONG)) and len(whole[3]) == 1
    both = docs.select("doc_id", F.lit("g").alias("g")).join(fingerprint.fingerprint(docs).select("doc_id", "sketch"), "doc_id")
    assert {r.sketch for r in fingerprint.merge(both, "g").collect()} == set(got[3]) | set(got[4])
    pair = spark.createDataFrame([(got[6], got[4], [])], "a array<bigint>, b array<bigint>, c array<bigint>")
    assert pair.select(fingerprint.containment(F.col("a"), F.col("b")), fingerprint.containment(F.col("c"), F.col("b"))).first()[:] == (1.0, None)
    assert fingerprint.fingerprint(docs.limit(0)).count() == 0


def test_short_texts_are_alike_only_if_they_share_words():
    short = [f"word{n} other{n}" for n in range(40)]
    rows = [*short, "same text", "same text", "", "!!", "lone words", " ".join(LONG.split()[:8]), LONG]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows), pa.array([0] * (len(rows) - 1) + [1])], ["doc_id", "text", "copy"])
    made = [r for b in fingerprint._compare(iter([batch])) for r in b.to_pylist()]
    near = {r["doc_id"]: r["near_next"] for r in made}
    assert all(near[n] == 0.0 for n in range(40)) and near[40] == near[42] == 1.0 and near[41] == near[43] == near[44] == 0.0
    assert all((r["fingerprint"] == "1:") == (r["doc_id"] in (42, 43)) for r in made)
    whole = fingerprint.sketches(pa.array([LONG]), 1.0)[0]
    kept, threshold = fingerprint.floored(whole)
    assert kept.tolist() == fingerprint.sketches(pa.array([LONG]))[0].tolist() and threshold == fingerprint.FRACTION


def likeness(a, b):
    """The share of the smaller of two written fingerprints in the other, below the threshold up to which both are complete."""
    (s, a), (t, b) = (x.split(":") for x in (a, b))
    most = min(float(s), float(t)) * 2**48
    sets = []
    for text in (a, b):
        raw = base64.b64decode(text)
        sets.append({h for h in (int.from_bytes(raw[i : i + 6], "big") for i in range(0, len(raw), 6)) if h < most})
    if not all(sets):
        return float(sets[0] == sets[1])
    return len(sets[0] & sets[1]) / min(map(len, sets))


def test_likenesses_are_those_of_the_written_fingerprints(spark):
    found = fingerprint.op10_fingerprint(spark, "/root/testdata/sf0.001").orderBy(F.desc("doc_id")).collect()
    for row, after in zip(found, found[1:] + found[:1]):
        assert row.near_edited == likeness(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == likeness(row.fingerprint, after.fingerprint)
    assert {r.fingerprint.split(":")[0] for r in found} == {"1", "0.25"}
    # a text of few shingles beside one of many that it begins
    batch = pa.RecordBatch.from_arrays([pa.array([3, 2, 1]), pa.array([" ".join(LONG.split()[:60]), LONG, "x"]), pa.array([0, 0, 1])], ["doc_id", "text", "copy"])
    first, second = [r for b in fingerprint._compare(iter([batch])) for r in b.to_pylist()]
    assert first["near_next"] == likeness(first["fingerprint"], second["fingerprint"]) == 1.0
    hashes, threshold = fingerprint.read(first["fingerprint"])
    assert threshold == 1.0 and len(hashes) == 56 and fingerprint.written(hashes, threshold) == first["fingerprint"]


@pytest.mark.parametrize("blocks", [1, 3, 7])
def test_edited_texts_take_from_the_next_document(spark, blocks):
    rows = [(5, "abcdefghi"), (9, "xyz" * 10), (2, None), (7, "é" * 7), (7, "same"), (1, ""), (None, "last one of all")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = fingerprint._with_next(docs, blocks).mapInArrow(fingerprint._compare, fingerprint.SCHEMA).collect()
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -99), r[1] or ""))
    want = []
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        want.append((i, len(t), hashlib.sha256((t[: len(t) - len(t) // 3] + u[: len(t) // 3]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
    assert fingerprint._with_next(docs.limit(0), blocks).count() == 0


MENU = "<div><p>Home</p><p>News</p></div>"


def test_templates_are_found_by_counting(spark):
    pages = [(i, f"http://a.example/{i}", f"<body>{MENU}<p>text {i}</p><div>other {i}</div></body>") for i in range(6)]
    pages += [(10, "http://b.example/1", f"<body>{MENU}<p>alone</p></body>"), (11, None, None), (12, "", ""), (13, "no address", "a &lt; b<br>c")]
    pages += [(20 + i, "http://c.example/x", f"<body>{MENU}<p>mirrored</p></body>") for i in range(9)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("main_text", F.lit(1)).withColumn("host", F.lit("clash"))
    for most in (html.MOST_TEMPLATES, 0):
        out = html.extract(df, most_templates=most)
        got = {r.page_id: r.main_text for r in out.collect()}
        assert all(got[i] == f"text {i}\n\nother {i}" for i in range(6))
        assert got[10] == "Home\n\nNews\n\nalone" and got[11] == got[12] == "" and got[13] == "a < b c"
        assert all(got[20 + i] == "Home\n\nNews\n\nmirrored" for i in range(9))
        assert out.columns == ["page_id", "url", "html", "host", "main_text"]
    assert html.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<nav>menu</nav><article><header><h1>T&eacute;</h1></header><p>a\n b<p>c</article><footer>f</footer>", "Té\n\na b\n\nc"),
        ("<main><p>x</p><aside>y</aside><form>z</form><section class='comments'>no</section></main>", "x"),
        ("<article><p>x</p><article>a reader's comment</article></article>", "x"),
        ("<article><p>one</article><nav>menu</nav><article><h1>t</h1><p>two</article>", "one\n\nt\n\ntwo"),
        ("<article><p>x</article><aside><article><p>card</article></aside><div class=comments><article>no</article></div>", "x"),
        ("<div class=related><article><p>a</article><article><p>longer one</article></div>", "longer one"),
        ("<div class='cookie-notice'>no</div><div id=sideBar>no</div><div hidden>no</div><p>yes", "yes"),
        ("<script>var t='</p>'</script><style>p{}</style><!-- <p>no</p> --><p title='a>b'>yes</p>", "yes"),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul><table><tr><td>1<td>2", "a\n\nb\n\nc\n\nd\n\n1\n\n2"),
        ("<p>cut <b off", "cut"),
        ("<p>x</p></div></p>y</article>z", "x\n\nyz"),
        ("<b>" * 20_000 + "<p>deep", "deep"),
        ("<p><b>" * 20_000 + "deep", "deep"),
    ],
)
def test_text_of_pages(page, text):
    assert html.main_text(page, "h", lambda own: frozenset()) == text


def test_what_a_small_part_of_a_host_repeats_is_no_template(spark):
    """Six of 200 pages quote one list; a menu stands on all of them."""
    quoted = "<ul><li>quoted</li><li>list</li></ul>"
    pages = [(i, "http://h.example/x", f"<article><p>text {i}</p>{MENU}{quoted if i < 6 else ''}</article>") for i in range(200)]
    pages += [(200 + i, "http://small.example/x", f"<article><p>own {i}</p>{quoted}</article>") for i in range(6)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r.main_text for r in html.extract(df, min_share=0.1).collect()}
    assert all(got[i] == f"text {i}" + "\n\nquoted\n\nlist" * (i < 6) for i in range(200))
    assert all(got[200 + i] == f"own {i}" for i in range(6))
    assert {r.main_text for r in html.extract(df).where("page_id < 6").collect()} == {f"text {i}" for i in range(6)}


def test_hosts(spark):
    urls = spark.createDataFrame([("HTTP://u:p@A.Example:80/x",), ("//b.example?q",), ("mailto:x",), (None,)], "u string")
    assert [r[0] for r in urls.select(html.host(F.col("u"))).collect()] == ["a.example", "b.example", "", ""]
