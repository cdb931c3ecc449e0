import bz2

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import values
from quayside.operators import lookup as lookup_module
from quayside.operators.numbering import exclusive_running_sum
from quayside.operators.schema import clean_columns
from quayside.sources.delimited import Delimited, DelimitedRecords, RecordType
from quayside.sources.fixed_width import FixedColumn, FixedType, FixedWidth, FixedWidthRecords
from quayside.sources.frames import Files


def read(spark, source, folder):
    return source.read(spark, Files([folder]))


def test_csv_with_header(spark, land):
    folder = land({"a.csv": "Member ID,Plan #,Rate %\n1, A ,5\n2,B,\n"})
    frame = read(spark, Delimited("s"), folder)[0]
    assert clean_columns(frame.df).columns[:4] == ["member_id", "plan_num", "rate_pct", "meta_source_line_number"]
    assert values(frame.df) == [("1", "A", "5", 2), ("2", "B", None, 3)]
    assert frame.tokens == {"sourceOffset": ""}


def test_csv_quotes_escapes_short_and_long_rows(spark, land):
    folder = land({"a.csv": 'a,b\n"x,1","say \\"hi\\""\nshort\nl,m,n\n'})
    assert values(read(spark, Delimited("s"), folder)[0].df) == [
        ("l", "m", 4), ("short", None, 3), ("x,1", 'say "hi"', 2)
    ]


def test_blank_lines_keep_true_line_numbers(spark, land):
    folder = land({"a.csv": "a\n1\n\n  \n2\n"})
    assert values(read(spark, Delimited("s"), folder)[0].df) == [("1", 2), ("2", 5)]


def test_csv_without_header_and_with_wide_delimiter(spark, land):
    folder = land({"a.csv": "1||x\n2||y\n"})
    df = read(spark, Delimited("s", "||", has_header=False), folder)[0].df
    assert df.columns[:2] == ["_c0", "_c1"]
    assert values(df) == [("1", "x", 1), ("2", "y", 2)]


def test_header_override(spark, land):
    folder = land({"a.csv": "1,2,3\n"})
    assert read(spark, Delimited("s", has_header=False, header_columns=["x", "y", "z"]), folder)[0].df.columns[:3] == ["x", "y", "z"]
    with pytest.raises(ValueError, match="2 names given for 3"):
        read(spark, Delimited("s", has_header=False, header_columns=["x", "y"]), folder)
    with pytest.raises(ValueError, match="duplicate"):
        Delimited("s", header_columns=["X ", "x"])


@pytest.mark.parametrize("multi_line", [False, True])
def test_files_with_different_headers_do_not_mix(spark, land, multi_line):
    folder = land({"a.csv": "a,b\n1,2\n", "b.csv": "b,c\n3,4\n", "c.csv": "a,b\n5,6\n"})
    frames = read(spark, Delimited("s", multi_line=multi_line), folder)
    got = {tuple(f.df.columns[:2]): values(f.df) for f in frames}
    assert got == {("a", "b"): [("1", "2", 2), ("5", "6", 2)], ("b", "c"): [("3", "4", 2)]}


def test_file_names_with_spaces_and_signs(spark, land):
    # Spark's own inference of multi-line files takes brackets for a pattern
    for multi_line, name in ((False, "a b%20#c+[x].csv"), (True, "a b%20#c+.csv")):
        folder = land({name: "a\n1\n"}, root=str(multi_line))
        frame = read(spark, Delimited("s", multi_line=multi_line), folder)[0]
        assert values(frame.df) == [("1", 2)]


def test_skip_lines(spark, land):
    folder = land({"a.csv": "junk\njunk,1\njunk\na,b\n1,x\n", "b.csv": "j\nj\nj\nc\n2\n"})
    frames = read(spark, Delimited("s", skip_lines=3), folder)
    assert sorted((f.df.columns[0], values(f.df)) for f in frames) == [("a", [("1", "x", 5)]), ("c", [("2", 5)])]
    assert frames[0].tokens == {"sourceOffset": "3"}


def test_skip_more_lines_than_the_first_block(spark, land, small_splits):
    folder = land({"a.csv": "".join(f"junk {n}\n" for n in range(3000)) + "a\n" + "".join(f"{n}\n" for n in range(500))})
    df = read(spark, Delimited("s", skip_lines=3000), folder)[0].df
    assert df.rdd.getNumPartitions() > 4
    assert values(df) == sorted(((str(n), 3002 + n) for n in range(500)), key=repr)


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_multi_line_records(spark, land, newline):
    folder = land({"a.csv": f'h1,h2\n1,"a{newline}b"\n2,c\n3,"{newline}x{newline}"\n4,d\n'})
    df = read(spark, Delimited("s", multi_line=True), folder)[0].df
    assert values(df, "h1", "meta_source_line_number") == [("1", 2), ("2", 4), ("3", 5), ("4", 8)]


def test_encodings(spark, land):
    for name in ("ISO-8859-1", "UTF-16LE", "UTF-16BE"):
        folder = land({"a.csv": "näme,x\r\nü,1\r\n".encode(name)}, root=name)
        df = read(spark, Delimited("s", encoding=name), folder)[0].df
        assert df.columns[:2] == ["näme", "x"] and values(df) == [("ü", "1", 2)]


def test_compressed_text(spark, land):
    folder = land({"a.csv.bz2": bz2.compress(b"a\n1\n2\n")})
    assert values(read(spark, Delimited("s"), folder)[0].df) == [("1", 2), ("2", 3)]


def test_delimited_record_types(spark, land):
    folder = land({"a.txt": "H|20240101\nD|1|x\n D |2|y\nT|2\nAH|odd\n"})
    types = [
        RecordType("header", "H", ["tag", "day"]),
        RecordType("detail", "^D$", ["tag", "n", "v"]),
        RecordType("trailer", "^T$", ["tag", "count"]),
    ]
    header, detail, trailer = read(spark, DelimitedRecords("s", "|", 1, types), folder)
    assert values(header.df) == [("AH", "odd", 5), ("H", "20240101", 1)]
    assert values(detail.df) == [("D", "1", "x", 2), ("D", "2", "y", 3)]
    assert values(trailer.df) == [("T", "2", 4)]
    assert detail.tokens == {"sourceOffset": "", "type": "detail"}


def test_fixed_width(spark, land):
    folder = land({"a.txt": "A1   name      abcSURPLUS\nB2\n\n\tC\t  \tn\t       x\n"})
    columns = [FixedColumn("id", 5), FixedColumn("name", 10), FixedColumn("code", 3)]
    df = read(spark, FixedWidth("s", columns), folder)[0].df
    assert values(df) == [("", "", "", 3), ("A1", "name", "abc", 1), ("B2", "", "", 2), ("C", "n", "x", 4)]


def test_fixed_width_record_types(spark, land):
    folder = land({"a.txt": "HD20240101\nDT0001x\nTRL2\n"})
    types = [
        FixedType("h", "HD", [FixedColumn("tag", 2), FixedColumn("day", 8)]),
        FixedType("d", "DT", [FixedColumn("tag", 2), FixedColumn("n", 4), FixedColumn("v", 1)]),
        FixedType("t", "TRL", [FixedColumn("tag", 3), FixedColumn("n", 1)], tag_width=3),
    ]
    h, d, t = read(spark, FixedWidthRecords("s", 1, 2, types), folder)
    assert (values(h.df), values(d.df), values(t.df)) == (
        [("HD", "20240101", 1)], [("DT", "0001", "x", 2)], [("TRL", "2", 3)]
    )
    assert d.tokens["sourceOffset"].startswith("trim(substring(value, 1, 2)) AS tag, trim(substring(value, 3, 4))")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lengths=st.lists(st.integers(0, 300), min_size=1, max_size=400), copies=st.integers(1, 3))
@pytest.mark.parametrize("salted", [False, True])
def test_line_numbers_whatever_the_split(spark, tmp_path_factory, small_splits, monkeypatch, salted, lengths, copies):
    if salted:
        monkeypatch.setattr(lookup_module, "measured_bytes", lambda df: 1 << 40)
    folder = tmp_path_factory.mktemp("lines")
    want = []
    for copy in range(copies):
        lines = [f"{copy}:{n}:" + "x" * length for n, length in enumerate(lengths)]
        (folder / f"f{copy}.txt").write_text("".join(line + "\n" for line in lines))
        want += [(line.rstrip(), n) for n, line in enumerate(lines, 1)]
    df = read(spark, FixedWidth("s", [FixedColumn("v", 400)]), str(folder))[0].df
    assert values(df) == sorted(want, key=repr)


@pytest.mark.parametrize("bits", [1, 2, 3, 16])
def test_running_sum_whatever_the_chunk(spark, bits):
    rows = [(p, n, n * 7 % 5) for p in "ab" for n in range(0, 60, 1 if p == "a" else 3)]
    df = spark.createDataFrame(rows, "p string, n bigint, v bigint").repartition(4)
    want = [(p, n, v, sum(x for q, m, x in rows if q == p and m < n)) for p, n, v in rows]
    assert values(exclusive_running_sum(df, "v", "n", "s", ("p",), bits)) == sorted(want, key=repr)
    whole = [(p, n, v, sum(x for _, m, x in rows if m < n)) for p, n, v in rows]
    assert values(exclusive_running_sum(df, "v", "n", "s", (), bits)) == sorted(whole, key=repr)


def test_each_landed_shard_has_a_task_of_its_own(spark):
    """Hashed shards would meet in one task, which would write and read several files' rows."""
    from pyspark.sql import functions as F

    from quayside.examples.landing import placed

    rows = spark.range(0, 4000, 1, 4).selectExpr("id", "cast(id % 40 as int) as shard")
    tasks = placed(rows, 40, ["id"]).groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("shard").alias("n"), F.count("*").alias("rows"))
    assert [(r.n, r.rows) for r in tasks.collect()] == [(1, 100)] * 40
