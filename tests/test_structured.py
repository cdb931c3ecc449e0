import pytest
from pyspark.sql import types as T

from conftest import values
from quayside.operators.flatten import FlattenTarget
from quayside.operators.schema import clean_columns
from quayside.sources.frames import Files
from quayside.sources.structured import Jdbc, JdbcTable, Json, Parquet, Xml, XmlRow


def test_json_leaves_are_text_and_null_fields_stay(spark, land):
    folder = land({"a.json": '{"id": 007.0, "tags": ["x", 1], "addr": {"zip": 12}, "empty": null}\n'.replace("007.0", "7.0")})
    df = Json("s").read(spark, Files([folder]))[0].df
    assert values(df, "id", "tags", "addr.zip", "empty") == [("7.0", ["x", "1"], "12", None)]


def test_json_quirky_syntax_and_multi_line(spark, land):
    folder = land({"a.json": "[{id: 1,\n 'v': 'a'},\n {id: 2, 'v': null}]"})
    df = Json("s", multi_line=True, allow_unquoted_field_names=True).read(spark, Files([folder]))[0].df
    assert values(df, "id", "v") == [("1", "a"), ("2", None)]


def test_json_flatten(spark, land):
    folder = land({"a.json": '{"id":1,"addr":{"city":"x"},"items":[{"sku":"a","opts":[[1,2]]},{"sku":"b","opts":null}]}\n{"id":2,"addr":null,"items":[]}\n'})
    df = Json("s", flatten=True).read(spark, Files([folder]))[0].df
    assert sorted(c for c in df.columns) == ["addr_city", "id", "items_opts", "items_sku", "meta_source_name"]
    assert values(df, "id", "addr_city", "items_sku", "items_opts") == [
        ("1", "x", "a", "1"), ("1", "x", "a", "2"), ("1", "x", "b", None), ("2", None, None, None)
    ]
    only = Json("s", flatten_targets=[FlattenTarget("ITEMS", include_others=False)]).read(spark, Files([folder]))[0].df
    assert sorted(only.columns) == ["items_opts", "items_sku", "meta_source_name"]


def test_json_declared_schema_and_formats(spark, land):
    folder = land({"a.json": '{"d": "02/01/2024", "n": 5}\n'})
    schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("n", T.LongType())])
    df = Json("s", schema=schema, date_format="dd/MM/yyyy").read(spark, Files([folder]))[0].df
    assert [str(v) for v in values(df)[0]] == ["2024-01-02", "5"]
    native = Json("s", primitives_as_string=False).read(spark, Files([folder]))[0].df
    assert native.schema["n"].dataType == T.LongType()


XML = """<r><member id="1"><name> Ann </name><code>007</code><tag>a</tag><tag>b</tag></member>
<member id="2"><name lang="fr">Bo</name><code></code></member><plan><p>9</p></plan></r>"""


def test_xml_two_row_tags(spark, land):
    folder = land({"a.xml": XML})
    rows = [XmlRow("member"), XmlRow("plan", primitives_as_string=False)]
    member, plan = Xml("s", rows).read(spark, Files([folder]))
    assert values(member.df, "id", "code", "name.value", "name.lang", "tag") == [
        ("1", "7", " Ann ", None, ["a", "b"]), ("2", None, "Bo", "fr", None)
    ]
    assert values(plan.df, "p") == [(9,)]
    assert member.tokens == {"sourceOffset": "member", "type": "member", "isFlat": "false"}


def test_xml_without_inference_keeps_text(spark, land):
    folder = land({"a.xml": XML})
    df = Xml("s", [XmlRow("member", infer=False)]).read(spark, Files([folder]))[0].df
    assert sorted(v[0] or "" for v in values(df, "code")) == ["", "007"]
    flat = Xml("s", [XmlRow("member", flatten=True)]).read(spark, Files([folder]))[0].df
    assert values(flat, "id", "name_value", "tag") == [("1", " Ann ", "a"), ("1", " Ann ", "b"), ("2", "Bo", None)]


def test_parquet_keeps_native_types(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    spark.sql("select 1 as `A b`, 2.5D as d, timestamp'2024-01-01' as t, cast(1 as decimal(9,2)) as e, map('k', 1) as m").write.parquet(path)
    df = Parquet("s").read(spark, Files([path]))[0].df
    assert [f.dataType.simpleString() for f in df.schema] == [
        "int", "double", "timestamp", "decimal(9,2)", "map<string,int>", "string"
    ]
    renamed = Parquet("s", ["v", "w", "x", "y", "z"]).read(spark, Files([path]))[0].df
    assert clean_columns(renamed).columns == ["v", "w", "x", "y", "z", "meta_source_name"]
    with pytest.raises(ValueError):
        Parquet("s", ["v"]).read(spark, Files([path]))


def test_jdbc_options():
    tables = [JdbcTable("A"), JdbcTable("B B"), JdbcTable("select x from t"), JdbcTable("t", "id", 0, 100, 8)]
    source = Jdbc("s", "jdbc:x:y", tables, driver="d", fetch_size=500)
    plain, spaced, query, split = [source.options(t) for t in tables]
    assert plain == {"url": "jdbc:x:y", "driver": "d", "fetchsize": "500", "dbtable": "A"}
    assert spaced["dbtable"] == "B B" and source.type_tokens()[1]["type"] == "B_B"
    assert query["query"] == "select x from t" and "dbtable" not in query
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "100", "8")
    by_query = source.options(JdbcTable("SELECT id FROM t", "id", 0, 9, 2))
    assert by_query["dbtable"] == "(SELECT id FROM t) q"


def test_credentials_stay_out_of_the_rows():
    from quayside.sources.structured import Jdbc, JdbcTable

    source = Jdbc("erp", "jdbc:db://me:secret@host:1/base?password=secret;x=1", [JdbcTable("t")], user="me", password="secret")
    assert source.plain_url == "jdbc:db://host:1/base" and "secret" not in repr(source).replace(source.url, "")
    assert source.options(source.tables[0])["password"] == "secret"


SPLIT = """<?xml version="1.0"?>
<r>
<member id="1"><name> Ann &lt;x&gt; </name><code>007</code><tag>a</tag><tag>b</tag></member>
<member/><member id="3" note="a > b"/><member id='4'
 note="/"><name lang="fr">Bo</name><code></code></member><plan><p>9</p></plan><members id="9"></members>
<member id="5"><name>C<b/></name></member>
<plan><p>10</p></plan>
</r>"""


def test_split_xml_gives_what_whole_files_give(spark, land, small_splits):
    """Many rows, cut into splits of two kilobytes."""
    body = "".join(f'<member id="{n}"><name>name {n}</name><code>{n % 7}</code></member>\n' for n in range(400))
    folder = land({"a.xml": SPLIT, "b.xml": "<r>" + body + "</r>"})
    frames = [Xml("s", [XmlRow("member", split=split), XmlRow("plan", split=split)]).read(spark, Files([folder])) for split in (False, True)]
    for whole, split in zip(*frames):
        assert whole.df.schema == split.df.schema and whole.tokens == split.tokens
        assert values(whole.df, *whole.df.columns) == values(split.df, *split.df.columns)
    assert frames[1][0].df.rdd.getNumPartitions() > 10
    assert frames[1][0].df.count() == 405


def test_split_xml_with_a_schema(spark, land):
    folder = land({"a.xml": SPLIT})
    schema = T.StructType([T.StructField("_id", T.LongType()), T.StructField("code", T.StringType())])
    df = Xml("s", [XmlRow("member", schema=schema, split=True, primitives_as_string=False)]).read(spark, Files([folder]))[0].df
    assert values(df, "id", "code") == sorted([(1, "007"), (None, None), (3, None), (4, None), (5, None)], key=repr)
