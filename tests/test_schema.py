import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import values
from quayside.functions.names import clean_name
from quayside.operators.flatten import FlattenTarget, flatten_all, flatten_targets
from quayside.operators.schema import (
    cast_leaves_to_string,
    clean_columns,
    rename_positional,
    schema_from_fields,
    union_by_name,
)


@pytest.mark.parametrize(
    "raw, clean",
    [("#", "num"), ("% Paid", "pct_paid"), ("A  B", "a_b"), ("__x__", "x"), ("a.b", "a_b"), ("Ünï", "n")],
)
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


@given(st.text(max_size=30))
def test_clean_name_twice_is_once(name):
    assert clean_name(clean_name(name)) == clean_name(name)


NESTED = "`Top #` struct<`In Side`: array<array<struct<`X.Y`: int, m: map<string,int>>>>>, plain int"


def test_clean_columns_reaches_nested_arrays(spark):
    df = clean_columns(spark.createDataFrame([], NESTED))
    assert df.schema.simpleString() == (
        "struct<top_num:struct<in_side:array<array<struct<x_y:int,m:map<string,int>>>>>,plain:int>"
    )


def test_cast_leaves_keeps_shape(spark):
    df = spark.sql("select named_struct('A', array(array(1, 2)), 'm', map('k', 1)) as s, 7 as meta_source_line_number")
    out = cast_leaves_to_string(df)
    assert out.schema["s"].dataType.simpleString() == "struct<a:array<array<string>>,m:string>"
    assert out.schema["meta_source_line_number"].dataType == T.IntegerType()
    assert out.first()["s"] == ([["1", "2"]], "{k -> 1}")


def test_duplicate_cleaned_names_are_an_error(spark):
    with pytest.raises(ValueError, match="a_b"):
        clean_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a.b` int"))
    with pytest.raises(ValueError, match="x"):
        clean_columns(spark.createDataFrame([], "s struct<`x `: int, `X`: int>"))


def test_rename_positional(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, meta_source_line_number int")
    assert rename_positional(df, ["x", "y"]).columns == ["x", "y", "meta_source_line_number"]
    with pytest.raises(ValueError, match="3 names given for 2"):
        rename_positional(df, ["x", "y", "z"])
    only_line = df.select("meta_source_line_number")
    assert rename_positional(only_line, ["x"]).columns == ["meta_source_line_number"]


def test_schema_from_fields_defaults_to_nullable():
    schema = schema_from_fields(
        [
            {"name": "id", "type": "string"},
            {"name": "n", "type": "long", "nullable": False},
            {"name": "tags", "type": {"type": "array", "elementType": "string", "containsNull": True}},
            {"name": "s", "type": {"type": "struct", "fields": [{"name": "x", "type": "string"}]}},
        ]
    )
    assert schema.simpleString() == "struct<id:string,n:bigint,tags:array<string>,s:struct<x:string>>"
    assert [f.nullable for f in schema] == [True, False, True, True]


def test_flatten_all_keeps_empty_rows_and_multiplies(spark):
    df = spark.sql(
        """select * from values
           (1, array('a', 'b'), array(named_struct('sku', 's', 'opts', array(array(1, 2))))),
           (2, array(), null) as t(id, tags, items)"""
    )
    flat = flatten_all(df)
    assert flat.columns == ["id", "tags", "items_sku", "items_opts"]
    assert values(flat) == [(1, "a", "s", 1), (1, "a", "s", 2), (1, "b", "s", 1), (1, "b", "s", 2), (2, None, None, None)]


def test_flatten_takes_names_with_dots(spark):
    df = spark.sql("select named_struct('x.y', array(1)) as `a.b`, 2 as `c.d`")
    assert flatten_all(df).columns == ["c.d", "a.b_x.y"]


def test_flatten_raises_on_clashing_names(spark):
    with pytest.raises(ValueError, match="a_b"):
        flatten_all(spark.sql("select named_struct('b', 1) as a, 2 as a_b"))


def test_flatten_targets(spark):
    df = spark.sql("select 1 as id, array(named_struct('x', 1), named_struct('x', 2)) as T, named_struct('q', 3) as other")
    assert values(flatten_targets(df, [FlattenTarget("t")]), "id", "T_x", "other.q") == [(1, 1, 3), (1, 2, 3)]
    alone = flatten_targets(df, [FlattenTarget("t", include_others=False)])
    assert alone.columns == ["T_x"]
    with pytest.raises(ValueError, match="no column"):
        flatten_targets(df, [FlattenTarget("t", include_others=False), FlattenTarget("other")])


_leaf = st.sampled_from(["int", "string"])
_type = st.recursive(
    _leaf,
    lambda inner: st.one_of(
        inner.map(lambda t: f"array<{t}>"),
        st.lists(inner, min_size=1, max_size=2).map(
            lambda ts: "struct<" + ",".join(f"f{i}:{t}" for i, t in enumerate(ts)) + ">"
        ),
    ),
    max_leaves=4,
)


@settings(max_examples=15, deadline=None)
@given(kind=_type)
def test_flatten_leaves_nothing_nested(spark, kind):
    flat = flatten_all(spark.createDataFrame([], f"k int, v {kind}"))
    assert all(not isinstance(f.dataType, (T.ArrayType, T.StructType)) for f in flat.schema)


def test_union_by_name_skips_empty_frames(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, x int")
    odd = spark.createDataFrame([], "z int")
    assert values(union_by_name([odd, a, b])) == [(1, 2), (4, 3)]
    with pytest.raises(Exception):
        union_by_name([a, a.select(F.col("x").alias("z"))]).count()
