"""Schema text rules (FIXTURES F9) and schema-on-read."""

import pytest
from pyspark.sql import types as T

from ingestkit.functions.schema_text import SchemaTextError, apply_schema, parse_schema_text


def test_basic_and_nullable():
    st = parse_schema_text("a:integer,b:string")
    assert [(f.name, f.dataType, f.nullable) for f in st.fields] == [
        ("a", T.IntegerType(), True), ("b", T.StringType(), True)]


@pytest.mark.parametrize("text", ["a:int", "a:Integer", "a:decimal", "a: integer", "a:bigint"])
def test_unknown_words_read_as_string(text):
    assert parse_schema_text(text).fields[0].dataType == T.StringType()


def test_blank_is_part_of_the_name_and_third_part_ignored():
    st = parse_schema_text("a:integer, b:long")
    assert st.fieldNames() == ["a", " b"]
    assert parse_schema_text("a:integer:x").fields[0].dataType == T.IntegerType()


def test_lines_join_without_separator():
    st = parse_schema_text(["a:integer,", "b:long\n"])
    assert st.fieldNames() == ["a", "b"]


@pytest.mark.parametrize("text", ["a", "a:", "a:decimal(10,2)"])
def test_errors(text):
    with pytest.raises(SchemaTextError):
        parse_schema_text(text)


def test_all_type_words():
    st = parse_schema_text("a:byte,b:short,c:integer,d:long,e:float,f:double,g:string,"
                           "h:binary,i:boolean,j:timestamp,k:date")
    assert [type(f.dataType).__name__ for f in st.fields] == [
        "ByteType", "ShortType", "IntegerType", "LongType", "FloatType", "DoubleType",
        "StringType", "BinaryType", "BooleanType", "TimestampType", "DateType"]


def test_apply_schema_bad_cells_become_null(spark):
    df = spark.createDataFrame([("1", "2.5", "2020-01-02"), ("x", "abc", "nope")],
                               "a string, b string, c string")
    out = apply_schema(df, "a:integer,b:double,c:date,d:string").collect()
    assert [tuple(r) for r in out] == [(1, 2.5, __import__("datetime").date(2020, 1, 2), None),
                                       (None, None, None, None)]
