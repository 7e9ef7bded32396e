"""JSON decode (FIXTURES F10)."""

from ingestkit.functions.json_codec import decode_json


def test_json_decode_matrix(spark):
    df = spark.createDataFrame([("bad{",), (None,), ('{"a":"1","b":"zz"}',), ('{"a":"1"}',),
                                ('{"a":1,"b":2,"c":9}',)], "value string")
    got = [tuple(r) for r in decode_json(df, "a:string,b:integer").collect()]
    assert got == [(None, None), (None, None), ("1", None), ("1", None), ("1", 2)]
