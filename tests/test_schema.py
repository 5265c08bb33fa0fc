import pytest
from pyspark.sql import types as T

from tidylake.schema import data_type, make_schema, reorder


def test_make_schema_forms(spark):
    a = make_schema([("a", "int"), ("b", T.StringType(), False), ("c", "timestamp_ntz")])
    assert [(f.name, f.dataType, f.nullable) for f in a.fields] == [
        ("a", T.IntegerType(), True), ("b", T.StringType(), False),
        ("c", T.TimestampNTZType(), True)]
    assert make_schema("a int, b string").fieldNames() == ["a", "b"]
    assert make_schema(a) is a
    assert data_type("decimal(10,2)") == T.DecimalType(10, 2)


def test_reorder():
    s = make_schema([("a", "int"), ("b", "string")])
    assert reorder(s, ["b", "a"]).fieldNames() == ["b", "a"]
    with pytest.raises(ValueError):
        reorder(s, ["a", "x"])
