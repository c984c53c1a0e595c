import pytest
from pyspark.sql import types as T

from salesmill.functions import ddl

CREATE = """
CREATE TABLE t (
    code VARCHAR(12) NOT NULL, -- the key
    amount DECIMAL(12, 2),
    big LARGEINT,
    day DATE,
    at DATETIME COMMENT 'loaded, when'
)
DISTRIBUTED BY HASH(code, day) BUCKETS 10
PROPERTIES ("replication_num" = "1");
"""


def test_create_table_to_schema():
    schema = ddl.struct_from_ddl(CREATE.replace(" COMMENT 'loaded, when'", ""))
    assert schema.names == ["code", "amount", "big", "day", "at"]
    assert schema["code"].metadata["max_bytes"] == 12 and not schema["code"].nullable
    assert schema["amount"].dataType == T.DecimalType(12, 2)
    assert schema["big"].dataType == T.DecimalType(38, 0)
    assert schema["day"].dataType == T.DateType() and schema["at"].dataType == T.TimestampType()


def test_unreadable_column_is_an_error():
    with pytest.raises(ValueError):
        ddl.struct_from_ddl("justaname")


def test_compatibility():
    assert ddl.compatible(T.LongType(), T.ShortType()) and ddl.compatible(T.DoubleType(), T.DecimalType(10, 2))
    assert ddl.compatible(T.FloatType(), T.DecimalType(10, 2)) and ddl.compatible(T.StringType(), T.StringType())
    assert not ddl.compatible(T.StringType(), T.LongType()) and not ddl.compatible(T.FloatType(), T.DoubleType())
    target = ddl.struct_from_ddl("a INT, b VARCHAR(3), c DOUBLE")
    actual = T.StructType([T.StructField("A", T.StringType()), T.StructField("b", T.StringType()), T.StructField("z", T.LongType())])
    assert ddl.type_mismatches(actual, target) == [{"column": "A", "actual": "string", "declared": "INT"}]


@pytest.mark.parametrize(
    "old,new,allowed",
    [
        ("INT", "BIGINT", True),
        ("BIGINT", "INT", False),
        ("BIGINT", "FLOAT", False),
        ("SMALLINT", "DOUBLE", True),
        ("FLOAT", "DOUBLE", True),
        ("DOUBLE", "DECIMAL(20, 2)", True),
        ("DECIMAL(10, 2)", "DECIMAL(12, 2)", True),
        ("DECIMAL(10, 2)", "DECIMAL(10, 4)", False),
        ("DATE", "DATETIME", True),
        ("DATETIME", "DATE", False),
        ("VARCHAR(10)", "VARCHAR(12)", True),
        ("VARCHAR(12)", "VARCHAR(10)", False),
    ],
)
def test_widening(old, new, allowed):
    assert ddl.may_widen(old, new) is allowed


def test_next_int_type_keeps_exact_types_apart():
    assert ddl.next_int_type("BIGINT", 0, 2**40) is None
    assert ddl.next_int_type("INT", 0, 2**31) == "BIGINT"
    assert ddl.next_int_type("TINYINT", -129, 0) == "SMALLINT"
    assert ddl.next_int_type("SMALLINT", 0, 2**63) == "LARGEINT"
    assert ddl.next_int_type("INTEGER", -(2**31), 2**31 - 1) is None
    assert ddl.next_int_type("DOUBLE", 0, 1) is None
