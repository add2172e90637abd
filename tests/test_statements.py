import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators import verify
from driftline.schema import Column, Type
from driftline.sinks import statements


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def texts(spark, value, kind, dialect):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", kind)]))
    return df.select(statements.literal(F.col("v"), kind, dialect).alias("x")).first().x


def test_literals(spark):
    every = {
        (None, T.LongType()): ("NULL", "NULL", "null"),
        (True, T.BooleanType()): ("true", "true", "true"),
        (-7, T.LongType()): ("-7", "-7", "-7"),
        (Decimal("1.50"), T.DecimalType(10, 2)): ("1.50", "1.50", "1.50"),
        (1.5, T.DoubleType()): ("1.5", "1.5", "1.5"),
        ("it's a \\ b", T.StringType()): ("'it''s a \\ b'", "'it''s a \\\\ b'", "'it\\'s a \\\\ b'"),
        ("", T.StringType()): ("''", "''", "''"),
        (b"\x00\xab", T.BinaryType()): ("'\\x00ab'::bytea", "x'00ab'", "'00ab'"),
        (dt.date(2024, 2, 29), T.DateType()): ("'2024-02-29'", "'2024-02-29'", "date('2024-02-29')"),
        (dt.datetime(2024, 2, 29, 1, 2, 3, 4), T.TimestampNTZType()): ("'2024-02-29T01:02:03.000004'", "'2024-02-29 01:02:03.000004'", "datetime('2024-02-29T01:02:03.000004Z')"),
        (dt.timedelta(seconds=90, microseconds=5), T.DayTimeIntervalType()): ("'PT90.000005000S'::interval", "'PT90.000005000S'", "duration('PT90.000005000S')"),
        (dt.timedelta(seconds=-2), T.DayTimeIntervalType()): ("'PT-2S'::interval", "'PT-2S'", "duration('PT-2S')"),
    }
    for (value, kind), want in every.items():
        assert tuple(texts(spark, value, kind, d) for d in ("postgresql", "mysql", "cypher")) == want
    kind = T.ArrayType(T.StringType())
    assert [texts(spark, ["a", None, "b'"], kind, d) for d in ("postgresql", "cypher")] == ["ARRAY['a', NULL, 'b''']::TEXT[]", "['a', null, 'b\\'']"]
    assert texts(spark, [], kind, "postgresql") == "ARRAY[]::TEXT[]" and texts(spark, ["a"], kind, "mysql") == "'[\"a\"]'"
    kind = T.StructType([T.StructField("a`", T.IntegerType()), T.StructField("b", T.StringType())])
    assert texts(spark, (1, None), kind, "cypher") == "{`a```: 1, `b`: null}" and texts(spark, (1, "x"), kind, "mysql") == '\'{"a`":1,"b":"x"}\''


def test_numbers_that_are_not_finite(spark):
    assert texts(spark, float("-inf"), T.DoubleType(), "postgresql") == "'-Infinity'::float8"
    for dialect in ("mysql", "cypher"):
        with pytest.raises(Exception, match="not finite"):
            texts(spark, float("nan"), T.DoubleType(), dialect)
    with pytest.raises(Exception, match="NUL"):
        texts(spark, "a\0b", T.StringType(), "postgresql")


@pytest.mark.parametrize("rows,most", [(7, 1 << 20), (1000, 400), (1, 10), (10_000, 1 << 30)])
def test_bounds_and_order(spark, rows, most):
    """Every row once and in order, no statement beyond its bounds but that of a single row, and none that the next row would still have fitted in."""
    df = spark.range(0, 300, 1, 2).select("id", F.expr("repeat('é', CAST(id % 50 AS INT))").alias("t"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        got = statements.batches(df, "t", rows=rows, most_bytes=most).withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    head = 'INSERT INTO "t" ("id", "t") VALUES '
    assert all(g.statement.startswith(head) and g.statement.endswith(";") for g in got)
    held = [g.statement[len(head) + 1 : -2].split("), (") for g in got]
    assert [len(h) for h in held] == [g.n_rows for g in got]
    assert [x for h in held for x in h] == [f"{i}, '{'é' * (i % 50)}'" for i in range(300)]
    size = lambda s: len(s.encode())
    assert all(g.n_rows <= rows and (size(g.statement) <= most or g.n_rows == 1) for g in got)
    for g, h, after in zip(got, held[1:], got[1:]):
        assert g.p != after.p or g.n_rows == rows or size(g.statement) + size(f", ({h[0]})") > most


def test_unnest_unwind_and_mysql(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "id int, `na\"me` string, v double").coalesce(1)
    only = lambda **o: [r.statement for r in statements.batches(df, "t", **o).collect()]
    assert only(unnest=True) == ['INSERT INTO "t" ("id", "na""me", "v") SELECT * FROM UNNEST(ARRAY[1, 2]::INTEGER[], ARRAY[\'a\', NULL]::TEXT[], ARRAY[NULL, 2.5]::DOUBLE PRECISION[]);']
    assert only(dialect="mysql") == ["INSERT INTO `t` (`id`, `na\"me`, `v`) VALUES (1, 'a', NULL), (2, NULL, 2.5);"]
    assert only(dialect="cypher") == ["UNWIND [{`id`: 1, `na\"me`: 'a', `v`: null}, {`id`: 2, `na\"me`: null, `v`: 2.5}] AS row CREATE (n:`t`) SET n = row;"]
    assert statements.batches(df.limit(0), "t").collect() == []
    with pytest.raises(ValueError, match="only PostgreSQL"):
        statements.batches(df, "t", "mysql", unnest=True)
    with pytest.raises(ValueError, match="flatten"):
        statements.batches(df.select(F.array("id").alias("a")), "t", unnest=True)


def test_create_table():
    columns = [Column("id", Type.of("int64")), Column("price", Type.of("decimal(10,2)")), Column("tags", Type.of("array<text>"), False)]
    assert statements.create_table("t", columns, ["id"]) == 'CREATE TABLE "t" (\n  "id" BIGINT NOT NULL,\n  "price" NUMERIC(10, 2) NULL,\n  "tags" TEXT[] NOT NULL,\n  PRIMARY KEY ("id")\n);'
    assert statements.create_table("t", columns[:2], ["id"], "mysql", "id") == "CREATE TABLE `t` (\n  `id` BIGINT NOT NULL AUTO_INCREMENT,\n  `price` DECIMAL(10, 2) NULL,\n  PRIMARY KEY (`id`)\n);"


# nested comparison


def paths(spark, declared, expected, actual, was, came=None):
    e = spark.createDataFrame([(1, expected)], f"k int, v {was}")
    a = spark.createDataFrame([(1, actual)], f"k int, v {came or was}")
    return verify.compare(e, a, ["k"], {"v": Type.of(declared)}).first().paths


LINES = "array<struct<n:int32,price:decimal(10,2),tags:set>>"
ROWS = "array<struct<n:int,price:decimal(10,2),tags:array<string>>>"
TEXT = "array<struct<n:int,price:string,tags:array<string>>>"


def test_nested_paths(spark):
    d = Decimal
    a = [(1, d("1.00"), ["x", "y", "x"]), (2, d("2.00"), None), None]
    check = lambda b, came=None: paths(spark, LINES, a, b, ROWS, came)
    assert check([(1, d("1.00"), ["x", "x", "y"]), (2, d("2.00"), None), None]) == []
    assert check([(1, d("1.00"), ["x", "y", "y"]), (2, d("2.01"), None), None]) == ["v[0].tags"]
    assert check([(1, d("1.00"), ["y", "x", "x"]), (2, d("2.01"), None), None]) == ["v[1].price"]
    assert check([(1, d("1.00"), ["y", "x", "x"]), (2, d("2.00"), []), None]) == ["v[1].tags"]
    assert check(a[:2]) == ["v[2]"] and check([*a, None]) == ["v[3]"] and check([]) == ["v[0]"] and check(None) == ["v"]
    assert check([(1, "1.00", ["x", "y", "x"]), (2, "2.00", None), None], TEXT) == ["v[0].price"]  # a decimal must not come as text
    assert paths(spark, "array<array<int32>>", [[1, 2], [3]], [[1, 2], [4]], "array<array<int>>", "array<array<bigint>>") == ["v[1][0]"]


def test_fields_that_one_side_lacks(spark):
    declared = "struct<a:int32,b:text>"
    assert paths(spark, declared, (1, None), (1,), "struct<a:int,b:string>", "struct<a:int>") == []
    assert paths(spark, declared, (1, "x"), (1,), "struct<a:int,b:string>", "struct<a:int>") == ["v.b"]
    more = "struct<a:int,b:string,c:int>"
    assert paths(spark, declared, (1, "x"), (1, "x", None), "struct<a:int,b:string>", more) == []
    assert paths(spark, declared, (1, "x"), (1, "x", 0), "struct<a:int,b:string>", more) == ["v.c"]


def test_kinds(spark):
    same = lambda kind, e, a, was, came=None: paths(spark, kind, e, a, was, came) == []
    assert same("decimal(10,2)", "1.5", 1.5004, "string", "double") and not same("decimal(10,2)", "1.5", "1.5", "string")
    assert not same("decimal(10,2)", "x", 1.5, "string", "double")
    assert same("int8", 3, 3, "tinyint", "bigint") and not same("int8", 3, 3.5, "tinyint", "double") and not same("int32", 3, "3", "int", "string")
    assert same("bool", True, True, "boolean") and not same("bool", True, 1, "boolean", "int")
    assert same("float64", 1.0, 1.0 + 1e-12, "double") and not same("float64", 1.0, 1.0 + 1e-8, "double") and same("float32", 1.0, 1.0 + 1e-8, "float", "double")
    assert same("date", dt.date(2024, 1, 2), "2024-01-02", "date", "string") and not same("date", dt.date(2024, 1, 2), "2024-01-03", "date", "string")
    assert same("uuid", "AB", "ab", "string") and not same("text", "AB", "ab", "string") and not same("text", "1", 1, "string", "int")
    assert same("text", None, None, "string") and not same("text", "", None, "string") and not same("set", ["a"], "a", "array<string>", "string")
    assert same("bytes", b"a", b"a", "binary") and not same("bytes", b"a", "a", "binary", "string")


def test_documents(spark):
    check = lambda e, a, came=None: paths(spark, "json", e, a, "string", came)
    assert check('{"a": 1, "b": [1, {"c": 2}]}', '{"b":[1.0,{"c":2}],"a":1.0}') == []
    assert check('{"a": 1, "b": [1, {"c": 2}]}', '{"b":[1.0,{"c":3}],"a":1}') == ["v.b"]
    assert check('{"a": "1"}', '{"a": 1}') == ["v.a"] and check('{"a": null}', "{}") == ["v.a"] and check("[1, 2]", "[2, 1]") == ["v"]
    assert check("no json", "no json") == [] and check("no json", "other") == ["v"]
    assert check('{"n": 1, "t": ["x"]}', (1, ["x"]), "struct<n:int,t:array<string>>") == []


def test_declared_structs():
    t = Type.of("array<struct<a: decimal(10,2), b: struct<c: array<int>, d: enum(x,y)>>>")
    assert t.item.fields[1].type.fields[0].type.item.name == "int32" and t.item.fields[0].type.args == (10, 2) and t.sink() == "array<object>"
    assert t.spark().elementType["b"].dataType["c"].dataType == T.ArrayType(T.IntegerType())
