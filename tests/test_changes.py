from pyspark.sql import functions as F

from driftline.operators import changes, temporal, verify


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


LOG = "id int, _op string, _pos int, val string"


def test_fold_and_apply(spark):
    log = spark.createDataFrame([(1, "c", 1, "a"), (1, "u", 3, "c"), (1, "u", 2, "b"), (2, "c", 4, "x"), (2, "d", 5, None)], LOG)
    assert rows(changes.fold(log, ["id"]).select("id", "val"), "id") == [(1, "c")]
    target = spark.createDataFrame([(2, "old"), (3, "kept")], "id int, val string")
    assert rows(changes.apply(target, log, ["id"]), "id") == [(1, "c"), (3, "kept")]


def chunk(spark):
    return spark.createDataFrame([(i, f"v{i}") for i in (1, 2, 3)], "id int, val string")


def test_log_wins_in_window(spark):
    log = spark.createDataFrame([(2, "u", 11, "log2"), (3, "d", 12, None), (4, "c", 13, "new4")], LOG)
    assert rows(changes.reconcile(chunk(spark), log, ["id"], 10, 20), "id") == [(1, "v1"), (2, "log2"), (4, "new4")]


def test_delete_after_high(spark):
    log = spark.createDataFrame([(2, "d", 21, None)], LOG)
    assert rows(changes.reconcile(chunk(spark), log, ["id"], 10, 20), "id") == [(1, "v1"), (3, "v3")]


def test_before_low_is_overwritten(spark):
    log = spark.createDataFrame([(2, "u", 5, "stale"), (3, "d", 6, None)], LOG)
    assert rows(changes.reconcile(chunk(spark), log, ["id"], 10, 20), "id") == [(1, "v1"), (2, "v2"), (3, "v3")]


def test_unchanged(spark):
    assert rows(changes.reconcile(chunk(spark), spark.createDataFrame([], LOG), ["id"], 10, 20), "id") == [(1, "v1"), (2, "v2"), (3, "v3")]


def test_keep_before(spark):
    log = spark.createDataFrame([(1, "c", 1, "a"), (1, "u", 2, None), (1, "d", 3, None), (1, "c", 4, None), (1, "u", 5, None)], LOG)
    assert [r[-1] for r in rows(changes.keep_before(log, ["id"], ["val"]), "_pos")] == ["a", "a", None, None, None]


def test_chunks_cover_once_and_resume(spark):
    df = spark.range(25).select((F.col("id") % 5).alias("a"), F.col("id").alias("b"))
    parts = [(rows(p, "a", "b"), last) for p, last in changes.chunks(df, ["a", "b"], 7)]
    assert [len(p) for p, _ in parts] == [7, 7, 7, 4]
    assert sum((p for p, _ in parts), []) == rows(df, "a", "b")
    rest = [r for p, _ in changes.chunks(df, ["a", "b"], 7, parts[1][1]) for r in rows(p, "a", "b")]
    assert rest == rows(df, "a", "b")[14:]


def test_keyset_is_pushed_to_the_scan(spark, tmp_path, capsys):
    spark.range(100).select("id", (F.col("id") % 7).alias("b")).write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).where(changes.after(["b", "id"], [3, 10])).explain("formatted")
    pushed = next(x for x in capsys.readouterr().out.splitlines() if "PushedFilters" in x)
    assert "Or(GreaterThan(b,3),And(" in pushed and "EqualTo(b,3)" in pushed and "GreaterThan(id,10)" in pushed


def test_temporal(spark):
    rows_ = spark.createDataFrame([(1, "s", "e", "x", 1), (1, "s", "e", "x", 2), (1, "s", "e", "y", 3)], "id int, s string, e string, v string, n int")
    got = temporal.version_ids(rows_, ["id"], "s", "e", {"v": F.to_json(F.struct("v"))}, [F.col("n")])
    assert [r.duplicate for r in got.orderBy("n").collect()] == [0, 1, 0]
    assert spark.sql("select timestamp '9999-12-31' t").select(temporal.open_period(F.col("t")).alias("o")).first().o


def test_verify(spark):
    a = spark.createDataFrame([(1, 1.0, ["a", "b"], '{"x":1}'), (2, 2.0, None, None), (3, None, [], "1")], "id int, f double, s array<string>, j string")
    b = spark.createDataFrame([(1, 1.0 + 1e-12, ["b", "a"], '{"x": 1}'), (2, 2.1, None, None), (4, 1.0, [], "1")], "id int, f double, s array<string>, j string")
    got = verify.compare(a, b, ["id"], {"f": "float64", "s": "set", "j": "json"})
    assert [(r.id, r.status, r.fields) for r in got.orderBy("id").collect()] == [(1, "matched", []), (2, "mismatched", ["f"]), (3, "missing", None), (4, "extra", None)]
    assert verify.report(got).first().pass_rate == 1 / 3
    assert verify.report(got.limit(0)).first().pass_rate == 1.0


def test_as_of_and_rename(spark):
    events = spark.createDataFrame([(1, 10), (1, 20), (2, 5)], "t int, pos int")
    maps = spark.createDataFrame([(1, 5, "m1"), (1, 15, "m2")], "t int, pos int, name string")
    assert rows(changes.as_of(events, maps, "t", "pos", ["name"]), "t", "pos") == [(1, 10, "m1"), (1, 20, "m2"), (2, 5, None)]
    log = spark.createDataFrame([("old",), ("other",)], "_table string")
    assert {r[0] for r in changes.renamed(log, {"old": "new"}).collect()} == {"new", "other"}


def test_ordinals_of_a_hot_version(spark):
    """A version that most rows hold, with a null in its period, is numbered through all ranges, and so are those beside it."""
    versions = spark.range(2000).selectExpr("id AS n", "IF(id % 10 = 3, 'b', 'a') AS v", "'k' AS k", "'s' AS s", "CAST(NULL AS STRING) AS e")
    got = temporal.version_ids(versions, ["k"], "s", "e", {"v": F.to_json(F.struct("v"))}, [F.col("n").desc()])
    assert got.columns == [*versions.columns, "version_hash", "duplicate", "version_id"]
    seen = {"a": 0, "b": 0}
    for r in got.orderBy(F.col("n").desc()).collect():
        assert r.duplicate == seen[r.v]
        seen[r.v] += 1
    assert seen == {"a": 1800, "b": 200} and temporal.version_ids(versions.limit(0), ["k"], "s", "e", {"v": F.col("v")}, [F.col("n")]).count() == 0
