"""Polled tables as a stream, over a database that is a file."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from driftline.sources import polled
from driftline.streaming import runner

SCHEMA = "_table string, id long, _op string, _pos long, val string"


@pytest.fixture
def base(tmp_path):
    path = str(tmp_path / "base.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE audit (seq INTEGER PRIMARY KEY, id INTEGER, op TEXT, val TEXT)")
        c.execute("CREATE TABLE node (at INTEGER, id INTEGER)")
        c.execute("CREATE TABLE edge (at INTEGER, id INTEGER)")
    return path


def put(path, sql, rows):
    with sqlite3.connect(path) as c:
        c.executemany(sql, rows)


def audit(path, numbers):
    put(path, "INSERT INTO audit VALUES (?, ?, ?, ?)", [(n, n % 5, "u", f"v{n}") for n in numbers])


AUDIT = {"name": "audit", "query": "SELECT seq AS _pos, id, op AS _op, val FROM audit", "order": ["_pos"]}


@pytest.mark.parametrize("rows,parts", [(None, 1), (7, 3)])
def test_restarts_repeat_and_lose_nothing(spark, tmp_path, base, rows, parts):
    audit(base, range(1, 30))
    target = runner.Target(spark, str(tmp_path / "t"), ["id"])
    batches = []

    def go(crash=None):
        stream = polled.stream(spark, SCHEMA, {"module": "sqlite3", "args": [base]}, [AUDIT], str(tmp_path / "c"), rows, parts)

        def fail(number):
            batches.append(number)
            if number == crash:
                raise RuntimeError("lost")

        query = runner.sync(stream, target, str(tmp_path / "c"), fail=fail, processingTime="50 milliseconds")
        try:
            query.processAllAvailable()
        except Exception:
            assert crash is not None
        finally:
            query.stop()

    go(crash=0 if rows is None else 2)
    audit(base, range(30, 50))
    go()
    audit(base, range(50, 61))
    go()
    seen = target.head()["seen"][str(tmp_path / "c")]
    assert seen == 60  # each row once
    assert sorted((r.id, r.val) for r in target.rows().collect()) == [(i, f"v{max(n for n in range(1, 61) if n % 5 == i)}") for i in range(5)]
    if rows:
        assert len(batches) >= 60 // rows


def test_two_cursors_with_ties(spark, tmp_path, base):
    put(base, "INSERT INTO node VALUES (?, ?)", [(n // 4, n) for n in range(20)])  # four at each instant
    put(base, "INSERT INTO edge VALUES (?, ?)", [(n, 100 + n) for n in range(3)])
    tables = [{"name": t, "query": f"SELECT at AS _pos, id, 'c' AS _op, NULL AS val FROM {t}", "order": ["_pos", "id"]} for t in ("node", "edge")]
    stream = polled.stream(spark, SCHEMA, {"module": "sqlite3", "args": [base]}, tables, str(tmp_path / "c"), 3)
    got = []
    query = stream.writeStream.foreachBatch(lambda df, n: got.append([tuple(r)[:2] for r in df.collect()])).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="50 milliseconds").start()
    try:
        query.processAllAvailable()
        put(base, "INSERT INTO edge VALUES (?, ?)", [(2, 110), (0, 111)])  # a tie is seen, a row before the cursor isn't
        query.processAllAvailable()
    finally:
        query.stop()
    rows = [r for b in got for r in b]
    assert sorted(rows) == sorted([("node", n) for n in range(20)] + [("edge", 100), ("edge", 101), ("edge", 102), ("edge", 110)])
    assert all(sum(t == "node" for t, _ in b) <= 3 for b in got)


def test_acknowledged_after_the_sink(spark, tmp_path, base):
    audit(base, range(1, 10))
    table = {**AUDIT, "acknowledge": "DELETE FROM audit WHERE seq <= ?"}
    stream = polled.stream(spark, SCHEMA, {"module": "sqlite3", "args": [base]}, [table], str(tmp_path / "c"))
    target = runner.Target(spark, str(tmp_path / "t"), ["id"])
    query = runner.sync(stream, target, str(tmp_path / "c"), processingTime="50 milliseconds")
    try:
        query.processAllAvailable()
        audit(base, [20])
        query.processAllAvailable()
    finally:
        query.stop()
    with sqlite3.connect(base) as c:
        assert c.execute("SELECT count(*) FROM audit WHERE seq < 20").fetchone() == (0,)
    assert target.all().agg(F.count(F.lit(1))).first()[0] == 5


def test_an_empty_table_and_a_start(spark, tmp_path, base):
    connect = {"module": "sqlite3", "args": [base]}
    stream = polled.stream(spark, SCHEMA, connect, [{**AUDIT, "since": [5]}], str(tmp_path / "c"))
    got = []
    query = stream.writeStream.foreachBatch(lambda df, n: got.extend(r["_pos"] for r in df.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="50 milliseconds").start()
    try:
        query.processAllAvailable()
        audit(base, range(1, 9))
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(got) == [6, 7, 8]
