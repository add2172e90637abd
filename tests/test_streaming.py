import time

import pytest
from pyspark.sql import functions as F

from driftline.operators.changes import fold
from driftline.plans.transforms import Options, Pipeline
from driftline.streaming import runner
from driftline.streaming.state import CatchUp, Checkpoints, Signals, Snapshot, Store

LOG = "id int, _op string, _pos int, val string"


def batches(spark, path):
    """Four files whose positions are out of order."""
    log = [(i % 7, "d" if i % 5 == 0 else "u", i, f"v{i}") for i in range(40)]
    for k in range(4):
        spark.createDataFrame(log[k::4][::-1], LOG).coalesce(1).write.mode("append").parquet(str(path))
    return spark.createDataFrame(log, LOG)


def test_restart_after_a_crash_behind_the_write(spark, tmp_path):
    log = batches(spark, tmp_path / "in")
    target = runner.Target(spark, str(tmp_path / "t"), ["id"])
    stream = lambda: spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def crash(number):
        if number == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception):
        runner.sync(stream(), target, str(tmp_path / "c"), fail=crash).awaitTermination()
    runner.sync(stream(), target, str(tmp_path / "c")).awaitTermination()
    want = sorted((r.id, r.val) for r in fold(log, ["id"]).collect())
    assert sorted((r.id, r.val) for r in target.rows().collect()) == want


def test_skip_policy(spark, tmp_path):
    batches(spark, tmp_path / "in")
    target = runner.Target(spark, str(tmp_path / "t"), ["id"])

    def fail(number):
        raise RuntimeError("bad batch")

    stream = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
    runner.sync(stream, target, str(tmp_path / "c"), Pipeline(options=Options(failure_policy="skip")), fail=fail).awaitTermination()
    assert target.head()["skipped"] == {str(tmp_path / "c"): [0]}


def test_snapshot_resumes_and_takes_signals(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(1, 8)], "id int, val string")
    log = spark.createDataFrame([("users", 2, "u", 1, "log2"), ("users", 7, "d", 3, None), ("users", 9, "c", 4, "new9")], "_table string, " + LOG)
    out = []
    marks = iter(range(1, 1000, 2))

    def emit(name, part):
        out.append((name, part.collect()))
        if len(out) == 2:
            raise RuntimeError("stopped")

    position = lambda: next(marks)
    with pytest.raises(RuntimeError):
        runner.snapshot({"users": (rows, ["id"])}, log, store, emit, position, size=3)
    assert Snapshot.load(store).last_keys == {"users": [3]}
    runner.snapshot({"users": (rows, ["id"])}, log, store, emit, position, size=3)
    every = [r for _, part in out for r in part]
    assert {r.id for r in every} >= {1, 2, 3, 4, 5, 6, 7, 9}
    assert Snapshot.load(store).done == ["users"] and store.get("snapshot_handoff")
    signals = Signals(store)
    signals.request("a", ["users"])
    assert signals.pending() == [("a", ["users"])]
    signals.acknowledge("a")
    assert signals.pending() == []


def test_catch_up():
    c = CatchUp().merge(["b", "a"], 5).merge(["c"], 3)
    assert c == CatchUp(5, ["a", "b", "c"]) and c.prune(["a", "z"]).tables == ["a"] and c.pending(["a", "z"]) == ["z"]


def test_a_value_survives_a_crash_between_two_puts(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    assert store.get("x") is None
    store.put("x", {"n": 1})
    (tmp_path / "s" / "x.000000000001.part").write_text('{"n"')  # a writer that stopped before the rename
    assert store.get("x") == {"n": 1}
    store.put("x", {"n": 2})
    (tmp_path / "s" / "x.000000000000.json").write_text('{"n": 1}')  # one that stopped before the old one went
    assert store.get("x") == {"n": 2}
    store.put("x", {"n": 3})
    assert store.get("x") == {"n": 3} and [f.name for f in (tmp_path / "s").glob("x.*.json")] == ["x.000000000002.json"]


def rows_at(spark, ids, pos):
    return spark.createDataFrame([(i, "u", pos, f"v{pos}") for i in ids], "id long, _op string, _pos long, v string")


def test_a_merge_writes_what_it_changes(spark, tmp_path):
    target = runner.Target(spark, str(tmp_path / "t"), ["id"])
    assert target.rows() is None and target.all() is None
    target.merge(spark.range(200_000).selectExpr("id", "'u' AS _op", "1L AS _pos", "uuid() AS v"))
    whole = target.head()["runs"][0]["bytes"]
    target.merge(spark.range(0, 200_000, 100).selectExpr("id", "'u' AS _op", "2L AS _pos", "uuid() AS v"))
    assert target.head()["runs"][1]["bytes"] < whole / 50  # one key in a hundred
    target = runner.Target(spark, str(tmp_path / "u"), ["id"])
    target.merge(rows_at(spark, range(5000), 1))
    target.merge(rows_at(spark, range(50), 2))
    target.merge(rows_at(spark, range(50), 2))  # replayed
    target.merge(spark.createDataFrame([(3, "d", 5), (4, "u", 0)], "id long, _op string, _pos long"))
    want = {i: "v2" if i < 50 else "v1" for i in range(5000) if i != 3}
    assert {r.id: r.v for r in target.rows().collect()} == want
    target.merge(rows_at(spark, [], 9))
    for pos in range(10, 40):
        target.merge(rows_at(spark, [pos], pos))
    assert {r.id: r.v for r in target.rows().collect()} == want | {p: f"v{p}" for p in range(10, 40)}
    assert len(target.head()["runs"]) < 12 and target.head()["runs"][0]["rows"] == 5000  # the large run was left alone
    assert len(list((tmp_path / "u").glob("run-*"))) <= 40


def test_changes_in_any_order_of_runs(spark, tmp_path):
    import itertools

    parts = [[(1, "c", 1, "a"), (2, "c", 2, "b"), (None, "c", 3, "n")], [(1, "u", 9, "z")], [(1, "u", 5, "late"), (2, "d", 4, None), (None, "u", 6, "m")]]
    for n, order in enumerate(itertools.permutations(parts)):
        target = runner.Target(spark, str(tmp_path / f"t{n}"), ["id"], fanout=2 + n % 3)
        for p in order:
            target.merge(spark.createDataFrame(p, "id int, _op string, _pos int, v string"))
        assert sorted(map(tuple, target.rows().collect()), key=str) == [(1, "z"), (None, "m")]


def test_two_writers_lose_nothing(spark, tmp_path):
    import threading

    failed = []

    def work(k):
        try:
            target = runner.Target(spark, str(tmp_path / "t"), ["id"], pause=0.01)
            for i in range(3):
                target.merge(rows_at(spark, [100 * k + i, 999], 10 * i + k))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    target = runner.Target(spark, str(tmp_path / "t"), ["id"])
    assert not failed
    assert {r.id: r.v for r in target.rows().collect()} == {100 * k + i: f"v{10 * i + k}" for k in range(2) for i in range(3)} | {999: "v21"}


def test_a_commit_that_comes_second_is_made_anew(spark, tmp_path):
    target = runner.Target(spark, str(tmp_path / "t"), ["id"], pause=0.0, attempts=2)
    store, other = target.store, []

    def first(now):
        if not other:
            other.append(store.put_new("commit", now["version"] + 1, {**now, "version": now["version"] + 1, "runs": [{"path": "x", "rows": 1}]}))
        return {"runs": [*now["runs"], {"path": "y", "rows": 1}]}

    assert [r["path"] for r in target.commit(first)["runs"]] == ["x", "y"]
    assert not store.put_new("commit", 2, {})
    with pytest.raises(TimeoutError):
        target.commit(lambda now: store.put_new("commit", now["version"] + 1, {**now, "version": now["version"] + 1}) and {})


# streams


def stream_of(spark, path, schema=LOG):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def written(spark, path, rows, files, schema=LOG):
    for k in range(files):
        spark.createDataFrame(rows[k * len(rows) // files : (k + 1) * len(rows) // files], schema).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.02)  # file sources go by time


@pytest.mark.parametrize("files", [1, 4])
def test_transforms_come_before_folds(spark, tmp_path, files):
    from driftline.plans.transforms import Stage

    log = [(1, "c", 1, "a"), (1, "u", 2, "drop"), (2, "c", 3, "b"), (2, "u", 4, "drop")]
    written(spark, tmp_path / "in", log, files)
    target = runner.Target(spark, str(tmp_path / "t"), ["id"])
    pipeline = Pipeline([Stage(lambda df: df.where("val <> 'drop'"))])
    runner.sync(stream_of(spark, tmp_path / "in"), target, str(tmp_path / "c"), pipeline).awaitTermination()
    assert sorted(map(tuple, target.rows().collect())) == [(1, "a"), (2, "b")]
    assert target.head()["seen"] == {str(tmp_path / "c"): 4}


def test_a_worker_that_answers_otherwise_the_second_time(spark, tmp_path):
    import uuid

    from driftline.plans.transforms import Stage

    calls = tmp_path / "calls"
    calls.mkdir()

    def rename(frames):
        for f in frames:
            for _ in range(len(f)):
                (calls / uuid.uuid4().hex).touch()
            yield f.assign(id=[uuid.uuid4().hex for _ in range(len(f))])

    target = runner.Target(spark, str(tmp_path / "t"), ["id"])
    written(spark, tmp_path / "in", [(i, "c", i, f"v{i}") for i in range(10)], 1)
    pipeline = Pipeline([Stage(lambda df: df.mapInPandas(rename, "id string, _op string, _pos int, val string"))])
    runner.sync(stream_of(spark, tmp_path / "in"), target, str(tmp_path / "c"), pipeline).awaitTermination()
    assert sorted(r.val for r in target.rows().collect()) == sorted(f"v{i}" for i in range(10))
    assert len(list(calls.iterdir())) == 10  # each row once


def test_a_replayed_batch_is_not_evaluated(spark, tmp_path):
    target = runner.Target(spark, str(tmp_path / "t"), ["id"])
    assert target.merge(rows_at(spark, [1], 1), "s", 0)
    bad = spark.range(1).selectExpr("raise_error('evaluated') AS v")
    assert not target.merge(bad, "s", 0)


def test_streams_end_where_they_are_told(spark, tmp_path):
    log = [(i, "c", i, f"v{i}") for i in range(1, 41)]
    written(spark, tmp_path / "in", log, 8)
    for n, (limits, want) in enumerate([(runner.Limits(until=18), 17), (runner.Limits(rows=12), 12), (runner.Limits(batches=3), 15), (runner.Limits(), 40)]):
        target, saved = runner.Target(spark, str(tmp_path / f"t{n}"), ["id"]), Checkpoints(Store(spark, str(tmp_path / f"p{n}")), "interval", 1e9, saved_at=time.monotonic())
        runner.run(stream_of(spark, tmp_path / "in"), target, str(tmp_path / f"c{n}"), limits, saved)
        assert sorted(r.id for r in target.rows().collect()) == list(range(1, want + 1))
        assert saved.store.get("catch_up_progress") == {"position": want}
        if limits.batches:  # the rest comes with the next run
            runner.run(stream_of(spark, tmp_path / "in"), target, str(tmp_path / f"c{n}"), runner.Limits())
            assert target.rows().count() == 40
    endless = spark.readStream.format("rate").load().selectExpr("value AS id", "'c' AS _op", "value AS _pos")
    began = time.time()
    runner.run(endless, runner.Target(spark, str(tmp_path / "t"), ["id"]), str(tmp_path / "c"), runner.Limits(seconds=1.5), continuous=True)
    assert time.time() - began < 30


def test_requests_to_a_running_stream(spark, tmp_path):
    written(spark, tmp_path / "in", [(1, "c", 1, "log1"), (2, "c", 2, "log2"), (3, "u", 7, "log3"), (2, "d", 8, None)], 2)
    signals = Signals(Store(spark, str(tmp_path / "s")))
    signals.request("a", ["users"])
    signals.request("b", [])
    asked = []

    def tables(names):
        asked.append(names)
        return spark.createDataFrame([(2, "table2"), (3, "table3"), (4, "table4")], "id int, val string")

    control = runner.Control(signals, tables, lambda: 5, lambda: asked.append("schema") or {})
    target = runner.Target(spark, str(tmp_path / "t"), ["id"])
    runner.sync(stream_of(spark, tmp_path / "in"), target, str(tmp_path / "c"), control=control).awaitTermination()
    assert asked == [["users"], "schema"] and signals.pending() == []
    # what the log says after the table was read wins, what it said before doesn't
    assert sorted(map(tuple, target.rows().collect())) == [(1, "log1"), (3, "log3"), (4, "table4")]


def test_metrics_of_streams_and_writes(spark, tmp_path):
    from driftline.streaming import metrics

    written(spark, tmp_path / "in", [(i, "c", i, "v") for i in range(20)], 2)
    log = metrics.MetricsLog(spark, str(tmp_path / "m"))
    listener = metrics.Listener(log)
    spark.streams.addListener(listener)
    try:
        rows = metrics.measured(stream_of(spark, tmp_path / "in"), F.octet_length("val"))
        rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        for _ in range(100):
            if log.rows == 20:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    metrics.timed(spark.range(5), lambda df: df.write.parquet(str(tmp_path / "o")), log, F.lit(8))
    got = [r.asDict() for r in spark.read.json(str(tmp_path / "m")).orderBy("rows_processed").collect()]
    assert [(r["rows_processed"], r["bytes_read"]) for r in got] == [(10, 10), (20, 20), (25, 60)]
    assert all(r["throughput_rows_per_sec"] > 0 and r["peak_memory_mb"] >= r["memory_mb"] > 0 for r in got) and [r["batch"] for r in got] == [0, 1, None]


# snapshots


def test_a_chunk_is_read_once_between_its_positions(spark, tmp_path):
    """Rows come to the table between any two looks at it; none that was there from the beginning is lost."""
    (tmp_path / "in").mkdir()
    at = [0]

    def add(ids):
        spark.createDataFrame([(i, f"v{i}") for i in ids], "id int, val string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def position():
        at[0] += 1
        add([1000 - at[0], 10 * at[0] + 5])
        return at[0]

    add(range(0, 100, 10))

    class Growing:
        """A table that is listed anew each time."""

    table = spark.read.schema("id int, val string")
    log = spark.createDataFrame([], "_table string, " + LOG)
    out = []

    class Fresh(dict):
        def __getitem__(self, name):
            return table.parquet(str(tmp_path / "in")), ["id"]

    runner.snapshot(Fresh(users=None), log, Store(spark, str(tmp_path / "s")), lambda n, part: out.extend(part.collect()), position, size=4)
    assert {r.id for r in out} >= set(range(0, 100, 10))


@pytest.mark.parametrize("own", [True, False])
def test_many_chunks_in_a_job(spark, tmp_path, own):
    """A snapshot of 40 chunks in three jobs, stopped after the first, is what one chunk at a time gives."""
    rows = spark.range(1, 200).selectExpr("id", "concat('t', id) AS val")
    log = spark.createDataFrame([("users", i * 7 % 230, "d" if i % 3 == 0 else "u", i, f"log{i}") for i in range(300)], "_table string, id long, _op string, _pos long, val string")
    said = lambda target: {r.id: (r["_op"], r["_pos"], r.val) for r in target.all().collect()}
    one, many = runner.Target(spark, str(tmp_path / "one"), ["id"]), runner.Target(spark, str(tmp_path / "many"), ["id"])
    store, jobs, times = Store(spark, str(tmp_path / "s")), [], iter([10, 20, 260, 260, 270])

    def emit(name, part):
        jobs.append(name)
        if len(jobs) == 2:
            raise RuntimeError("stopped")
        many.merge(part)

    marks = (lambda c: (20 + 5 * c, 24 + 5 * c)) if own else None
    args = ({"users": (rows, ["id"])}, log, store, emit, lambda: next(times))
    with pytest.raises(RuntimeError):
        runner.snapshot(*args, size=5, wave=16, marks=marks)
    assert Snapshot.load(store).last_keys == {"users": [80]} and Snapshot.load(store).chunks == {"users": 16}
    runner.snapshot(*args, size=5, wave=16, marks=marks)
    assert len(jobs) == 4 and Snapshot.load(store).chunks == {"users": 40} and Snapshot.load(store).done == ["users"]
    got = said(many)
    if own:
        at = iter([10] + [p for c in range(41) for p in (20 + 5 * c, 24 + 5 * c)])
        runner.snapshot({"users": (rows, ["id"])}, log, Store(spark, str(tmp_path / "s1")), lambda n, part: one.merge(part), lambda: next(at), size=5)
        assert got == said(one) and store.get("snapshot_handoff") == {"position": 219}
        return
    for i in range(230):  # the first 80 were read between 20 and 260, the others from 260 to 270
        low, high = (20, 260) if i <= 80 else (260, 270)
        events = [k for k in range(271) if k * 7 % 230 == i]
        last = max(events, default=None)
        kept = 1 <= i < 200 and not [k for k in events if low < k <= high] and (last is None or last <= high)
        want = ("c", high, f"t{i}") if kept else None if last is None else ("d" if last % 3 == 0 else "u", last, f"log{last}")
        assert got.get(i) == want, i


@pytest.mark.parametrize("waves,chunks", [(1, 1), (3, 7), (4, 1000)])
def test_chunks_side_by_side(spark, tmp_path, waves, chunks):
    from driftline.operators import snapshots

    rows = spark.range(1, 3000).selectExpr("id", "concat('t', id) AS val")
    log = spark.createDataFrame([("users", i * 7 % 3100, "d" if i % 3 == 0 else "u", i, f"log{i}") for i in range(400)], "_table string, id long, _op string, _pos long, val string")
    positions = iter(range(40, 10_000, 37))
    cuts = snapshots.bounds(rows, ["id"], chunks)
    store, target, marks = Store(spark, str(tmp_path / "s")), runner.Target(spark, str(tmp_path / "t"), ["id"]), []

    def position():
        marks.append(next(positions))
        return marks[-1]

    def once(name, part):
        target.merge(part)
        if waves > 1 and len(marks) == 5:
            raise RuntimeError("stopped")

    args = ("users", rows, ["id"], cuts, log, store)
    if waves > 1:
        with pytest.raises(RuntimeError):
            runner.parallel_snapshot(*args, once, position, waves)
    runner.parallel_snapshot(*args, once, position, waves)
    got = {r.id: r.val for r in target.rows().collect()}
    # a table that doesn't change and a log that does: every row has the log's last word from its wave's first position on, or its own
    number = {r.id: r.c for r in rows.select("id", snapshots.chunk_of(["id"], cuts, rows).alias("c")).collect()}
    assert max(number.values(), default=0) == len(cuts) and all(number[i] == sum(c[0] <= i for c in cuts) for i in range(1, 3000, 97))
    last = max(marks)
    for i in range(1, 3100):
        events = [k for k in range(400) if k * 7 % 3100 == i and marks[0] < k <= last]
        if not events and i < 3000:
            assert got[i] == f"t{i}"
    assert store.get("snapshot_handoff")["position"] <= last


def test_each_chunk_has_marks_of_its_own(spark):
    from driftline.operators import changes, snapshots

    rows = spark.range(300).selectExpr("id AS k", "id % 3 AS j", "'t' AS v")
    log = spark.range(1000).selectExpr("id * 7 % 320 AS k", "id % 3 AS j", "if(id % 5 = 0, 'd', 'u') AS _op", "id AS _pos", "concat('l', id) AS v")
    for n in (1, 9):
        cuts = snapshots.bounds(rows, ["k", "j"], n)
        marked = rows.withColumn("_chunk", snapshots.chunk_of(["k", "j"], cuts, rows))
        marks = spark.createDataFrame([(c, 90 * c, 90 * c + 300) for c in range(len(cuts) + 1)], "_chunk int, _low long, _high long")
        got = snapshots.reconcile_chunks(marked, log, ["k", "j"], cuts, marks)
        own = log.withColumn("_chunk", snapshots.chunk_of(["k", "j"], cuts, rows))
        want = [tuple(r) for c in range(len(cuts) + 1) for r in changes.reconcile(marked.where(f"_chunk = {c}").drop("_chunk"), own.where(f"_chunk = {c}").drop("_chunk"), ["k", "j"], 90 * c, 90 * c + 300).collect()]
        assert sorted(map(tuple, got.collect())) == sorted(want)


# state by key


def keyed_log():
    return [(i % 5, "c" if i % 17 == 0 else "d" if i % 13 == 0 else "u", i, None if i % 3 else 2**60 + i, None if i % 4 else f"s{i}") for i in range(200)]


KEYED = "id int, _op string, _pos int, n long, s string"


@pytest.mark.parametrize("files", [1, 3])
def test_last_images_over_batches_and_restarts(spark, tmp_path, files):
    from driftline.operators.changes import keep_before
    from driftline.streaming import keyed

    log = keyed_log()
    want = sorted(map(tuple, keep_before(spark.createDataFrame(log, KEYED), ["id"], ["n", "s"]).collect()), key=str)
    half = len(log) // 2
    for part in (log[:half], log[half:]):  # the second half comes after a restart
        written(spark, tmp_path / "in", part, files, KEYED)
        filled = keyed.keep_before(stream_of(spark, tmp_path / "in", KEYED), ["id"], ["n", "s"])
        filled.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert sorted(map(tuple, spark.read.schema(KEYED).parquet(str(tmp_path / "out")).collect()), key=str) == want


def test_ordinals_over_batches(spark, tmp_path):
    from driftline.streaming import keyed

    rows = [(i % 3, "x" if i % 2 else "y", i) for i in range(60)]
    schema = "id int, v string, at int"
    written(spark, tmp_path / "in", rows, 3, schema)
    made = keyed.ordinals(stream_of(spark, tmp_path / "in", schema), ["id", "v"], ["at"])
    made.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = {r.at: r.duplicate for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {i: sum(1 for j in range(i) if rows[j][:2] == rows[i][:2]) for i in range(60)}


def test_a_closed_key_is_forgotten(spark, tmp_path):
    from driftline.streaming import keyed

    def go(rows):
        written(spark, tmp_path / "in", rows, 1, KEYED)
        filled = keyed.keep_before(stream_of(spark, tmp_path / "in", KEYED), ["id"], ["n", "s"], forget=0.5)
        q = filled.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(once=True).start(str(tmp_path / "out"))
        assert q.awaitTermination(60)
        time.sleep(1)  # timers are looked at with the batches that come

    go([(1, "c", 1, 5, "a"), (1, "d", 2, 6, "b"), (2, "c", 3, 7, "open")])
    go([(3, "c", 4, 1, "x")])
    go([(1, "u", 5, None, None), (2, "u", 6, None, None)])
    got = {r["_pos"]: r.s for r in spark.read.schema(KEYED).parquet(str(tmp_path / "out")).collect()}
    assert got[5] is None and got[6] == "open"


def _worker(tmp_path, body):
    script = tmp_path / "worker.py"
    script.write_text("import sys, json, time\nwhile line := sys.stdin.readline():\n    head = json.loads(line)\n" + body)
    return ["python", str(script)]


def test_commands_that_hang_end_or_answer_early(spark, tmp_path):
    from driftline.plans import transforms

    df = spark.range(5000).selectExpr("id", "repeat('x', 200) AS t").coalesce(1)
    echo = "    print(line, end='')\n    for _ in range(head['count']):\n        print(sys.stdin.readline(), end='', flush=True)\n"
    assert transforms.command(_worker(tmp_path, echo), timeout=20.0, batch_size=2500).rows(df).count() == 5000  # more than a pipe holds, both ways
    for body in ("    time.sleep(60)\n", "    sys.exit(1)\n"):
        began = time.time()
        with pytest.raises(Exception):
            transforms.command(_worker(tmp_path, body), timeout=1.0).rows(spark.range(3).coalesce(1)).collect()
        assert time.time() - began < 20
    for text in ("[pipeline]\nmax_in_flight = 2", "[[transforms]]\ntype = 'command'\ncommand = ['cat']\n[transforms.stdio]\nframer = 'other'"):
        with pytest.raises(ValueError):
            transforms.load(text)
    assert transforms.load("[pipeline]\nbatch_max_wait = '250ms'").options.trigger() == {"processingTime": "250 milliseconds"}


def test_when_positions_are_saved(spark, tmp_path):
    saved = lambda store: (store.get("catch_up_progress") or {}).get("position")
    each, never, interval = (Checkpoints(Store(spark, str(tmp_path / p)), p, 10.0) for p in ("each", "never", "interval"))
    for now, pos in ((100.0, 5), (101.0, 4), (102.0, 7), (103.0, None)):
        for c in (each, never, interval):
            c.written(pos, now)
    assert (saved(each.store), saved(never.store), saved(interval.store)) == (7, None, 5)
    interval.written(9, 111.0)
    assert saved(interval.store) == 9
    interval.written(12, 112.0)
    interval.flush()
    assert saved(interval.store) == 12
    with pytest.raises(ValueError):
        Checkpoints(each.store, "often")


def test_renamed_tables_counts_and_positions_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "_table string, id long, _op string, _pos long, v string"
    spark.createDataFrame([("old", 1, "c", 1, "a"), ("new", 1, "u", 2, "b"), ("old", 2, "c", 3, "c")], schema).coalesce(1).write.mode("overwrite").json(str(tmp_path / "in"))
    target = runner.Target(spark, str(tmp_path / "t"), ["_table", "id"])
    saved = Checkpoints(Store(spark, str(tmp_path / "p")))
    runner.sync(spark.readStream.schema(schema).json(str(tmp_path / "in")), target, str(tmp_path / "c"), checkpoints=saved, names={"old": "new"}).awaitTermination()
    assert sorted((r["_table"], r.id, r.v) for r in target.rows().collect()) == [("new", 1, "b"), ("new", 2, "c")]
    assert target.head()["seen"] == {str(tmp_path / "c"): 3} and saved.store.get("catch_up_progress") == {"position": 3}
