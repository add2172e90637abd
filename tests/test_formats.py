"""Files, messages, catalogs, sinks and scalars: round trips, refusals and the cases between."""

import json
import re
import struct

import duckdb
import pytest
from pyspark.sql import functions as F

from driftline.functions import casts, ids, json_diff, scalars
from driftline.operators import changes
from driftline.schema import Column, Table, Type
from driftline.sinks import files as sinks
from driftline.sinks import values
from driftline.sources import catalogs, cells, changelog, files, generate, kafka, protobuf
from driftline.staging import importable


@pytest.fixture(autouse=True, scope="module")
def ready(spark):
    importable(spark)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def many(spark, f, texts):
    return [r.x for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


def test_bytes_and_escapes(spark):
    assert many(spark, scalars.hex_bytes, ["00ff", "0aF", "zz", "", None]) == [b"\x00\xff", None, None, b"", None]
    a, b = many(spark, scalars.lsn_bytes, ["0x0000002A000001F80003", "0000002A:000001F8:0004"])
    assert a < b and len(a) == 10 and many(spark, scalars.lsn_bytes, ["0x00"]) == [None]
    assert many(spark, scalars.csv_cell, ["a", 'a"b', "a,b", "a\nb", None, ""]) == ["a", '"a""b"', '"a,b"', '"a\nb"', "", ""]
    assert many(spark, scalars.quoted_text, ["it's", "a\\b", "x\ny", None]) == ["'it\\'s'", "'a\\\\b'", "'x\\ny'", None]
    assert one(spark, scalars.base64_text(F.lit(b"x" * 100))).count("\n") == 0


def test_epochs_and_durations(spark):
    assert many(spark, lambda c: scalars.epoch_day(c).cast("string"), ["0", "-1", "19737", "x"]) == ["1970-01-01", "1969-12-31", "2024-01-15", None]
    assert many(spark, lambda c: scalars.epoch_nanos(c).cast("string"), ["1.5", "-1.25", "-0.5", "7", "0.1234567891", "1.", "a"]) == ["1500000000", "-1250000000", "-500000000", "7000000000", "123456789", "1000000000", None]
    assert many(spark, lambda c: F.unix_micros(scalars.epoch_timestamp(c)), ["1.000001999 1440", "-0.0000001"]) == [1000001, -1]
    assert many(spark, scalars.epoch_time, ["3661.5", "0", "86400", "59.000000001"]) == ["01:01:01.5", "00:00:00", None, "00:00:59"]
    assert many(spark, lambda c: scalars.duration_text(c.cast("decimal(28,9)")), ["5", "1.5"]) == ["PT5S", "PT1.500000000S"]
    assert one(spark, F.unix_micros(scalars.local_to_utc(F.lit("2024-07-01 12:00:00"), "Europe/Berlin")) - F.unix_micros(F.lit("2024-07-01 10:00:00").cast("timestamp"))) == 0


def test_days_and_epochs_of_many_digits(spark, tmp_path):
    """Years of five digits are written as SQL writes them, and days may have as many digits as an int."""
    from driftline.plans import catalogue

    assert many(spark, lambda c: catalogue.day(scalars.epoch_day(c)), ["2932896", "2932897", "-1", "12345678", "99999999999"]) == ["9999-12-31", "10000-01-01", "1969-12-31", duckdb.sql("SELECT strftime(DATE '1970-01-01' + 12345678, '%Y-%m-%d')").fetchall()[0][0], None]
    duckdb.sql(f"COPY (SELECT CAST(unnest([0, 499, 2933397, 6000000, 23456789]) AS BIGINT) AS event_id) TO '{tmp_path}/events.parquet'")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    columns = ["event_id", "day", "micros", "clock"]
    assert sorted(map(tuple, catalogue.QUERIES["epoch_cells"](spark, str(tmp_path)).select(columns).collect())) == sorted(db.sql(f"SELECT {', '.join(columns)} FROM ({catalogue.SQL['epoch_cells']})").fetchall())


def test_maps_and_ulids(spark):
    m = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    assert one(spark, scalars.renamed_keys(m, {"a": "z"})) == {"z": 1, "b": 2} and one(spark, scalars.without_keys(m, "a")) == {"b": 2}
    a, again, b = (one(spark, ids.ulid(1700000000000, F.lit(x))) for x in ("s", "s", "t"))
    assert a == again != b and len(a) == 26 and a[:10] == "01HF7YAT00" and not set(a) & set("ILOU")


def test_timestamps_of_three_kinds(spark):
    texts = ["2024-01-15 10:30:00.5+02", "12/17/1997 07:37:16.00 PST", "Wed Dec 17 07:37:16 1997 PST", "1997-12-17T15:37:16Z", "13/45/1997 07:37:16 PST", "Wed Foo 17 07:37:16 1997 PST", "12/17/1997 07:37:16 XYZ"]
    got = many(spark, lambda c: F.unix_seconds(casts.pg_timestamptz(c)), texts)
    assert got[1] == got[2] == got[3] == 882373036 and got[0] == 1705307400 and got[4:] == [None] * 3


def test_cells_of_a_postgres_log(spark):
    table = Table("t", Column("id", Type("int64")), tuple(Column(n, Type.of(k)) for n, k in [("tags", "array<int>"), ("price", "decimal(10,2)"), ("raw", "bytes"), ("wait", "duration"), ("at", "timestamptz"), ("doc", "json"), ("ok", "bool"), ("grid", "array<text>")]))
    cells = {"id": 7, "tags": "{1,NULL,3}", "price": "12.50", "raw": "\\x00ff", "wait": "1 day 00:00:01", "at": "2024-01-15 10:30:00+00", "doc": '{"a": 1}', "ok": True, "grid": "{{1,2},{3,4}}"}
    line = json.dumps({"action": "I", "schema": "public", "table": "t", "columns": [{"name": k, "type": "x", "value": v} for k, v in cells.items()]})
    other = json.dumps({"action": "B"})
    r = changelog.pg_cells(changelog.from_wal2json(spark.createDataFrame([(1, line), (2, other)], "_pos long, value string")), table).collect()
    assert len(r) == 1 and r[0]._id == ["7"] and r[0].id == 7 and r[0].tags == [1, None, 3] and str(r[0].price) == "12.50" and bytes(r[0].raw) == b"\x00\xff" and r[0].wait == 86401.0 and r[0].ok and r[0].grid == ["{1,2}", "{3,4}"]


def test_pgoutput_renames_and_truncates(spark):
    layout = [("id", True), ("v", False)]
    relations = spark.createDataFrame([(0, 1, "a", layout), (10, 1, "b", layout)], "_pos long, relation_id int, name string, columns array<struct<name:string,key:boolean>>")
    messages = spark.createDataFrame([(1, "I", 1, None, ["5", "x"]), (11, "U", 1, ["5", None], ["6", "y"]), (12, "T", 1, None, None), (13, "D", 1, ["6", None], None)], "_pos long, kind string, relation_id int, old array<string>, new array<string>")
    log, notes = changelog.from_pgoutput(messages, relations)
    assert [(r._table, r._op, r._id) for r in log.orderBy("_pos").collect()] == [("a", "c", ["5"]), ("b", "u", ["5"]), ("b", "d", ["6"])]
    assert [(r._pos, r.what, r._table, r.was) for r in notes.orderBy("_pos").collect()] == [(10, "rename", "b", "a"), (12, "truncate", "b", None)]


@pytest.mark.parametrize("op, path, value, want", [
    ("replace", "$.a", "2", {"a": 2, "l": [1, {"b c": 1}]}), ("insert", "$.a", "2", {"a": 1, "l": [1, {"b c": 1}]}), ("insert", "$.n", '{"x":null}', {"a": 1, "l": [1, {"b c": 1}], "n": {"x": None}}),
    ("remove", "$.a", None, {"l": [1, {"b c": 1}]}), ("replace", '$.l[1]."b c"', "[]", {"a": 1, "l": [1, {"b c": []}]}), ("insert", "$.l[0]", "0", {"a": 1, "l": [0, 1, {"b c": 1}]}),
    ("insert", "$.l[9]", "0", {"a": 1, "l": [1, {"b c": 1}, 0]}), ("insert", "$.no.where", "0", {"a": 1, "l": [1, {"b c": 1}]}), ("replace", "$", "3", 3), ("remove", "$", None, None),
    ("replace", "$.zz", "1", ValueError), ("remove", "$.no.where", None, ValueError), ("replace", "$.l[7]", "1", ValueError), ("replace", "a", "1", ValueError), ("replace", "$.a[0]", "1", ValueError),
])
def test_json_changes(op, path, value, want):
    root = {"a": 1, "l": [1, {"b c": 1}]}
    if want is ValueError:
        with pytest.raises(ValueError):
            json_diff.changed(root, op, path, value and json.loads(value))
    else:
        assert json_diff.changed(root, op, path, value and json.loads(value)) == want


def test_json_diffs_in_order(spark):
    kind = "array<struct<op:string,path:string,value:string>>"
    rows = [(0, '{"a":1}', [("insert", "$.b", "2"), ("remove", "$.a", None)]), (1, None, [("replace", "$", "[]")]), (2, '{"é":1}', None)]
    got = spark.createDataFrame(rows, f"i int, d string, c {kind}").select("i", json_diff.apply_diffs(F.col("d"), F.col("c")).alias("x")).orderBy("i").collect()
    assert [r.x for r in got] == ['{"b":2}', "[]", '{"é":1}']


def test_csv_of_any_name_and_back(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x.y,id,n\n"q""1",1,5\n,2,no\n"a\nb",3,\n')
    table = Table("a", Column("id", Type("int64")), (Column("n", Type("int32")), Column("x.y", Type("text"))))
    read = files.read_csv(spark, str(tmp_path / "a.csv"), table, id_columns=["id"])
    rows = sorted(read.collect(), key=lambda r: r.id)
    assert [(r["_id"], r["x.y"], r["n"], r["_raw_n"]) for r in rows] == [("1", 'q"1', 5, None), ("2", None, None, "no"), ("3", "a\nb", None, None)]
    free = files.read_csv(spark, str(tmp_path / "a.csv"))
    first = [r["_id"] for r in free.collect()]
    assert first == [r["_id"] for r in free.collect()] and len(set(first)) == 3
    sinks.write_csv(read.select("id", "`x.y`", F.lit(b"z").alias("b"), F.array(F.lit(1)).alias("l")), str(tmp_path / "out"))
    back = files.read_csv(spark, f"{tmp_path}/out/", Table("a", Column("id", Type("int64")), (Column("b", Type("bytes")), Column("l", Type.of("array<int>")))), id_columns=["id", "b"])
    assert sorted((r.id, bytes(r.b), r.l) for r in back.collect()) == [(1, b"z", [1]), (2, b"z", [1]), (3, b"z", [1])]
    assert sinks.dry_run(read) == 3
    with pytest.raises(Exception):
        sinks.dry_run(read.withColumn("bad", F.raise_error(F.lit("no"))))


def test_a_file_by_http(spark, tmp_path):
    import functools
    import http.server
    import threading

    (tmp_path / "a.csv").write_text("id,v\n1,x\n2,y\n")
    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(http.server.SimpleHTTPRequestHandler, directory=str(tmp_path))) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        got = files.read_csv(spark, f"http://127.0.0.1:{server.server_port}/a.csv", id_columns=["id"])
        assert sorted((r["_id"], r.v) for r in got.collect()) == [("1", "x"), ("2", "y")]
        server.shutdown()


def test_patterns_of_random_digits(spark):
    made = [r.x for r in generate.generate(spark, 20, {"x": {"generator": "pattern", "pattern": "a{rand:3}-{index}-{rand:40}{rand:3}"}}).collect()]
    assert all(re.fullmatch(r"a\d{3}-\d+-\d{43}", x) for x in made) and len({x[:4] for x in made}) > 5 and any(x[1:4] != x[-3:] for x in made)
    assert made == [r.x for r in generate.generate(spark, 20, {"x": {"generator": "pattern", "pattern": "a{rand:3}-{index}-{rand:40}{rand:3}"}}, partitions=7).collect()]


def test_json_lines_with_links(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"id": 18446744073709551615, "who": {"type": "p", "pid": "7"}, "l": [{"x": {"type": "p", "pid": "8", "z": 1}}, {"type": "p", "pid": 9}]}\n\n')
    (folder / "b.txt").write_text("not read\n")
    got = files.read_jsonl(spark, f"{folder}/", rules=[files.LinkRule('type="p",pid people:pid')]).selectExpr("_id", "to_json(doc) AS d").first()
    assert got._id == "-1" and json.loads(got.d)["who"] == {"tb": "people", "id": "7"} and json.loads(got.d)["l"] == [{"x": {"tb": "people", "id": "8"}}, {"type": "p", "pid": 9}]
    for bad in ('[1]\n', '{"id": 1.5}\n', "{\n", '{"x": 1}\n'):
        (folder / "a.jsonl").write_text(bad)
        with pytest.raises(Exception, match="a.jsonl|usable"):
            files.read_jsonl(spark, f"{folder}/").collect()


def test_ids_and_links_of_the_sink(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [], 1.5, ("t", "7"), {"k": [("u", "8")]})], "n int, a array<string>, e array<string>, f double, l struct<tb:string,id:string>, m map<string,array<struct<tb:string,id:string>>>")
    assert df.select(values.sink_id(df, "n").alias("x")).first().x == 1 and df.select(values.sink_id(df, "a").alias("x")).first().x == ["a", "b"]
    for column in ("f", "l"):
        with pytest.raises(ValueError):
            values.sink_id(df, column)
    with pytest.raises(Exception, match="empty"):
        df.select(values.sink_id(df, "e")).collect()
    r = values.sanitized(df).first()
    assert r.l == "t:7" and r.m == {"k": ["u:8"]}
    v = lambda t, kind: one(spark, values.sink_value(F.lit(t), Type(kind)))
    assert tuple(v("PT1.5S", "text"))[0] is None and v("plain", "text").text == "plain" and v("plain", "text").seconds is None
    assert [r.statement for r in values.insert_statements(df.select("n", F.lit("it's").alias('q"t'), F.lit(None).cast("string").alias("z")), "t").collect()] == ["INSERT INTO \"t\" (\"n\", \"q\"\"t\", \"z\") VALUES (1, 'it\\'s', NULL);"]
    assert values.column_type(Type.of("decimal(10,2)")) == "NUMERIC(10, 2)" and values.column_type(Type.of("array<int>")) == "INTEGER[]" and values.column_type(Type("json"), values.MYSQL) == "JSON"
    edges = spark.createDataFrame([("e1", "a", 1, "c")], "id string, out string, _pos long, _op string")
    assert [tuple(r) for r in values.merge_edges(edges, spark.createDataFrame([("e1", "b", 2, "u")], edges.schema)).collect()] == [("e1", "b", 2, "u")]


def test_messages(spark):
    rows = spark.createDataFrame([(b"\x00k", b'{"id":1,"v":"x"}', 1, 0, 0), (None, b'{"id":2,"v":"y"}', 0, 0, 1)], "key binary, value binary, timestamp long, partition int, offset long")
    payload = kafka.json_payload("id int, v string")
    assert [(r["_id"], r.v) for r in kafka.rows(kafka.first_messages(rows, 1), payload).collect()] == [(2, "y")]
    assert kafka.first_messages(rows, 3, 5).count() == 0
    with pytest.raises(Exception, match="no key"):
        kafka.rows(rows, payload, key_is_id=True).collect()
    with pytest.raises(ValueError):
        kafka.rows(rows, payload, id_columns=["nope"])
    assert "ScramLoginModule" in kafka.options("h", "t", protocol="sasl_ssl", sasl={"mechanism": "SCRAM-SHA-512", "username": "u", "password": 'p"'})["kafka.sasl.jaas.config"]
    for bad in ({"protocol": "x"}, {"protocol": "SASL_SSL"}, {"sasl": {"mechanism": "PLAIN"}}, {"protocol": "SSL", "ssl": {"key": "k"}}, {"ssl": {"ca": "c"}}):
        with pytest.raises(ValueError):
            kafka.options("h", "t", **bad)


PROTO = """
syntax = "proto3"; package shop.v1; import "x.proto"; option java_package = "a.b";
/* an order */ message Order { reserved 9; int64 id = 1; sint32 delta = 2; repeated int32 packed = 3 [packed = true]; map<string, Item> items = 4; oneof of { string note = 5; bytes raw = 6; }
  enum State { NEW = 0; PAID = 1; } State state = 7; double price = 8; repeated Item list = 10; message Item { string name = 1; bool ok = 2; } }
service S { rpc Get(Order) returns (Order) { option deprecated = true; } }
"""


def test_protobuf(spark):
    schema = protobuf.parse(PROTO)
    item = b"\x0a\x02pe\x10\x01"
    data = b"\x08" + b"\xff" * 9 + b"\x01" + b"\x10\x03" + b"\x1a\x03\x01\xac\x02" + b"\x22" + bytes([2 + 1 + 2 + len(item)]) + b"\x0a\x01k\x12" + bytes([len(item)]) + item + b"\x32\x01\x00" + b"\x38\x01" + b"\x41" + struct.pack("<d", 2.5) + b"\x52" + bytes([len(item)]) + item + b"\x7a\x01z"
    want = {"id": -1, "delta": -2, "packed": [1, 300], "items": {"k": {"name": "pe", "ok": True}}, "raw": "AA==", "state": "PAID", "price": 2.5, "list": [{"name": "pe", "ok": True}]}
    assert protobuf.decode(data, schema, "Order") == want
    got = spark.createDataFrame([(data,), (None,), (b"",)], "m binary").select(protobuf.to_json(F.col("m"), schema, "Order").alias("j")).collect()
    assert [r.j and json.loads(r.j) for r in got] == [want, None, {}]
    for broken in (b"\x08", b"\x0a\x05a", b"\x0f", b"\x41\x00"):
        with pytest.raises(ValueError):
            protobuf.decode(broken, schema, "Order")
    with pytest.raises(ValueError):
        protobuf.to_json(F.col("m"), schema, "Nope")


def test_tables_of_a_catalog(spark):
    columns = spark.createDataFrame([("a", "id", "int4", 1, "NO"), ("a", "mood", "mood", 2, "YES"), ("ab", "a_id", "int4", 1, "NO"), ("ab", "b", "character varying", 2, "NO"), ("ab", "tags", "int8[]", 3, "YES")], "table_name string, column_name string, data_type string, ordinal_position int, is_nullable string")
    constraints = spark.createDataFrame([("pa", "a", "PRIMARY KEY"), ("pab", "ab", "PRIMARY KEY"), ("f", "ab", "FOREIGN KEY")], "constraint_name string, table_name string, constraint_type string")
    keys = spark.createDataFrame([("pa", "a", "id", 1), ("pab", "ab", "b", 2), ("pab", "ab", "a_id", 1), ("f", "ab", "a_id", 1)], "constraint_name string, table_name string, column_name string, ordinal_position int")
    references = spark.createDataFrame([("f", "pa")], "constraint_name string, unique_constraint_name string")
    labels = spark.createDataFrame([("mood", "sad", 2), ("mood", "ok", 1)], "type_name string, label string, sort_order int")
    a, ab = catalogs.tables(columns, constraints, keys, references, labels)
    assert a.key.type == Type("int32") and a.columns[0].type == Type("enum", ("ok", "sad")) and a.key_columns == ["id"]
    assert ab.key_columns == ["a_id", "b"] and ab.foreign_keys[0].table == "a" and ab.columns[1].type.item == Type("int64")


@pytest.mark.parametrize("partitions", ["1", "3", "11"])
def test_values_carried_over_ranges(spark, partitions):
    import random

    rng = random.Random(int(partitions))
    rows, known = [], {}
    want = {}
    for pos in range(300):
        k, op = rng.choice([1, 1, 1, 2, None]), rng.choices("ucd", [8, 1, 1])[0]
        v = rng.choice([None, pos])
        rows.append((k, op, pos, v))
        if op != "u":
            known[k] = v
            want[pos] = v
        else:
            known[k] = known.get(k) if v is None else v
            want[pos] = known[k]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = changes.keep_before(spark.createDataFrame(rows, "k int, _op string, _pos long, v int"), ["k"], ["v"])
        assert {r._pos: r.v for r in got.collect() if r.k is not None} == {p: want[p] for k, _, p, _ in rows if k is not None}
        maps = spark.createDataFrame([(1, p, f"m{p}") for p in (7, 100, 250)], "k int, pos long, name string")
        events = spark.createDataFrame([(1, p) for p in range(0, 300, 3)] + [(2, 5), (None, 6)], "k int, pos long")
        last = lambda p: max((f"m{q}" for q in (7, 100, 250) if q <= p), key=lambda m: int(m[1:]), default=None)
        assert {(r.k, r.pos): r.name for r in changes.as_of(events, maps, "k", "pos", ["name"]).collect()} == {**{(1, p): last(p) for p in range(0, 300, 3)}, (2, 5): None, (None, 6): None}
        assert [r._pos for r in changelog.with_positions(events.where("k = 1"), ["pos"]).orderBy("pos").collect()] == list(range(1, 101))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_warehouse_cells(spark):
    get = lambda t, kind, *p: one(spark, cells.warehouse_cell(F.lit(t).cast("string"), kind, *p))
    assert get("5", "FIXED", 10, 0) == 5 and str(get("99999999999999999999", "number", 38, 0)) == "99999999999999999999" and str(get("1.50", "fixed", 10, 2)) == "1.50"
    assert get("1", "bool") is True and str(get("-1", "date")) == "1969-12-31" and get("3661.5", "time") == "01:01:01.5" and get("00fF", "binary") == b"\x00\xff" and get(" x ", "geography") == " x "
    assert get(None, "date") is None and str(get("-0.5", "timestamp_ntz")) == "1969-12-31 23:59:59.500000"
    assert one(spark, F.to_json(cells.warehouse_cell(F.lit('{"a":1}'), "array"))) == '[{"a":1}]'
    for t, kind in (("x", "fixed"), ("2", "bool"), ("0f0", "binary"), ("{", "variant")):
        with pytest.raises(Exception, match="not of type"):
            get(t, kind)
    df = spark.createDataFrame([("1", "2")], "A string, b string")
    assert cells.warehouse_rows(df, {"A": ("fixed", 9, 0), "b": ("text", 0, 0)}, ["a", "B"]).first()["_id"] == ["1", "2"]
    for columns, key in (({"A": ("fixed", 9, 0)}, ["A"]), ({"A": ("fixed", 9, 0), "b": ("text", 0, 0)}, ["c"])):
        with pytest.raises(ValueError):
            cells.warehouse_rows(df, columns, key)


def test_documents_of_extended_json(spark):
    lines = [
        {"_id": {"$oid": "65f0"}, "n": {"$numberDecimal": "1.25"}, "at": {"$date": "2024-01-15T10:30:00Z"}, "raw": {"$binary": {"base64": "AP8=", "subType": "00"}}, "who": {"$ref": "users", "$id": {"$oid": "9a"}}, "s": {"$regularExpression": {"pattern": "a.b", "options": "i"}}},
        {"_id": "t", "n": 2, "at": {"$timestamp": {"t": 5, "i": 1}}, "s": "plain"},
        {"_id": {"$numberLong": "7"}, "n": {"$numberInt": "3"}, "at": {"$date": {"$numberLong": "1500"}}, "who": {"$ref": "users"}, "s": {"$uuid": "u"}},
    ]
    fields = {"n": "decimal(10,2)", "at": "timestamp", "raw": "binary", "who": "link", "s": "string"}
    got = {r["_id"]: r for r in cells.documents(spark.createDataFrame([(json.dumps(x),) for x in lines], "value string"), fields).withColumn("us", F.unix_micros("at")).collect()}
    assert set(got) == {"65f0", "t", "7"} and [str(got[k].n) for k in ("65f0", "t", "7")] == ["1.25", "2.00", "3.00"]
    assert bytes(got["65f0"].raw) == b"\x00\xff" and tuple(got["65f0"].who) == ("users", "9a") and got["7"].who is None
    assert [got[k].s for k in ("65f0", "t", "7")] == ["/a.b/i", "plain", "u"] and [got[k].us for k in ("65f0", "t", "7")] == [1705314600000000, 5000000, 1500000]
    for bad in ('{"_id": 1.5}', '{"x": 1}', "{"):
        with pytest.raises(Exception, match="no usable _id"):
            cells.documents(spark.createDataFrame([(bad,)], "value string")).collect()


def test_ids_of_nodes(spark):
    nodes = spark.createDataFrame([("e1", {"id": "42", "n": "x"}), ("e2", {"id": "k"}), ("33", {"n": "y"})], "element_id string, properties map<string,string>")
    assert [(r["_id"], r.number, r.properties) for r in cells.node_ids(nodes).collect()] == [("42", 42, {"n": "x"}), ("k", None, {}), ("33", 33, {"n": "y"})]


def test_composite_keys_stay_apart(spark):
    """Keys whose parts hold the separator, are empty or null are four keys."""
    from driftline.operators.changes import fold
    from driftline.plans.transforms import flattened
    from driftline.sources import changelog

    keys = ['["a:b","c"]', '["a","b:c"]', '["a",null]', '["a",""]']
    rows = spark.createDataFrame([(i, "t", "INSERT", k, None, "{}") for i, k in enumerate(keys)], "sequence_id long, table_name string, operation string, row_id string, old_data string, new_data string")
    log = changelog.from_audit(rows, since=-1)
    assert sorted((r["_id"] for r in fold(log.select("_id", "_op", "_pos"), ["_id"]).collect()), key=str) == sorted([["a:b", "c"], ["a", "b:c"], ["a", None], ["a", ""]], key=str)
    assert {r["_id"] for r in flattened().rows(log).collect()} == {"a:b:c", "a:"}


def test_statements_that_change_tables(spark):
    from driftline.sources import ddl

    texts = ["RENAME TABLE `shop`.`a` TO b, c TO `shop`.d", "alter table a rename to b", "ALTER TABLE shop.a ADD x int, RENAME AS b;", "ALTER TABLE a RENAME COLUMN x TO y", "ALTER TABLE a RENAME INDEX i TO j",
             "create table if not exists `my table` (id int)", "/* c */ DROP TABLE IF EXISTS a", "TRUNCATE a", "INSERT INTO a VALUES (1)", "-- note\nALTER TABLE a\n  ADD y int", None]
    log = spark.createDataFrame(list(enumerate(texts)), "_pos int, sql string")
    got = sorted(tuple(r) for r in ddl.statements(log).collect())
    assert got == [(0, 0, "rename", "b", "a"), (0, 1, "rename", "d", "c"), (1, 0, "rename", "b", "a"), (2, 0, "rename", "b", "a"), (3, 0, "alter", "a", None), (4, 0, "alter", "a", None),
                   (5, 0, "create", "my table", None), (6, 0, "drop", "a", None), (7, 0, "truncate", "a", None), (9, 0, "alter", "a", None)]


def test_rows_before_their_layout_are_an_error(spark):
    from driftline.sources import ddl

    maps = spark.createDataFrame([(7, 1, "users", ["id", "name"]), (7, 9, "people", ["id"])], "table_id int, _pos long, _table string, columns array<string>")
    rows = spark.createDataFrame([(7, 2), (7, 10)], "table_id int, _pos long")
    assert sorted((r["_pos"], r["_table"], r["columns"]) for r in ddl.with_layouts(rows, maps).collect()) == [(2, "users", ["id", "name"]), (10, "people", ["id"])]
    with pytest.raises(Exception, match="no table map for 7 at 0"):
        ddl.with_layouts(spark.createDataFrame([(7, 0)], "table_id int, _pos long"), maps).collect()
