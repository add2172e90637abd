import re
import json
import sys

import pytest
from pyspark.sql import functions as F

from driftline.plans import transforms
from driftline.schema import Column, Table, Type
from driftline.sources import catalogs, changelog, files, generate


def test_csv(spark, tmp_path):
    (tmp_path / "u.csv").write_text("id,name,age\n1,Alice,30\n2,Bob,x\n")
    t = Table("u", Column("id", Type.of("int64")), (Column("age", Type.of("int32")),))
    got = files.read_csv(spark, str(tmp_path / "u.csv"), t, id_columns=["id"]).orderBy("id").collect()
    assert [(r._id, r.id, r.age, r._raw_age, r.name, r._inferred_name) for r in got] == [("1", 1, 30, None, "Alice", "text"), ("2", 2, None, "x", "Bob", "text")]
    assert files.read_csv(spark, str(tmp_path / "u.csv"), header=False).columns[:2] == ["column_0", "column_1"]
    (tmp_path / "bad.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "bad.csv")).collect()


def test_jsonl(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"id": "a", "n": 300}\n\n{"id": 7, "n": "x"}\n')
    t = Table("p", Column("id", Type.of("text")), (Column("n", Type.of("int8")),))
    got = {r._id: r.n for r in files.read_jsonl(spark, str(tmp_path / "p.jsonl"), t).select("_id", "n").collect()}
    assert got == {"a": 44, "7": None}
    for bad in ("[1]\n", '{"n": 1}\n', "nonsense\n"):
        (tmp_path / "b.jsonl").write_text(bad)
        with pytest.raises(Exception):
            files.read_jsonl(spark, str(tmp_path / "b.jsonl")).select("_id", "doc").write.format("noop").mode("overwrite").save()


def test_uris():
    assert files.parse_uri("s3://b/x/") == ("s3", "s3a://b/x/", True) and files.parse_uri("/a/b.csv") == ("local", "/a/b.csv", False)
    assert files.extension("https://h/a.CSV?x=1") == "csv" and files.table_name("/d/pages.jsonl") == "pages" and files.table_name("https://h/") == "items"


def test_link_rule(spark):
    rule = files.LinkRule('type="page_id",page_id pages:page_id')
    texts = ['{"type":"page_id","page_id":"p1"}', '{"type":"page_id","page_id":1}', '{"type":"x","page_id":"p1"}', "1"]
    got = spark.createDataFrame([(t,) for t in texts], "x string").select(rule.link(F.col("x")).alias("l")).collect()
    assert [r.l and (r.l.tb, r.l.id) for r in got] == [("pages", "p1"), None, None, None]
    for bad in ("type=page_id,page_id pages:page_id", 'type="a",b c:d', 'type="a"'):
        with pytest.raises(ValueError):
            files.LinkRule(bad)


def test_audit(spark):
    log = spark.createDataFrame([(1, "t", "INSERT", "[1,2]", None, '{"a":1}'), (2, "t", "DELETE", "[1,2]", '{"a":1}', None), (3, "t", "MERGE", "[1]", None, None)], "sequence_id long, table_name string, operation string, row_id string, old_data string, new_data string")
    assert [(r._id, r._op) for r in changelog.from_audit(log).select("_id", "_op", "_pos").orderBy("_pos").collect()] == [(["1", "2"], "c"), (["1", "2"], "d")]
    with pytest.raises(Exception):
        changelog.from_audit(log, unknown="error").select("_op").collect()


def test_binlog(spark):
    row = "struct<id:int,v:string>"
    log = spark.createDataFrame([("d", "t", "u", (1, "old"), (9, None), "f", 1), ("d", "t", "d", (2, "x"), None, "f", 2), ("e", "t", "c", None, (3, "y"), "f", 3)], f"db string, table string, op string, before {row}, after {row}, file string, pos int")
    assert [(r._op, r.id, r.v) for r in changelog.from_binlog(log, "d", ["t"], ["id"]).collect()] == [("u", 1, "old"), ("d", 2, "x")]
    assert changelog.from_binlog(log, "d", ["t"], ["id"], null_after="plain").first().v is None


def test_generator_is_stable(spark):
    columns = {"id": {"generator": "sequential"}, "a": {"generator": "int_range", "min": 1, "max": 6}, "s": {"generator": "sample_array", "values": ["x", "y"], "max": 2}, "u": {"generator": "uuid"}}
    one = generate.generate(spark, 200, columns, partitions=1).orderBy("id").collect()
    assert one == generate.generate(spark, 200, columns, partitions=7).orderBy("id").collect()
    assert {r.a for r in one} == {1, 2, 3, 4, 5, 6} and max(len(r.s) for r in one) == 2 and len({r.u for r in one}) == 200
    assert generate.deal(["a", "b", "c"], 2) == [(0, 42, ["a", "c"]), (1, 43, ["b"])]


WORKER = """
import json, sys
for line in sys.stdin:
    head = json.loads(line)
    rows = [json.loads(sys.stdin.readline()) for _ in range(head["count"])]
    out = [dict(r, v=r["v"] * 2) for r in rows if r["v"] != 3]
    print(json.dumps({"batch_id": head["batch_id"] + %d, "count": len(out), "kind": head["kind"]}))
    for r in out: print(json.dumps(r))
    sys.stdout.flush()
"""


def test_command_stage(spark, tmp_path):
    (tmp_path / "w.py").write_text(WORKER % 0)
    df = spark.range(6).select(F.col("id").alias("v"))
    for mode in ("persistent", "transient"):
        toml = f'[[transforms]]\ntype = "command"\nmode = "{mode}"\ncommand = {json.dumps([sys.executable, str(tmp_path / "w.py")])}\n'
        assert sorted(r.v for r in transforms.load(toml).rows(df).collect()) == [0, 2, 4, 8, 10]
    (tmp_path / "w.py").write_text(WORKER % 1)
    with pytest.raises(Exception):
        transforms.load(toml).rows(df).collect()
    with pytest.raises(ValueError):
        transforms.load(toml).edges(df)


def test_toml():
    assert transforms.load("").is_identity and transforms.load('[[transforms]]\ntype = "passthrough"').is_identity
    p = transforms.load('[pipeline]\nfailure_policy = "skip"\nbatch_max_wait = "250ms"\n[[transforms]]\ntype = "flatten_id"')
    assert p.options.failure_policy == "skip" and p.options.batch_max_wait == 0.25 and len(p.stages) == 1
    assert transforms.load("").options.batch_size == 1
    for bad in ("[other]", "[pipeline]\nx = 1", '[[transforms]]\ntype = "nothing"', '[[transforms]]\ntype = "command"\ncommand = ["/no/such"]'):
        with pytest.raises(ValueError):
            transforms.load(bad)


def test_csv_is_split_unless_records_go_over_lines(spark, tmp_path):
    plain, broken = tmp_path / "plain.csv", tmp_path / "broken.csv"
    plain.write_text("id,t\n" + "".join(f'{i},"a ""{i}"", b"\n' for i in range(5000)))
    broken.write_text("id,t\n" + "".join(f'{i},"a\n{i}"\n' for i in range(50)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16 << 10)
    try:
        split = files.read_csv(spark, str(plain), id_columns=["id"])
        assert split.rdd.getNumPartitions() > 2
        assert sorted((int(r.id), r.t) for r in split.collect()) == [(i, f'a "{i}", b') for i in range(5000)]
        whole = files.read_csv(spark, str(broken), id_columns=["id"])
        assert sorted((int(r.id), r.t) for r in whole.collect()) == [(i, f"a\n{i}") for i in range(50)]
        assert files.read_csv(spark, str(plain), id_columns=["id"], multiline=True).count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("sent", [200_000, 0])
def test_keys_and_references_of_larger_tables(spark, monkeypatch, sent):
    """A table's rows are dealt by key to as many tasks as they need before anything groups them, and few keys are sent along; both ways find the same."""
    from driftline import staging

    monkeypatch.setattr(staging, "ROWS", 100)
    monkeypatch.setattr(catalogs, "SENT", sent, raising=False)
    parent = spark.range(2000).selectExpr("id", "id % 50 AS k")
    child = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, NULL, id % 2000) AS good", "id AS bad", "IF(id % 2 = 0, NULL, id) AS some")
    found, unique = {"p": parent, "c": child}, {"pk": ("p", ["id"]), "twice": ("p", ["k"]), "pair": ("p", ["k", "id"]), "missing": ("c", ["some"])}
    held = catalogs.held_keys(found, unique)
    assert {r.constraint_name for r in held.collect()} == {"pk", "pair"}
    plan = held._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert {int(re.search(r", (\d+)\), REPARTITION", line)[1]) for line in first} == {20, 30}  # 2000 and 3000 rows
    named = {"f1": ("c", ["good"], "pk"), "f2": ("c", ["bad"], "pk")}
    assert [r.constraint_name for r in catalogs.held_references(found, named, unique).collect()] == ["f1"]


def test_ordinals_of_larger_tables(spark, monkeypatch):
    """Windows over versions are as many tasks' work as the rows need, and no task groups a whole split beforehand."""
    from driftline import staging
    from driftline.operators import temporal

    monkeypatch.setattr(staging, "ROWS", 100, raising=False)
    rows = spark.range(3000).selectExpr("id % 1000 AS k", "'a' AS since", "'b' AS till", "'x' AS v", "id AS n")
    got = temporal.version_ids(rows, ["k"], "since", "till", {"v": F.col("v")}, [F.col("n")])
    numbers = [int(m[1]) for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if (m := re.search(r"hashpartitioning\(.*, (\d+)\)", line))]
    assert numbers and set(numbers) == {30}
    assert all(r.duplicate == r.n // 1000 for r in got.collect())
