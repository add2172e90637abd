"""Tables that are asked again and again for what is new: audit tables by sequence number, graphs by time and id, as a streaming source.

A cursor is the tuple of a table's ordering columns, and each table has one of its own. What is beyond the cursor, up to ``rows`` rows a table, is the next
micro-batch; executors read it, a table's range of numbers cut into ``parts``, and a batch that is done may be acknowledged to the database. Cursors are the
query's offsets, in its checkpoint, so a restart repeats a batch that was not done, with the same bounds, and loses none.
"""

from __future__ import annotations

import datetime
import importlib
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..staging import importable

NAME = "polled_tables"


class Range(InputPartition):
    def __init__(self, table: int, low: list | None, high: list):
        self.table, self.low, self.high = table, low, high


class Database:
    """Tables behind a DB-API module: ``connect`` is its name and the arguments of its ``connect``."""

    def __init__(self, options: dict):
        spec = json.loads(options["connect"])
        self.module, self.args = importlib.import_module(spec["module"]), spec.get("args", [])
        self.mark = "?" if self.module.paramstyle == "qmark" else "%s"

    def _beyond(self, order: list[str], inclusive: bool = False) -> str:
        """Rows after (up to, if inclusive) a cursor, spelled so that an index serves."""
        way = "<" if inclusive else ">"
        terms = [" AND ".join([*(f"{c} = {self.mark}" for c in order[:i]), f"{order[i]} {way}{'=' if inclusive and i == len(order) - 1 else ''} {self.mark}"]) for i in range(len(order))]
        return " OR ".join(f"({t})" for t in terms)

    @staticmethod
    def _bound(cursor: list) -> list:
        return [v for i in range(len(cursor)) for v in cursor[: i + 1]]

    def rows(self, sql: str, values: list) -> Iterator[tuple]:
        connection = self.module.connect(*self.args)
        try:
            cursor = connection.cursor()
            cursor.execute(sql, values)
            while some := cursor.fetchmany(10_000):
                yield from some
            connection.commit()
        finally:
            connection.close()

    def last(self, table: dict, after: list | None, most: int | None) -> list | None:
        """The cursor of the last of the next ``most`` rows; None if there are none."""
        order, where = table["order"], f"WHERE {self._beyond(table['order'])}" if after else ""
        up, down = (", ".join(f"{c}{way}" for c in order) for way in ("", " DESC"))
        base = f"SELECT {', '.join(order)} FROM ({table['query']}) q {where}"
        sql = f"{base} ORDER BY {down} LIMIT 1" if most is None else f"SELECT * FROM ({base} ORDER BY {up} LIMIT {int(most)}) p ORDER BY {down} LIMIT 1"
        found = list(self.rows(sql, self._bound(after) if after else []))
        return list(found[0]) if found else None

    def between(self, table: dict, columns: list[str], low: list | None, high: list) -> Iterator[tuple]:
        where = f"({self._beyond(table['order'], True)})" + (f" AND ({self._beyond(table['order'])})" if low else "")
        yield from self.rows(f"SELECT {', '.join(columns)} FROM ({table['query']}) q WHERE {where} ORDER BY {', '.join(table['order'])}", self._bound(high) + (self._bound(low) if low else []))


class Reader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, dict(options)
        self.tables = json.loads(options["tables"])
        self.most = int(options["rows"]) if options.get("rows") else None
        self.parts = int(options.get("parts", 1))
        # where the query stands: what it was told when it began, and then what it was last given
        self.at: dict = json.loads(options.get("known") or "{}")

    def initialOffset(self) -> dict:
        return {t["name"]: json.dumps(t.get("since")) for t in self.tables}

    def latestOffset(self) -> dict:
        base, now = Database(self.options), {}
        for t in self.tables:
            at = json.loads(self.at[t["name"]]) if t["name"] in self.at else t.get("since")
            now[t["name"]] = json.dumps(base.last(t, at, self.most) or at)
        return now

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.at, out = end, []
        for i, t in enumerate(self.tables):
            low, high = (json.loads(x.get(t["name"], "null")) for x in (start, end))
            if high is None or low == high:
                continue
            numbers = len(high) == 1 and isinstance(high[0], int) and low is not None
            cuts = sorted({low[0] + (high[0] - low[0]) * k // self.parts for k in range(1, self.parts + 1)} - {low[0]}) if numbers else [high[0]]
            edges = [low, *([c] for c in cuts)] if numbers else [low, high]
            out += [Range(i, a, b) for a, b in zip(edges, edges[1:])]
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        table = self.tables[partition.table]
        names = [f.name for f in self.schema.fields]
        asked = [n for n in names if n != "_table"]
        kinds = {f.name: f.dataType.simpleString() for f in self.schema.fields}
        for row in Database(self.options).between(table, asked, partition.low, partition.high):
            cells = {n: _cell(v, kinds[n]) for n, v in zip(asked, row)}
            yield tuple(cells.get(n, table["name"]) for n in names)

    def commit(self, end: dict) -> None:
        for t in self.tables:
            at = json.loads(end.get(t["name"], "null"))
            if t.get("acknowledge") and at is not None:
                list(Database(self.options).rows(t["acknowledge"], at))


def _cell(value, kind: str):
    return datetime.datetime.fromisoformat(value) if kind == "timestamp" and isinstance(value, str) else value


class PolledTables(DataSource):
    """Options: ``connect``, ``tables`` (name, query, order, and if wanted since and acknowledge, a statement that gets the cursor), ``rows``, ``parts``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> Reader:
        return Reader(schema, self.options)


def standing(spark: SparkSession, checkpoint: str) -> dict:
    """The cursors of a query's last planned batch, as its checkpoint has them; a source that begins again knows from them where its next rows begin."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    batches = [int(f.getPath().getName()) for f in fs.listStatus(path) if f.getPath().getName().isdigit()]
    if not batches:
        return {}
    lines = spark.read.text(f"{checkpoint}/offsets/{max(batches)}").toPandas()["value"].tolist()  # one small file
    return json.loads(lines[-1])


def stream(spark: SparkSession, schema: str, connect: dict, tables: list[dict], checkpoint: str, rows: int | None = None, parts: int = 1) -> DataFrame:
    """``tables`` as a stream for the query of ``checkpoint``, at most ``rows`` of each in a micro-batch. A column ``_table`` in the schema has a row's table."""
    importable(spark).dataSource.register(PolledTables)
    known = standing(spark, checkpoint)
    options = {"connect": json.dumps(connect), "tables": json.dumps(tables), "parts": str(parts), "known": json.dumps(known)} | ({"rows": str(rows)} if rows else {})
    return spark.readStream.format(NAME).schema(schema).options(**options).load()
