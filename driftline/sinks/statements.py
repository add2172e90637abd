"""Statements for other databases that hold many rows: bounded in rows and bytes, cut within each partition, without a shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import quoted_text
from ..schema import Column as Declared
from .values import MYSQL, PG, column_type

# fixed values: how each dialect quotes a name, and PostgreSQL's names of Spark's types
QUOTE = {"postgresql": '"', "mysql": "`", "cypher": "`"}
PG_TYPE = {
    T.BooleanType: "BOOLEAN", T.ByteType: "SMALLINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION", T.StringType: "TEXT", T.BinaryType: "BYTEA", T.DateType: "DATE", T.TimestampType: "TIMESTAMPTZ",
    T.TimestampNTZType: "TIMESTAMP", T.DayTimeIntervalType: "INTERVAL",
}


def name(text: str, dialect: str) -> str:
    q = QUOTE[dialect]
    return q + text.replace(q, q + q) + q


def pg_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"NUMERIC({kind.precision}, {kind.scale})"
    if isinstance(kind, T.ArrayType):
        return f"{pg_type(kind.elementType)}[]"
    return PG_TYPE.get(type(kind), "JSONB")


def _text(c: Column, dialect: str) -> Column:
    if dialect == "cypher":
        return quoted_text(c)
    if dialect == "mysql":
        c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    else:
        c = F.when(F.instr(c, "\0") > 0, F.raise_error(F.lit("a text with a NUL character is no PostgreSQL text"))).otherwise(c)
    return F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))


def _seconds(c: Column) -> Column:
    """An interval as an ISO duration in seconds, with nine digits of fraction where it has one."""
    micros = F.unix_micros(F.timestamp_micros(F.lit(0)) + c)
    whole, rest = F.floor(F.abs(micros) / 1000000).cast("string"), F.abs(micros) % 1000000
    fraction = F.when(rest == 0, "").otherwise(F.concat(F.lit("."), F.lpad(rest.cast("string"), 6, "0"), F.lit("000")))
    return F.concat(F.lit("PT"), F.when(micros < 0, "-").otherwise(""), whole, fraction, F.lit("S"))


def literal(c: Column, kind: T.DataType, dialect: str = "postgresql") -> Column:
    """A value as the dialect's literal. Numbers that aren't finite are quoted for PostgreSQL and refused by the others, instants are UTC, bytes are hexadecimal
    (text in Cypher), arrays are arrays (JSON in MySQL), and structs and maps JSON (maps of literals in Cypher)."""
    cypher, pg = dialect == "cypher", dialect == "postgresql"
    null = F.lit("null" if cypher else "NULL")
    quoted = lambda text, before="'", after="'": F.concat(F.lit(before), text, F.lit(after))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        odd = F.isnan(c) | (F.abs(c) == float("inf"))
        out = F.when(odd, quoted(c.cast("string"), after="'::float8") if pg else F.raise_error(F.lit(f"{dialect} has no literal for a number that is not finite"))).otherwise(c.cast("string"))
    elif isinstance(kind, (T.BooleanType, T.NumericType)):
        out = c.cast("string")
    elif isinstance(kind, T.BinaryType):
        out = quoted(F.lower(F.hex(c)), *{"postgresql": ("'\\x", "'::bytea"), "mysql": ("x'", "'"), "cypher": ("'", "'")}[dialect])
    elif isinstance(kind, T.DateType):
        out = quoted(c.cast("string"), *(("date('", "')") if cypher else ("'", "'")))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        zoned = isinstance(kind, T.TimestampType)
        at = F.to_utc_timestamp(c, F.current_timezone()) if zoned else c
        spelled = F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS" if dialect == "mysql" else "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        out = quoted(spelled, "datetime('", "Z')") if cypher else quoted(spelled, after="Z'" if zoned and pg else "'")
    elif isinstance(kind, T.DayTimeIntervalType):
        out = quoted(_seconds(c), *{"postgresql": ("'", "'::interval"), "mysql": ("'", "'"), "cypher": ("duration('", "')")}[dialect])
    elif isinstance(kind, T.ArrayType) and dialect != "mysql":
        items = F.array_join(F.transform(c, lambda x: literal(x, kind.elementType, dialect)), ", ")
        out = quoted(items, "[", "]") if cypher else quoted(items, "ARRAY[", f"]::{pg_type(kind)}")
    elif isinstance(kind, T.StructType) and cypher:
        fields = [F.concat(F.lit(f"{name(f.name, dialect)}: "), literal(c[f.name], f.dataType, dialect)) for f in kind]
        out = F.when(c.isNotNull(), quoted(F.concat_ws(", ", *fields), "{", "}"))
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        out = _text(F.to_json(c), dialect)
    else:
        out = _text(c.cast("string"), dialect)
    return F.when(c.isNull(), null).otherwise(out)


def _packed(batches: Iterable[pa.RecordBatch], head: str, parts: list[tuple[str, str]], tail: str, rows: int, most: int) -> Iterator[pa.RecordBatch]:
    """Joins the texts of following rows, each column by itself, into statements; what the last statement of a batch still has room for comes with the next."""
    fixed = len((head + ", ".join(before + after for before, after in parts) + tail).encode())
    held = None
    for batch in chain(batches, [None]):
        open_ = batch is not None
        table = pa.Table.from_batches([batch]) if open_ else held
        if open_ and held is not None:
            table = pa.concat_tables([held, table])
        if table is None or not table.num_rows:
            continue
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns]
        ends = np.cumsum(sum(pc.binary_length(c).to_numpy(zero_copy_only=False).astype(np.int64) + 2 for c in columns))
        cuts, room = [0], most - fixed + 2 * len(parts)
        while cuts[-1] < table.num_rows:
            a = cuts[-1]
            fit = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + room, side="right"))
            cuts.append(min(max(fit, a + 1), a + rows, table.num_rows))
        if open_:
            held = table.slice(cuts[-2])
            cuts.pop()
        offsets = pa.array(cuts, pa.int32())
        joined = [pc.binary_join(pa.ListArray.from_arrays(offsets, c), ", ") for c in columns]
        framed = [pc.binary_join_element_wise(before, j, after, "") for (before, after), j in zip(parts, joined)]
        body = pc.binary_join_element_wise(*framed, ", ") if len(framed) > 1 else framed[0]
        yield pa.record_batch([pc.binary_join_element_wise(head, body, tail, ""), pa.array(np.diff(cuts), pa.int32())], ["statement", "n_rows"])


def batches(df: DataFrame, table: str, dialect: str = "postgresql", rows: int = 1000, most_bytes: int = 1 << 20, unnest: bool = False) -> DataFrame:
    """``statement`` and its ``n_rows``: each of at most ``rows`` rows and ``most_bytes`` bytes, but a single row however large.

    ``INSERT ... VALUES`` of many rows, with ``unnest`` PostgreSQL's ``SELECT * FROM UNNEST`` of one array for each column, or Cypher's ``UNWIND`` of maps
    into nodes labelled ``table``. Rows are packed in the order in which their partition has them; a partition's last statement may be short, an empty table gives
    none. A task holds one Arrow batch and one open statement.
    """
    if rows < 1 or not df.columns:
        raise ValueError("a statement needs at least one row and one column")
    if unnest and dialect != "postgresql":
        raise ValueError("only PostgreSQL has UNNEST")
    own = {f.name: f.dataType for f in df.schema}
    cells = [literal(F.col(name(c, "mysql")), kind, dialect) for c, kind in own.items()]
    target, names = name(table, dialect), ", ".join(name(c, dialect) for c in own)
    if unnest:
        if flat := [c for c, kind in own.items() if isinstance(kind, T.ArrayType)]:
            raise ValueError(f"UNNEST would flatten the arrays of {', '.join(flat)}")
        texts = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)])
        head, parts, tail = f"INSERT INTO {target} ({names}) SELECT * FROM UNNEST(", [("ARRAY[", f"]::{pg_type(k)}[]") for k in own.values()], ");"
    elif dialect == "cypher":
        pairs = [F.concat(F.lit(f"{name(c, dialect)}: "), cell) for c, cell in zip(own, cells)]
        texts = df.select(F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")).alias("row"))
        head, parts, tail = "UNWIND [", [("", "")], f"] AS row CREATE (n:{target}) SET n = row;"
    else:
        texts = df.select(F.concat(F.lit("("), F.concat_ws(", ", *cells), F.lit(")")).alias("row"))
        head, parts, tail = f"INSERT INTO {target} ({names}) VALUES ", [("", "")], ";"
    return texts.mapInArrow(lambda of: _packed(of, head, parts, tail, rows, most_bytes), "statement string, n_rows int")


def create_table(table: str, columns: list[Declared], keys: list[str], dialect: str = "postgresql", numbered: str | None = None) -> str:
    """A table of declared columns with its primary key; ``numbered`` is a key column that the database counts up itself."""
    if dialect not in ("postgresql", "mysql"):
        raise ValueError(f"{dialect} has no tables")
    types = PG if dialect == "postgresql" else MYSQL
    lines = [f"  {name(numbered, dialect)} " + ("BIGSERIAL NOT NULL" if dialect == "postgresql" else "BIGINT NOT NULL AUTO_INCREMENT")] if numbered else []
    lines += [f"  {name(c.name, dialect)} {column_type(c.type, types)} {'NULL' if c.nullable and c.name not in keys else 'NOT NULL'}" for c in columns if c.name != numbered]
    lines.append(f"  PRIMARY KEY ({', '.join(name(k, dialect) for k in keys)})")
    return f"CREATE TABLE {name(table, dialect)} (\n" + ",\n".join(lines) + "\n);"
