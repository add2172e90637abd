"""Rows as the sink takes them: checked ids, plain values, links as text, edges merged by id, and statements for other databases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import duration_seconds
from ..functions.scalars import quoted_text
from ..operators.changes import fold
from ..schema import Type

LINK = {"tb", "id"}
IDS = (T.StringType, T.IntegerType, T.LongType)
PARTS = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def sink_id(df: DataFrame, column: str) -> Column:
    """The column as an id: text, whole numbers of 32 or 64 bits as long, or an array of plain parts that isn't empty. Another type is refused at once, an empty array or a NULL when it is met."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(kind, T.ArrayType):
        if not isinstance(kind.elementType, PARTS):
            raise ValueError(f"an array of {kind.elementType.simpleString()} is no id")
        return F.when(F.size(c) > 0, c).otherwise(F.raise_error(F.lit(f"{column}: an array id must not be empty")))
    if not isinstance(kind, IDS):
        raise ValueError(f"{kind.simpleString()} is no id")
    own = c if isinstance(kind, T.StringType) else c.cast("bigint")
    return F.when(c.isNotNull(), own).otherwise(F.raise_error(F.lit(f"{column}: an id must not be null")))


def _rebuilt(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        if {f.name for f in kind} == LINK:
            return F.when(c.isNotNull(), F.concat(c["tb"], F.lit(":"), c["id"].cast("string")))
        return F.when(c.isNotNull(), F.struct(*[_rebuilt(c[f.name], f.dataType).alias(f.name) for f in kind]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _rebuilt(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: _rebuilt(v, kind.valueType))
    return c


def sanitized(df: DataFrame) -> DataFrame:
    """Links anywhere in a row, in structs, arrays and maps too, as ``table:id`` texts."""
    return df.select(*[_rebuilt(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def sink_value(c: Column, declared: Type) -> Column:
    """A value of a declared type as the sink keeps it: numbers wide, dates and times as text, a text that says an ISO duration as that duration
    beside NULL text (``struct<text,seconds>``)."""
    name = declared.name
    if name in ("int8", "int16", "int32", "int64"):
        return c.cast("bigint")
    if name in ("float32", "float64"):
        return c.cast("double")
    if name == "date":
        return F.date_format(c, "yyyy-MM-dd")
    if name in ("local_datetime", "local_datetime_nano", "zoned_datetime"):
        return c.cast("timestamp")
    if name in ("char", "varchar", "text"):
        seconds = duration_seconds(c)
        return F.when(c.isNotNull(), F.struct(F.when(seconds.isNull(), c).alias("text"), seconds.alias("seconds")))
    return c


def merge_edges(held: DataFrame, new: DataFrame, order: str = "_pos") -> DataFrame:
    """Edges (in, out, id, ...) after newer ones: an edge replaces the one with its id."""
    return fold(held.unionByName(new, allowMissingColumns=True), ["id"], [order])


# fixed values: column types of two databases for declared types
PG = {"bool": "BOOLEAN", "int8": "SMALLINT", "int16": "SMALLINT", "int32": "INTEGER", "int64": "BIGINT", "float32": "REAL", "float64": "DOUBLE PRECISION", "decimal": "NUMERIC", "char": "CHAR", "varchar": "VARCHAR", "text": "TEXT", "blob": "BYTEA", "bytes": "BYTEA", "date": "DATE", "time": "TIME", "local_datetime": "TIMESTAMP", "zoned_datetime": "TIMESTAMPTZ", "uuid": "UUID", "json": "JSON", "jsonb": "JSONB"}
MYSQL = {"bool": "TINYINT(1)", "int8": "TINYINT", "int16": "SMALLINT", "int32": "INT", "int64": "BIGINT", "float32": "FLOAT", "float64": "DOUBLE", "decimal": "DECIMAL", "char": "CHAR", "varchar": "VARCHAR", "text": "TEXT", "blob": "BLOB", "bytes": "VARBINARY", "date": "DATE", "time": "TIME", "local_datetime": "DATETIME(6)", "zoned_datetime": "TIMESTAMP(6)", "uuid": "CHAR(36)", "json": "JSON", "jsonb": "JSON"}


def column_type(declared: Type, dialect: dict[str, str] = PG) -> str:
    if declared.name == "array":
        return f"{column_type(declared.item, dialect)}[]" if dialect is PG else "JSON"
    base = dialect.get(declared.name, "TEXT")
    return f"{base}({', '.join(map(str, declared.args))})" if declared.args and declared.name in ("decimal", "char", "varchar") else base


def literal(c: Column, kind: T.DataType) -> Column:
    """A value as a literal that PostgreSQL, MySQL and Cypher read alike: numbers and booleans bare, anything else as quoted text."""
    if isinstance(kind, (T.BooleanType, T.NumericType)):
        out = c.cast("string")
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        out = quoted_text(F.to_json(c))
    else:
        out = quoted_text(c.cast("string"))
    return F.coalesce(out, F.lit("NULL"))


def insert_statements(df: DataFrame, table: str, quote: str = '"') -> DataFrame:
    """``statement``: an INSERT for each row."""
    names = ", ".join(f"{quote}{c.replace(quote, 2 * quote)}{quote}" for c in df.columns)
    values = F.concat_ws(", ", *[literal(F.col(f"`{f.name}`"), f.dataType) for f in df.schema])
    return df.select(F.concat(F.lit(f"INSERT INTO {quote}{table}{quote} ({names}) VALUES ("), values, F.lit(");")).alias("statement"))
