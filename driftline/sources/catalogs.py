"""Catalog tables of a database (as ``information_schema`` or ``sys`` views give them) to keys, foreign keys and declared tables.

Files have no catalog: ``columns_of``, ``held_keys`` and ``held_references`` make one of what the rows themselves bear out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ALIAS, SINK_TYPE, Column, ForeignKey, Table, Type, quoted
from ..staging import spread

#: Rows of a table whose keys are sent to every task; beyond that a reference is looked up by a shuffle of both sides.
SENT = 200_000

# fixed values: catalog names of types beside those that ``Type.of`` knows
NAMES = {
    "int2": "int16", "int4": "int32", "int8": "int64", "tinyint": "int8", "mediumint": "int32", "real": "float32", "float4": "float32", "double precision": "float64", "float8": "float64",
    "numeric": "decimal", "number": "decimal", "money": "decimal", "smallmoney": "decimal", "character": "char", "bpchar": "char", "nchar": "char", "character varying": "varchar",
    "nvarchar": "varchar", "varchar2": "varchar", "tinytext": "text", "mediumtext": "text", "longtext": "text", "ntext": "text", "bytea": "bytes", "binary": "bytes", "varbinary": "bytes",
    "tinyblob": "blob", "mediumblob": "blob", "longblob": "blob", "image": "blob", "rowversion": "bytes", "timestamp without time zone": "local_datetime", "datetime2": "local_datetime",
    "smalldatetime": "local_datetime", "timestamp_ntz": "local_datetime", "timestamp with time zone": "zoned_datetime", "timestamp_tz": "zoned_datetime", "timestamp_ltz": "zoned_datetime",
    "datetimeoffset": "zoned_datetime", "time without time zone": "time", "time with time zone": "timetz", "uniqueidentifier": "uuid", "bit": "bool", "interval": "duration",
    "variant": "json", "xml": "text",
}


def declared_type(name: str, precision: int | None = None, scale: int | None = None, length: int | None = None, labels: tuple[str, ...] = ()) -> Type:
    """A catalog's type as a declared one; a name that ends with [] is an array, one with labels an enum, an unknown one text."""
    low = name.strip().lower()
    if low.endswith("[]"):
        return Type("array", (), declared_type(low[:-2]))
    if labels:
        return Type("enum", labels)
    known = NAMES.get(low) or ALIAS.get(low) or (low if low in SINK_TYPE else "text")
    if known == "decimal" and precision:
        return Type("decimal", (precision, scale or 0))
    return Type(known, (length,)) if known in ("char", "varchar") and length else Type(known)


def keys(constraints: DataFrame, columns: DataFrame) -> DataFrame:
    """table_name and ``key``, the primary key's columns in order, of ``constraints(constraint_name, table_name, constraint_type)`` and
    ``columns(constraint_name, table_name, column_name, ordinal_position)``."""
    own = constraints.where("constraint_type = 'PRIMARY KEY'").select("constraint_name", "table_name")
    joined = own.join(columns, ["constraint_name", "table_name"])
    return joined.groupBy("table_name").agg(_ordered("column_name").alias("key"))


def _ordered(column: str, order: str = "ordinal_position"):
    # a key has a few columns
    return F.transform(F.array_sort(F.collect_list(F.struct(order, column))), lambda x: x[column])


def foreign_keys(references: DataFrame, columns: DataFrame) -> DataFrame:
    """constraint_name, table_name, ``columns``, ``referenced_table`` and ``referenced_columns``, of ``references(constraint_name,
    unique_constraint_name)`` and the columns of both constraints: an inner join of each constraint's columns with those of the key it names, place by place."""
    child = columns.select("constraint_name", "table_name", "column_name", "ordinal_position")
    parent = columns.select(F.col("constraint_name").alias("unique_constraint_name"), F.col("table_name").alias("referenced_table"), F.col("column_name").alias("referenced_column"), "ordinal_position")
    pairs = references.select("constraint_name", "unique_constraint_name").join(child, "constraint_name").join(parent, ["unique_constraint_name", "ordinal_position"])
    return pairs.groupBy("constraint_name", "table_name", "referenced_table").agg(_ordered("column_name").alias("columns"), _ordered("referenced_column").alias("referenced_columns"))


def enum_labels(labels: DataFrame) -> DataFrame:
    """type_name and its labels in order, of ``labels(type_name, label, sort_order)``."""
    return labels.groupBy("type_name").agg(_ordered("label", "sort_order").alias("labels"))


def tables(columns: DataFrame, constraints: DataFrame, key_columns: DataFrame, references: DataFrame, labels: DataFrame | None = None) -> list[Table]:
    """Declared tables, in the order of their names. A catalog is small: a row for each column comes to the driver. A table without a primary key has its first column as key."""
    of_key = {r["table_name"]: r["key"] for r in keys(constraints, key_columns).collect()}
    links: dict[str, list[ForeignKey]] = {}
    for r in foreign_keys(references, key_columns).orderBy("table_name", "constraint_name").collect():
        links.setdefault(r["table_name"], []).append(ForeignKey(tuple(r["columns"]), r["referenced_table"], tuple(r["referenced_columns"])))
    enums = {r["type_name"]: tuple(r["labels"]) for r in enum_labels(labels).collect()} if labels is not None else {}
    own: dict[str, list[Column]] = {}
    for r in columns.orderBy("table_name", "ordinal_position").collect():
        get = lambda c: r[c] if c in r.asDict() else None
        kind = declared_type(r["data_type"], get("numeric_precision"), get("numeric_scale"), get("character_maximum_length"), enums.get(r["data_type"], ()))
        own.setdefault(r["table_name"], []).append(Column(r["column_name"], kind, r["is_nullable"] == "YES"))
    out = []
    for name, found in own.items():
        key = of_key.get(name) or [found[0].name]
        first = next(c for c in found if c.name == key[0])
        out.append(Table(name, first, tuple(c for c in found if c is not first), tuple(links.get(name, [])), tuple(key) if len(key) > 1 else ()))
    return out


def columns_of(found: dict[str, DataFrame]) -> DataFrame:
    """A row for each column of DataFrames, as a catalog has it: table_name, ordinal_position, column_name, data_type and is_nullable, YES where a
    row has no value there (or there is no row). One scan for each table, combined in each task."""

    def one(name: str, rows: DataFrame) -> DataFrame:
        nulls = [F.coalesce(F.max(F.col(quoted(f.name)).isNull()), F.lit(True)).alias(f"c{i}") for i, f in enumerate(rows.schema)]
        said = [
            F.struct(F.lit(i + 1).alias("ordinal_position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.when(F.col(f"c{i}"), "YES").otherwise("NO").alias("is_nullable"))
            for i, f in enumerate(rows.schema)
        ]
        return rows.agg(*nulls).select(F.lit(name).alias("table_name"), F.inline(F.array(*said)))

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in found.items()])


def held_keys(found: dict[str, DataFrame], candidates: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Of the candidates (constraint_name to table and columns) those that are keys of the rows: no value twice, none missing. Columns of a catalog's constraints:
    constraint_name, table_name, constraint_type."""

    def one(name: str, table: str, columns: list[str]) -> DataFrame:
        own = [f"k{i}" for i in range(len(columns))]
        rows = found[table].select(*[F.col(quoted(c)).alias(k) for k, c in zip(own, columns)])
        each = spread(rows, own, sizes[table]).groupBy(*own).count()
        missing = reduce(lambda a, b: a | b, [F.col(f"k{i}").isNull() for i in range(len(columns))])
        good = each.agg(F.coalesce(F.max((F.col("count") > 1) | missing), F.lit(False)).alias("bad")).where("NOT bad")
        return good.select(F.lit(name).alias("constraint_name"), F.lit(table).alias("table_name"), F.lit("PRIMARY KEY").alias("constraint_type"))

    sizes = {t: found[t].count() for t in {c[0] for c in candidates.values()}}
    return reduce(DataFrame.unionByName, [one(n, *c) for n, c in candidates.items()])


def held_references(found: dict[str, DataFrame], candidates: dict[str, tuple[str, list[str], str]], of_key: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Of the candidates (constraint_name to table, columns and the key they name) those whose every row finds the row it names; a row with a value
    missing names none. Columns of a catalog's references: constraint_name, unique_constraint_name. An anti join for each, of the distinct values."""

    def one(name: str, table: str, columns: list[str], unique: str) -> DataFrame:
        parent, there = of_key[unique]
        if len(there) != len(columns):
            raise ValueError(f"{name} has {len(columns)} columns, {unique} {len(there)}")
        keyed = lambda t, cs: found[t].select(*[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(cs)])
        on = [f"k{i}" for i in range(len(columns))]
        own, known = keyed(table, columns).dropna(), keyed(parent, there)
        if sizes[parent] <= SENT:
            known = F.broadcast(known)
        else:
            most = max(sizes[table], sizes[parent])
            own, known = spread(own, on, most).distinct(), spread(known, on, most)
        lost = own.join(known, on, "left_anti").agg(F.count(F.lit(1)).alias("n")).where("n = 0")
        return lost.select(F.lit(name).alias("constraint_name"), F.lit(unique).alias("unique_constraint_name"))

    sizes = {t: found[t].count() for t in {c[0] for c in candidates.values()} | {of_key[c[2]][0] for c in candidates.values()}}
    return reduce(DataFrame.unionByName, [one(n, *c) for n, c in candidates.items()])


def key_columns(found: DataFrame, candidates: dict[str, tuple]) -> DataFrame:
    """constraint_name, table_name, column_name and ordinal_position of the constraints that ``found`` names; a candidate is a table, its columns, and maybe more."""
    rows = [(n, c[0], column, i + 1) for n, c in candidates.items() for i, column in enumerate(c[1])]
    declared = found.sparkSession.createDataFrame(rows, "constraint_name string, table_name string, column_name string, ordinal_position int")
    return declared.join(F.broadcast(found.select("constraint_name")), "constraint_name")  # a row for each constraint
