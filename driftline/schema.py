"""Declared types, tables and keys, and what follows from them without data: Spark types, DDL text, entity or relation."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# fixed values: the sink's type for each declared type
SINK_TYPE = {
    "bool": "bool", "int8": "int", "int16": "int", "int32": "int", "int64": "int", "float32": "float", "float64": "float", "decimal": "decimal",
    "char": "string", "varchar": "string", "text": "string", "blob": "bytes", "bytes": "bytes", "date": "datetime", "local_datetime": "datetime",
    "local_datetime_nano": "datetime", "zoned_datetime": "datetime", "time": "string", "timetz": "string", "uuid": "uuid", "ulid": "ulid", "json": "object",
    "jsonb": "object", "object": "object", "set": "string", "enum": "string", "geometry": "geometry", "duration": "duration", "thing": "record",
}
SPARK_TYPE = {
    "bool": T.BooleanType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(), "float32": T.FloatType(),
    "float64": T.DoubleType(), "blob": T.BinaryType(), "bytes": T.BinaryType(), "date": T.DateType(), "local_datetime": T.TimestampNTZType(),
    "local_datetime_nano": T.TimestampNTZType(), "zoned_datetime": T.TimestampType(), "duration": T.DayTimeIntervalType(), "set": T.ArrayType(T.StringType()),
    "json": T.VariantType(), "jsonb": T.VariantType(), "object": T.VariantType(),
}
ALIAS = {"boolean": "bool", "smallint": "int16", "int": "int32", "integer": "int32", "bigint": "int64", "big_int": "int64", "float": "float32", "double": "float64", "datetime": "local_datetime", "timestamp": "local_datetime", "timestamptz": "zoned_datetime", "var_char": "varchar", "string": "text"}


def _parts(text: str) -> list[str]:
    """What commas outside of brackets separate."""
    parts, depth = [""], 0
    for x in text:
        depth += (x in "<(") - (x in ">)")
        if x == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += x
    return parts


@dataclass(frozen=True)
class Type:
    """A declared type; ``args`` are width, length, precision and scale, or labels, ``item`` is an array's element type and ``fields`` are a struct's columns."""

    name: str
    args: tuple = ()
    item: Type | None = None
    fields: tuple[Column, ...] = ()

    @classmethod
    def of(cls, text: str) -> Type:
        """``decimal(10,2)``, ``array<int>``, ``struct<a:int,b:text>``, ``enum(a,b)`` and the like, with aliases."""
        text = text.strip()
        if m := re.fullmatch(r"(?i)array<(.+)>", text):
            return cls("array", (), cls.of(m[1]))
        if m := re.fullmatch(r"(?i)struct<(.+)>", text):
            return cls("struct", fields=tuple(Column(n.strip(), cls.of(t)) for n, _, t in (x.partition(":") for x in _parts(m[1]))))
        m = re.fullmatch(r"(\w+)(?:\((.*)\))?", text)
        if not m:
            raise ValueError(f"not a type: {text}")
        name = ALIAS.get(m[1].lower(), m[1].lower())
        args = tuple(int(x) if re.fullmatch(r"\s*\d+\s*", x) else x.strip().strip("'") for x in m[2].split(",")) if m[2] else ()
        if name not in SINK_TYPE:
            raise ValueError(f"unknown type: {text}")
        return cls(name, args)

    def sink(self) -> str:
        return f"array<{self.item.sink()}>" if self.name == "array" else "object" if self.name == "struct" else SINK_TYPE[self.name]

    def spark(self) -> T.DataType:
        if self.name == "array":
            return T.ArrayType(self.item.spark())
        if self.name == "struct":
            return T.StructType([T.StructField(c.name, c.type.spark(), c.nullable) for c in self.fields])
        if self.name == "decimal":
            precision, scale = (*self.args, 38, 10)[:2] if len(self.args) > 1 else (self.args[0] if self.args else 38, 0 if self.args else 10)
            return T.DecimalType(min(precision, 38), scale) if scale <= 38 else T.StringType()
        if self.name == "thing":
            return T.StructType([T.StructField("tb", T.StringType()), T.StructField("id", T.StringType())])
        return SPARK_TYPE.get(self.name, T.StringType())


@dataclass(frozen=True)
class Column:
    name: str
    type: Type
    nullable: bool = True


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    table: str
    references: tuple[str, ...] = ("id",)


@dataclass(frozen=True)
class Table:
    """``columns`` are those beside the key's first column ``key``; a composite key names all its columns."""

    name: str
    key: Column
    columns: tuple[Column, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    composite_key: tuple[str, ...] = ()

    @property
    def key_columns(self) -> list[str]:
        return list(self.composite_key) or [self.key.name]

    @property
    def all_columns(self) -> list[Column]:
        return [self.key, *self.columns]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type.spark(), c.nullable, {"declared": c.type.name}) for c in self.all_columns])


@dataclass(frozen=True)
class Relation:
    inbound: ForeignKey
    outbound: ForeignKey


def classify(table: Table, forced: tuple[str, ...] = ()) -> Relation | None:
    """The two foreign keys that make a table a relation, or None for an entity.

    Named in ``forced``, a table with two foreign keys is one whatever they reference. Otherwise the first two that
    reference different tables must together be just the primary key.
    """
    keys = table.foreign_keys
    if len(keys) < 2:
        return None
    if table.name in forced:
        return Relation(keys[0], keys[1])
    pair = next(((a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if a.table != b.table), None)
    if pair and {*pair[0].columns, *pair[1].columns} == set(table.key_columns):
        return Relation(*pair)
    return None


def id_override(text: str) -> tuple[str, tuple[str, ...]]:
    """``table=a,b``"""
    table, _, columns = text.partition("=")
    names = tuple(c.strip() for c in columns.split(",") if c.strip())
    if not table.strip() or not names:
        raise ValueError(f"expected table=column[,column]: {text}")
    return table.strip(), names


def rekey(tables: list[Table], overrides: dict[str, tuple[str, ...]]) -> list[Table]:
    """Tables with other key columns; a column that a table doesn't declare is text, a table that isn't there is an error."""
    if missing := set(overrides) - {t.name for t in tables}:
        raise ValueError(f"no such table: {', '.join(sorted(missing))}")
    out = []
    for t in tables:
        if t.name in overrides:
            names = overrides[t.name]
            by = {c.name: c for c in t.all_columns}
            key = by.get(names[0], Column(names[0], Type("text"), False))
            t = replace(t, key=key, columns=tuple(c for c in t.all_columns if c.name != key.name), composite_key=names if len(names) > 1 else ())
        out.append(t)
    return out


def quoted(name: str) -> str:
    return name if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name, re.ASCII) else "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Extras:
    """What a sink schema has beside the tables' own columns."""

    fields: tuple[tuple[str, str, str, bool], ...] = ()  # table, field, type, nullable
    indexes: tuple[tuple[str, str, tuple[str, ...], bool], ...] = ()  # name, table, fields, unique
    scalar_targets: frozenset[str] = frozenset()
    relations: tuple[str, ...] = ()
    periods: tuple[tuple[str, str, str], ...] = ()  # table, start, end


def ddl(tables: list[Table], extras: Extras = Extras()) -> list[str]:
    """Statements that define the tables, their fields and indexes in a schemafull sink."""
    optional = lambda kind, nullable: f"option<{kind}>" if nullable else kind

    def define(table: str, name: str, kind: str, check: bool) -> str:
        start = next((s for t, s, e in extras.periods if (t, e) == (table, name)), None) if check else None
        return f"DEFINE FIELD {quoted(name)} ON {quoted(table)} TYPE {kind}" + (f" ASSERT $parent.{quoted(start)} <= $value" if start else "") + ";"

    out = []
    for t in tables:
        relation = classify(t, extras.relations)
        if relation and {relation.inbound.table, relation.outbound.table} & extras.scalar_targets:
            relation = None
        if relation:
            out.append(f"DEFINE TABLE {quoted(t.name)} TYPE RELATION IN {quoted(relation.inbound.table)} OUT {quoted(relation.outbound.table)} SCHEMAFULL;")
            used = {*relation.inbound.columns, *relation.outbound.columns}
            out += [define(t.name, c.name, optional(c.type.sink(), c.nullable), False) for c in t.all_columns if c.name not in used]
        else:
            out.append(f"DEFINE TABLE {quoted(t.name)} SCHEMAFULL;")
            links = {}
            for k in t.foreign_keys:
                if len(k.columns) == 1:
                    links.setdefault(k.columns[0], k.table)
            for c in t.all_columns:
                to = links.get(c.name)
                kind = f"record<{quoted(to)}>" if to and to not in extras.scalar_targets else c.type.sink()
                out.append(define(t.name, c.name, optional(kind, c.nullable), True))
        own = {c.name for c in t.all_columns}
        out += [define(t.name, f, optional(kind, nullable), True) for table, f, kind, nullable in extras.fields if table == t.name and f not in own]
    for name, table, fields, unique in extras.indexes:
        if fields != ("id",):
            out.append(f"DEFINE INDEX {quoted(name)} ON {quoted(table)} FIELDS {', '.join(map(quoted, fields))}{' UNIQUE' if unique else ''};")
    return out
