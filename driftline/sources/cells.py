"""Whole tables as warehouses, document stores and graphs give them: text cells by column type, extended JSON, node properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.casts import boolean
from ..functions.ids import composite_id

# fixed values: names of a warehouse's column types, by what their cells are
WAREHOUSE = {
    "fixed": ("fixed", "number", "decimal", "numeric", "int", "integer", "bigint", "smallint", "tinyint", "byteint"), "real": ("real", "float", "float4", "float8", "double", "double precision"),
    "boolean": ("boolean", "bool"), "date": ("date",), "time": ("time",), "local": ("timestamp_ntz", "timestampntz", "datetime"),
    "zoned": ("timestamp_ltz", "timestampltz", "timestamp_tz", "timestamptz", "timestamp"), "json": ("variant", "object"), "array": ("array",), "binary": ("binary", "varbinary"),
}


def warehouse_cell(text: Column, kind: str, precision: int = 38, scale: int = 0, name: str = "cell") -> Column:
    """A text cell as its column's type says: numbers without scale that all fit a long are longs, dates are days and times seconds since 1970,
    binaries hex. NULL stays NULL; a cell that isn't of its type is an error; a type that isn't known leaves text."""
    found = next((k for k, names in WAREHOUSE.items() if kind.lower() in names), "text")
    own = F.trim(text)
    if found == "fixed":
        out = own.try_cast("bigint") if scale <= 0 and precision <= 18 else own.try_cast(f"decimal({max(1, min(38, precision))},{max(0, min(38, scale))})")
    elif found == "text":
        return text
    elif found in ("json", "array"):
        out = F.try_parse_json(text)
        if found == "array":
            out = F.when(F.schema_of_variant(out).startswith("ARRAY"), out).when(out.isNotNull(), F.try_parse_json(F.concat(F.lit("["), F.to_json(out), F.lit("]"))))
    else:
        out = {
            "real": lambda: own.try_cast("double"), "boolean": lambda: boolean(own), "date": lambda: scalars.epoch_day(own), "time": lambda: scalars.epoch_time(own),
            "local": lambda: scalars.epoch_timestamp(own).cast("timestamp_ntz"), "zoned": lambda: scalars.epoch_timestamp(own), "binary": lambda: scalars.hex_bytes(own),
        }[found]()
    wrong = F.raise_error(F.concat(F.lit(f"{name}: not of type {kind}: "), text))
    return F.when(text.isNull(), None).otherwise(F.coalesce(out, wrong))


def warehouse_rows(cells: DataFrame, columns: dict[str, tuple[str, int, int]], id_columns: list[str]) -> DataFrame:
    """``_id`` and typed columns of rows of text cells. Id columns are found whatever their case; one that isn't there, or another set of columns than declared, is an error."""
    if set(cells.columns) != set(columns):
        raise ValueError(f"columns differ: {sorted(set(cells.columns) ^ set(columns))}")
    by_low = {c.lower(): c for c in columns}
    if missing := [c for c in id_columns if c.lower() not in by_low]:
        raise ValueError(f"no column {', '.join(missing)}")
    typed = cells.select(*[warehouse_cell(F.col(f"`{c}`"), *columns[c], name=c).alias(c) for c in columns])
    return typed.withColumn("_id", composite_id(*[F.col(f"`{by_low[c.lower()]}`") for c in id_columns]))


def extended(value: Column, kind: str) -> Column:
    """A value of extended JSON (as variant; either plain or under its ``$`` name) as a Spark type."""
    get = lambda name, t: F.try_variant_get(value, f"$['${name}']", t)
    if kind in ("int", "bigint", "float", "double") or kind.startswith("decimal"):
        texts = [get(n, "string") for n in ("numberInt", "numberLong", "numberDouble", "numberDecimal")]
        plain = F.when(F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get(value, "$", "string"))
        return F.coalesce(plain, *texts).try_cast(kind)
    if kind == "timestamp":
        millis = F.coalesce(F.try_variant_get(value, "$['$date']['$numberLong']", "bigint"), F.when(F.schema_of_variant(F.try_variant_get(value, "$['$date']", "variant")) == "BIGINT", get("date", "bigint")))
        seconds = F.try_variant_get(value, "$['$timestamp'].t", "bigint")
        return F.coalesce(F.timestamp_millis(millis), F.timestamp_seconds(seconds), get("date", "string").try_cast("timestamp"), F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")).try_cast("timestamp"))
    if kind == "binary":
        return F.try_to_binary(F.coalesce(F.try_variant_get(value, "$['$binary'].base64", "string"), F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))), F.lit("base64"))
    if kind == "string":
        wrapped = [get(n, "string") for n in ("oid", "uuid", "symbol", "code", "numberDecimal")]
        pattern = F.try_variant_get(value, "$['$regularExpression'].pattern", "string")
        flags = F.try_variant_get(value, "$['$regularExpression'].options", "string")
        return F.coalesce(*wrapped, F.when(pattern.isNotNull(), F.concat(F.lit("/"), pattern, F.lit("/"), F.coalesce(flags, F.lit("")))), F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")))
    if kind == "link":
        table, key = get("ref", "string"), F.coalesce(F.try_variant_get(value, "$['$id']['$oid']", "string"), F.try_variant_get(value, "$['$id']", "string"))
        return F.when(table.isNotNull() & key.isNotNull(), F.struct(table.alias("tb"), key.alias("id")))
    return value


def documents(lines: DataFrame, fields: dict[str, str] = {}) -> DataFrame:
    """``value`` (a document of extended JSON a line) as ``_id``, ``doc`` (variant) and typed ``fields``. The id is an object id, a text or a whole number; another kind, or none, is an error."""
    rows = lines.select(F.try_parse_json("value").alias("doc"))
    own = F.try_variant_get("doc", "$._id", "variant")
    kind = F.schema_of_variant(own)
    key = F.coalesce(F.try_variant_get(own, "$['$oid']", "string"), F.when(kind.isin("STRING", "BIGINT"), F.try_variant_get(own, "$", "string")), extended(own, "bigint").cast("string"))
    key = F.coalesce(key, F.raise_error(F.concat(F.lit("no usable _id: "), F.coalesce(F.to_json("doc"), F.lit("not JSON")))))
    return rows.select(key.alias("_id"), "doc", *[extended(F.try_variant_get("doc", f"$['{c}']", "variant"), t).alias(c) for c, t in fields.items()])


def node_ids(nodes: DataFrame, id_property: str = "id", element: str = "element_id", properties: str = "properties") -> DataFrame:
    """Nodes with ``_id``: the id property where a node has it (of text properties), else the store's own id, which is a number if it is written as one; ``number`` says it
    as a long, and the property leaves the map."""
    own = F.coalesce(F.element_at(properties, id_property), F.col(element))
    key = F.coalesce(own, F.raise_error(F.lit("a node has no id")))
    return nodes.withColumns({"_id": key, "number": F.when(own.rlike(r"^[+-]?[0-9]{1,19}$"), own.try_cast("bigint")), properties: scalars.without_keys(F.col(properties), id_property)})
