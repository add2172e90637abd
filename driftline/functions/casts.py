"""Texts and JSON values to declared types, as column expressions. A text that isn't of its type gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import Type

INTEGER = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
UUID = r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
NAIVE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?$"
# fixed values: words that are true or false
TRUE, FALSE = ("true", "1", "yes", "t", "y"), ("false", "0", "no", "f", "n")
# fixed values: seconds in a unit of an interval, months of 30 days and years of 360
UNITS = {
    1: ("second", "seconds", "sec", "secs", "s"), 60: ("minute", "minutes", "min", "mins", "m"), 3600: ("hour", "hours", "hr", "hrs", "h"), 86400: ("day", "days", "d"),
    604800: ("week", "weeks", "w"), 2592000: ("month", "months", "mon", "mons"), 31104000: ("year", "years", "yr", "yrs", "y"),
}


def _if(text: Column, pattern: str, kind: str) -> Column:
    return F.when(text.rlike(pattern), text.try_cast(kind))


def duration_seconds(text: Column, strict_reference: bool = False) -> Column:
    """``PT12.5S`` as decimal seconds. ``strict_reference`` reads the fraction as a whole number of nanoseconds, as the reference does."""
    whole, part = F.regexp_extract(text, r"^PT(\d+)(?:\.(\d{1,9}))?S$", 1), F.regexp_extract(text, r"^PT(\d+)(?:\.(\d{1,9}))?S$", 2)
    digits = F.lpad(part, 9, "0") if strict_reference else F.rpad(part, 9, "0")
    return F.when(whole != "", F.concat(whole, F.lit("."), F.when(part == "", "000000000").otherwise(digits)).try_cast("decimal(28,9)"))


def boolean(text: Column) -> Column:
    word = F.lower(text)
    return F.when(word.isin(*TRUE), True).when(word.isin(*FALSE), False)


def local_datetime(text: Column) -> Column:
    return F.when(text.rlike(NAIVE), F.replace(text, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz"))


def zoned_datetime(text: Column) -> Column:
    return F.coalesce(F.when(text.rlike(RFC3339), text.try_cast("timestamp")), F.when(text.rlike(NAIVE), F.concat(text, F.lit("Z")).try_cast("timestamp")))


def csv_cast(text: Column, declared: Type) -> Column:
    """A CSV cell as its declared type; an empty cell is NULL."""
    cell = F.when(text != "", text)
    name = declared.name
    if name == "bool":
        return boolean(cell)
    if name in ("int8", "int16", "int32", "int64"):
        return _if(cell, INTEGER, {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint"}[name])
    if name in ("float32", "float64"):
        return _if(cell, NUMBER, "float" if name == "float32" else "double")
    if name == "decimal":
        return _if(cell, NUMBER, declared.spark().simpleString())
    if name in ("blob", "bytes"):
        return F.try_to_binary(cell, F.lit("base64"))
    if name == "date":
        return F.when(cell.rlike(r"^\d{4}-\d{2}-\d{2}$"), cell.try_cast("date"))
    if name == "time":
        return F.when(cell.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?$"), cell)
    if name in ("local_datetime", "local_datetime_nano"):
        return local_datetime(cell)
    if name == "zoned_datetime":
        return zoned_datetime(cell)
    if name == "uuid":
        return F.when(cell.rlike(UUID), F.lower(cell))
    if name in ("json", "jsonb", "object"):
        return F.try_parse_json(cell)
    if name == "set":
        return F.transform(F.split(cell, ","), lambda x: F.trim(x))
    if name == "duration":
        return duration_seconds(cell)
    if name == "thing":
        at = F.instr(cell, ":")
        return F.when(at > 1, F.struct(F.substring(cell, F.lit(1), at - 1).alias("tb"), F.substring(cell, at + 1, F.length(cell)).alias("id")))
    if name == "array":
        return F.try_variant_get(F.try_parse_json(cell), "$", declared.spark().simpleString())
    return cell


def csv_infer(text: Column) -> Column:
    """The kind an undeclared cell has: ``null``, ``int``, ``float``, ``bool`` or ``text``, in that order of trial."""
    return (
        F.when(text.isNull() | (text == ""), "null")
        .when(text.rlike(INTEGER) & text.try_cast("bigint").isNotNull(), "int")
        .when(text.rlike(NUMBER) | F.lower(text).isin("inf", "+inf", "-inf", "infinity", "-infinity", "nan"), "float")
        .when(F.lower(text).isin("true", "false"), "bool")
        .otherwise("text")
    )


def json_infer(value: Column) -> Column:
    """The kind of a JSON value (as variant): null, bool, int, float, uuid, datetime, text, array or object."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(value.isNull() | F.is_variant_null(value), "null")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "BIGINT", "int")
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "float")
        .when(kind == "STRING", F.when(text.rlike(UUID), "uuid").when(text.rlike(RFC3339) & text.try_cast("timestamp").isNotNull(), "datetime").otherwise("text"))
        .when(kind.startswith("ARRAY"), "array")
        .otherwise("object")
    )


def wrap(value: Column, bits: int) -> Column:
    """A long narrowed to ``bits`` as two's complement does."""
    half = 1 << (bits - 1)
    return F.pmod(value + half, F.lit(1 << bits)) - half


def json_cast(value: Column, declared: Type) -> Column:
    """A JSON value (as variant) as its declared type; another kind of value is NULL, integers narrow by wrapping, 0 and 1 are booleans."""
    get = lambda kind: F.try_variant_get(value, "$", kind)
    kind, name = F.schema_of_variant(value), declared.name
    whole = F.when(kind == "BIGINT", get("bigint"))
    if name == "bool":
        return F.when(kind == "BOOLEAN", get("boolean")).when(whole == 0, False).when(whole == 1, True)
    if name in ("int8", "int16", "int32"):
        bits = int(name[3:])
        return wrap(whole, bits).cast({8: "tinyint", 16: "smallint", 32: "int"}[bits])
    if name == "int64":
        return whole
    if name in ("float32", "float64"):
        return F.when((kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE"), get("double")).cast("float" if name == "float32" else "double")
    if name in ("json", "jsonb", "object"):
        return value
    if name == "array":
        return get(declared.spark().simpleString())
    text = F.when(kind == "STRING", get("string"))
    if name in ("char", "varchar", "text", "enum"):
        return text
    if name == "decimal":
        return F.coalesce(F.when(kind != "STRING", get(declared.spark().simpleString())), csv_cast(text, declared))
    return csv_cast(text, declared)


def is_zero_temporal(text: Column) -> Column:
    """The literals of a zero date or date-time."""
    return text.rlike(r"^0000-00-00([ T]00:00:00(\.0+)?)?$")


def zero_temporal(text: Column, policy: str, typed: Column) -> Column:
    """What a zero date becomes, as text: ``none`` and ``null`` leave it out, ``string`` keeps its literal."""
    kept = F.when(is_zero_temporal(text), F.when(F.length(text) > 10, "0000-00-00 00:00:00").otherwise("0000-00-00") if policy == "string" else F.lit(None))
    return F.when(is_zero_temporal(text), kept).otherwise(typed.cast("string"))


def set_labels(mask: Column, labels: list[str]) -> Column:
    """Labels of the bits of a SET, lowest first."""
    return F.filter(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, x) for i, x in enumerate(labels)]), lambda x: x.isNotNull())


def enum_label(index: Column, labels: list[str]) -> Column:
    """The label of an ENUM's index: 0 and less are empty, beyond the last the index itself."""
    return F.when(index <= 0, "").when(index > len(labels), index.cast("string")).otherwise(F.get(F.array(*map(F.lit, labels)), (index - 1).cast("int")))


def interval_seconds(text: Column) -> Column:
    """An interval's text (``1 day 02:30:00``, ``2 mons``, ``6years``, ``1 02:30:00``) in seconds; a token that is none gives NULL."""
    token = r"(-?\d+(?:\.\d+)?:-?\d+(?:\.\d+)?:-?\d+(?:\.\d+)?|-?\d+(?:\.\d+)?\s*[a-z]+|-?\d+(?:\.\d+)?(?=\s+-?\d+:))"
    factors = F.create_map(*[F.lit(x) for seconds, names in UNITS.items() for n in names for x in (n, float(seconds))])

    def seconds(t: Column) -> Column:
        clock = F.split(t, ":")
        number = F.regexp_extract(t, r"^(-?\d+(?:\.\d+)?)", 1).cast("double")
        unit = F.regexp_extract(t, r"([a-z]+)$", 1)
        hms = F.element_at(clock, 1).cast("double") * 3600 + F.try_element_at(clock, F.lit(2)).cast("double") * 60 + F.try_element_at(clock, F.lit(3)).cast("double")
        return F.when(F.contains(t, F.lit(":")), hms).when(unit == "", number * 86400).otherwise(number * F.element_at(factors, unit))

    low = F.lower(F.trim(text))
    rest = F.trim(F.regexp_replace(low, token, ""))
    return F.when((rest == "") & (low != ""), F.aggregate(F.transform(F.regexp_extract_all(low, F.lit(token), F.lit(1)), seconds), F.lit(0.0), lambda a, b: a + b))


def pg_array(text: Column) -> Column:
    """``{1,"a b",NULL}`` as an array of texts; a bare NULL is null, quoted elements lose their quotes and escapes. An element that is an array of one more dimension stays a text with its braces."""
    body = F.regexp_extract(text, r"(?s)^\{(.*)\}$", 1)
    items = F.regexp_extract_all(body, F.lit(r'("(?:[^"\\]|\\.)*"|\{(?:[^{}"]|"(?:[^"\\]|\\.)*")*\}|[^,{}]+)'), F.lit(1))
    plain = lambda x: F.when(x.startswith('"'), F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1")).when(F.upper(x) != "NULL", x)
    return F.when(text.rlike(r"(?s)^\{.*\}$"), F.when(body == "", F.array().cast("array<string>")).otherwise(F.transform(items, plain)))


# fixed values: zones by their letters, and months
ZONES = {"PST": "-08:00", "PDT": "-07:00", "MST": "-07:00", "MDT": "-06:00", "CST": "-06:00", "CDT": "-05:00", "EST": "-05:00", "EDT": "-04:00", "UTC": "+00:00", "GMT": "+00:00"}
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def pg_timestamptz(text: Column) -> Column:
    """``2024-01-15 10:30:00.5+02``, with or without minutes in the offset, ``T``, ``Z`` or UTC; ``12/17/1997 07:37:16.00 PST``; ``Wed Dec 17 07:37:16 1997 PST``."""
    own = F.trim(text)
    full = F.regexp_replace(F.regexp_replace(own, r" ?(UTC|Z)$", "+00"), r"([+-]\d{2})$", "$1:00")
    full = F.regexp_replace(full, r"([+-]\d{2})(\d{2})$", "$1:$2")
    iso = F.when(full.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?([+-]\d{2}:\d{2})?$"), full.try_cast("timestamp"))
    zones = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    months = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m, f"{i + 1:02d}")])

    def spelled(pattern: str, year: int, month: Column, day: int, clock: int, zone: int) -> Column:
        part = lambda i: F.regexp_extract(own, pattern, i)
        offset = F.coalesce(F.element_at(zones, part(zone)), F.when(part(zone).rlike(r"^[+-]\d{2}$"), F.concat(part(zone), F.lit(":00"))), F.when(part(zone).rlike(r"^[+-]\d{2}:?\d{2}$"), F.concat(F.substring(part(zone), 1, 3), F.lit(":"), F.right(part(zone), F.lit(2)))))
        return F.when(own.rlike(pattern), F.concat(part(year), F.lit("-"), month, F.lit("-"), F.lpad(part(day), 2, "0"), F.lit(" "), part(clock), offset).try_cast("timestamp"))

    sql = r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{2}:\d{2}:\d{2}(?:\.\d+)?)\s+(\S+)$"
    old = r"^\w+\s+([A-Z][a-z]{2})\s+(\d{1,2})\s+(\d{2}:\d{2}:\d{2})\s+(\d{4})\s+(\S+)$"
    return F.coalesce(iso, spelled(sql, 3, F.lpad(F.regexp_extract(own, sql, 1), 2, "0"), 2, 4, 5), spelled(old, 4, F.element_at(months, F.regexp_extract(own, old, 1)), 2, 3, 5))


def pg_cell(value: Column, declared: Type) -> Column:
    """A cell as PostgreSQL's log writes it (numbers bare, most else as text) as its declared type: arrays as ``{...}``, bytes as ``\\x...``, intervals in seconds."""
    text = F.try_variant_get(value, "$", "string")
    name = declared.name
    if name == "array":
        return F.transform(pg_array(text), lambda x: pg_text(x, declared.item))
    if name in ("bool", "int8", "int16", "int32", "int64", "float32", "float64", "json", "jsonb", "object"):
        return F.coalesce(json_cast(value, declared), pg_text(text, declared)) if name not in ("json", "jsonb", "object") else F.coalesce(F.try_parse_json(F.when(F.schema_of_variant(value) == "STRING", text)), value)
    return pg_text(text, declared)


def pg_text(text: Column, declared: Type) -> Column:
    name = declared.name
    if name in ("blob", "bytes"):
        return F.when(text.startswith("\\x"), F.try_to_binary(F.substring(text, F.lit(3), F.length(text)), F.lit("hex")))
    if name == "zoned_datetime":
        return pg_timestamptz(text)
    if name == "duration":
        return interval_seconds(text)
    return csv_cast(text, declared)
