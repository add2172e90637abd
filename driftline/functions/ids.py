"""Record ids: composite, flattened and canonical keys, version ids, log positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def composite_id(*parts: Column) -> Column:
    """No part: NULL; one: itself; more: an array of their texts, in which a null part stays null."""
    if not parts:
        return F.lit(None).cast("string")
    return parts[0] if len(parts) == 1 else F.array(*[p.cast("string") for p in parts])


def flatten_id(parts: Column, separator: str = ":") -> Column:
    """The parts of an array id as one text; a null part is an empty string."""
    return F.array_join(parts, separator, "")


def canonical(df: DataFrame, *columns: str) -> Column:
    """A key that is equal for equal values whatever their width: integers as long, others as text, as one JSON array."""
    kinds = dict(df.dtypes)
    wide = [F.col(c).cast("bigint").cast("string") if kinds[c] in ("tinyint", "smallint", "int", "bigint") else F.to_json(F.struct(F.col(c).cast("string").alias("v"))) for c in columns]
    return F.concat(F.lit("["), F.concat_ws(",", *[F.coalesce(w, F.lit("null")) for w in wide]), F.lit("]"))


def content_hash(fields: dict[str, Column]) -> Column:
    """SHA-256 of ``key=json;`` of every field, keys in order."""
    return F.sha2(F.concat(*[F.concat(F.lit(f"{k}="), F.coalesce(v, F.lit("null")), F.lit(";")) for k, v in sorted(fields.items())]), 256)


def record(table: str, key: Column) -> Column:
    """A link to a record; NULL where the key is."""
    return F.when(key.isNotNull(), F.struct(F.lit(table).alias("tb"), key.cast("string").alias("id")))


def link_text(link: Column) -> Column:
    return F.when(link.isNotNull(), F.concat(link["tb"], F.lit(":"), link["id"]))


def ulid(millis: Column | int, seed: Column) -> Column:
    """A 26-letter ULID of a time and 80 bits of a hash of ``seed``: the same seed and time give the same id whenever they are read."""
    millis = F.lit(millis) if isinstance(millis, int) else millis
    bits = F.sha2(seed.cast("string").cast("binary"), 256)
    base32 = lambda hex_, width: F.lpad(F.conv(hex_, 16, 32), width, "0")
    digits = F.concat(base32(F.hex(millis.cast("bigint")), 10), base32(F.substring(bits, 1, 10), 8), base32(F.substring(bits, 11, 10), 8))
    return F.translate(F.upper(digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "0123456789ABCDEFGHJKMNPQRSTVWXYZ")


def lsn(text: Column) -> Column:
    """``16/B374D848`` as a number that orders as positions do."""
    part = lambda i: F.conv(F.element_at(F.split(text, "/"), i), 16, 10).cast("decimal(20,0)")
    return part(1) * F.lit(4294967296).cast("decimal(20,0)") + part(2)
