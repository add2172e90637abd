"""Cells as databases and files write them, and the way back: bytes, epochs, durations, escapes, map keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = r"^[+-]?[0-9]{1,12}(\.[0-9]*)?$"


def hex_bytes(text: Column) -> Column:
    """Bytes of an even number of hex digits in either case, else NULL."""
    return F.when(text.rlike(r"^([0-9a-fA-F]{2})*$"), F.unhex(text))


def base64_text(data: Column) -> Column:
    """Base64 in one line."""
    return F.regexp_replace(F.base64(data), r"[\r\n]", "")


def lsn_bytes(text: Column) -> Column:
    """``0x0000002A:000001F8:0003``, with or without colons and 0x, as ten big-endian bytes, whose order is that of the positions."""
    digits = F.regexp_replace(F.regexp_replace(F.trim(text), "^0[xX]", ""), ":", "")
    return F.when(F.length(digits) == 20, hex_bytes(digits))


def epoch_day(text: Column) -> Column:
    """Days since 1970 as a date; NULL beyond the days of an int."""
    return F.date_from_unix_date(F.when(F.trim(text).rlike(r"^[+-]?[0-9]+$"), F.trim(text).try_cast("int")))


def epoch_nanos(text: Column) -> Column:
    """``seconds.fraction`` as nanoseconds since 1970, further digits cut off; of a negative number the fraction counts downwards, and ``-0.5`` is half
    a second before."""
    own = F.trim(text)
    whole = F.substring_index(own, ".", 1)
    part = F.when(own.contains("."), F.substring_index(own, ".", -1)).otherwise("")
    nanos = F.rpad(F.substring(part, 1, 9), 9, "0").cast("decimal(20,0)")
    signed = F.when(whole.startswith("-"), -nanos).otherwise(nanos)
    return F.when(own.rlike(EPOCH), whole.try_cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)") + signed).cast("decimal(38,0)")


def epoch_timestamp(text: Column) -> Column:
    """The same, to the microsecond, as a timestamp; a token behind the number (a zone, which says nothing new) is passed over."""
    return F.timestamp_micros(F.floor(epoch_nanos(F.substring_index(F.trim(text), " ", 1)) / F.lit(1000).cast("decimal(5,0)")).cast("bigint"))


def epoch_time(text: Column) -> Column:
    """Seconds of a day as ``HH:MM:SS`` and, where there are any, microseconds."""
    micros = F.floor(epoch_nanos(text) / F.lit(1000).cast("decimal(5,0)")).cast("bigint")
    clock = F.date_format(F.timestamp_seconds(F.floor(micros / 1_000_000)), "HH:mm:ss")
    rest = F.regexp_replace(F.lpad((micros % 1_000_000).cast("string"), 6, "0"), "0+$", "")
    return F.when((micros >= 0) & (micros < 86_400_000_000), F.when(rest == "", clock).otherwise(F.concat(clock, F.lit("."), rest)))


def local_to_utc(local: Column, zone: str | Column) -> Column:
    """A wall-clock time in a named zone as an instant (in a session whose zone is UTC)."""
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def duration_text(seconds: Column) -> Column:
    """Decimal seconds as ``PT<seconds>S``, with nine digits of fraction where there is one."""
    own = seconds.cast("decimal(28,9)")
    whole = F.floor(own).cast("bigint")
    return F.concat(F.lit("PT"), F.when(own == whole, whole.cast("string")).otherwise(own.cast("string")), F.lit("S"))


def csv_cell(text: Column) -> Column:
    """A cell of a CSV line: quoted where it holds a comma, a quote or a line end; NULL is empty."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(text.rlike('[",\\r\\n]'), quoted).otherwise(text), F.lit(""))


def quoted_text(text: Column, quote: str = "'") -> Column:
    """A string literal in which backslashes and quotes are escaped by a backslash, and line ends and tabs are spelled."""
    out = text
    for raw, spelled in (("\\", "\\\\"), (quote, "\\" + quote), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(spelled))
    return F.concat(F.lit(quote), out, F.lit(quote))


def renamed_keys(fields: Column, names: dict[str, str]) -> Column:
    """A map under other keys."""
    if not names:
        return fields
    to = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.transform_keys(fields, lambda k, _: F.coalesce(F.element_at(to, k), k))


def without_keys(fields: Column, *names: str) -> Column:
    return F.map_filter(fields, lambda k, _: ~k.isin(*names)) if names else fields
