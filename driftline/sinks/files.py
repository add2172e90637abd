"""CSV and JSON-lines output, and a dry run that converts everything and writes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import base64_text, csv_cell


def csv_text(df: DataFrame) -> DataFrame:
    """``line``: each row's cells in the columns' order. Bytes are base64, nested values JSON, timestamps ISO 8601."""

    def cell(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BinaryType):
            c = base64_text(c)
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return csv_cell(c.cast("string"))

    cells = [cell(f) for f in df.schema]
    return df.select(F.concat_ws(",", *cells).alias("line"))


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """A folder of files whose first line names the columns."""
    plain = df.select(*[_text(f) for f in df.schema])
    plain.write.options(header=header, escape='"', emptyValue="", nullValue="").csv(path)


def _text(f: T.StructField):
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.BinaryType):
        return base64_text(c).alias(f.name)
    return F.to_json(c).alias(f.name) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)) else c


def json_text(df: DataFrame) -> DataFrame:
    """``line``: each row as a JSON object; NULLs are kept, bytes are base64."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("line"))


def write_jsonl(df: DataFrame, path: str) -> None:
    json_text(df).write.text(path)


def dry_run(df: DataFrame) -> int:
    """How many rows would be written; every one is converted, and a row that can't be raises as it would."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return seen.get["rows"]
