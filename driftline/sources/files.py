"""CSV and JSON-lines files, local or in a store, as typed rows."""

from __future__ import annotations

import json
import uuid
from urllib.parse import urlparse
from urllib.request import urlopen

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts
from ..functions.ids import composite_id, ulid
from ..schema import Table
from ..staging import shared_dir


def parse_uri(uri: str) -> tuple[str, str, bool]:
    """Kind (s3, http or local), the path for a reader and whether it is a directory."""
    scheme = urlparse(uri).scheme
    kind = "s3" if scheme in ("s3", "s3a") else "http" if scheme in ("http", "https") else "local"
    return kind, uri.replace("s3://", "s3a://", 1) if kind == "s3" else uri, uri.endswith("/")


def extension(uri: str) -> str:
    name = urlparse(uri).path.rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[1].lower() if "." in name else ""


def table_name(uri: str) -> str:
    """A file's stem; ``items`` where the path names none."""
    return urlparse(uri).path.rsplit("/", 1)[-1].rsplit(".", 1)[0] or "items"


def fetch(spark: SparkSession, uri: str) -> str:
    """A reader's path for a URI. An HTTP body goes to a file in the shared folder first, in small pieces, so that every executor reads the same."""
    kind, path, _ = parse_uri(uri)
    if kind != "http":
        return path
    to = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/fetched-{uuid.uuid4().hex}/{urlparse(path).path.rsplit('/', 1)[-1] or 'items'}")
    out = to.getFileSystem(spark._jsc.hadoopConfiguration()).create(to, True)
    try:
        with urlopen(path, timeout=60) as body:
            while piece := body.read(1 << 20):
                out.write(piece)
    finally:
        out.close()
    return to.toString()


def read_csv(spark: SparkSession, uri: str, table: Table | None = None, header: bool = True, names: list[str] | None = None, delimiter: str = ",", id_columns: list[str] | None = None, multiline: bool | None = None) -> DataFrame:
    """All cells as text, then as declared (an undeclared column stays text, with its ``_inferred_`` kind); ``_raw_`` holds a cell whose cast failed. Id columns stay.
    Without them ``_id`` is a ULID of the file's name and the row's place in the read, so it stays the same as long as the files do.

    Without a header, columns are ``column_0`` and on, or ``names``. A record with another number of cells is an error.

    Files are split among tasks unless records go over several lines (``multiline``). Where that isn't said, the lines are looked through once, in as many tasks: a record
    that goes on has an odd number of quotes on its first line.
    """
    if len(delimiter) != 1:
        raise ValueError("the delimiter is one character")
    kind, path, folder = parse_uri(uri)
    path = fetch(spark, uri) if kind == "http" else path
    only = {"pathGlobFilter": "*.[cC][sS][vV]"} if folder else {}
    if multiline is None:
        multiline = bool(spark.read.options(**only).text(path).where(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1).take(1))
    raw = spark.read.options(header=header, sep=delimiter, mode="FAILFAST", enforceSchema=False, multiLine=multiline, escape='"', nullValue="\0", **only).csv(path)
    raw = raw.toDF(*(names or (raw.columns if header else [f"column_{i}" for i in range(len(raw.columns))])))
    at = {c: F.col(f"`{c}`") for c in raw.columns}  # a name may hold a dot
    if not id_columns:
        key = ulid(0, F.concat_ws("\0", F.input_file_name(), F.monotonically_increasing_id()))
    else:
        key = at[id_columns[0]].cast("string") if len(id_columns) == 1 else composite_id(*[at[c] for c in id_columns])
    return _typed(raw.select("*", key.alias("_id")), {c.name: c.type for c in table.all_columns} if table else {})


def _typed(df: DataFrame, declared: dict) -> DataFrame:
    """Every cell but ``_id`` as declared, beside what it was."""
    cells, beside = [], []
    for c in df.columns:
        own = F.col(f"`{c}`")
        if c == "_id":
            beside.append(own)
        elif c in declared:
            typed = casts.csv_cast(own, declared[c])
            cells.append(typed.alias(c))
            beside.append(F.when(typed.isNull() & (own != ""), own).alias(f"_raw_{c}"))
        else:
            cells.append(F.when(own != "", own).alias(c))
            beside.append(casts.csv_infer(own).alias(f"_inferred_{c}"))
    return df.select(*cells, *beside)


def read_jsonl(spark: SparkSession, uri: str, table: Table | None = None, id_field: str = "id", rules: list[LinkRule] = []) -> DataFrame:
    """``_id`` (text or integer, an unsigned one beyond a long wraps; missing is an error) and ``doc`` (variant), plus declared columns.

    Of a folder, ``.jsonl``, ``.ndjson`` and ``.json`` files are read. Blank lines are skipped; a line that isn't an object is an error that
    names the file and the line's text. With ``rules`` every object in ``doc``, however deep, that is a link under one of them becomes ``{"tb", "id"}``.
    """
    path = fetch(spark, uri)
    reader = spark.read.option("pathGlobFilter", "*.{jsonl,ndjson,json}") if parse_uri(uri)[2] else spark.read
    lines = reader.text(path).withColumn("file", F.input_file_name()).where(F.trim("value") != "")
    doc = F.try_parse_json(linked(F.col("value"), rules) if rules else F.col("value"))
    bad = doc.isNull() | ~F.schema_of_variant(doc).startswith("OBJECT")
    rows = lines.select(F.when(bad, F.raise_error(F.concat(F.lit("not a JSON object in "), F.col("file"), F.lit(": "), F.substring("value", 1, 200)))).otherwise(doc).alias("doc"))
    own = F.try_variant_get("doc", f"$['{id_field}']", "variant")
    kind = F.schema_of_variant(own)
    wide = F.try_variant_get(own, "$", "decimal(20,0)")
    power = lambda n: F.lit(str(1 << n)).cast("decimal(20,0)")
    wraps = kind.startswith("DECIMAL") & (F.try_variant_get(own, "$", "decimal(38,9)") == wide) & (wide >= power(63)) & (wide < power(64))
    key = F.when(kind.isin("STRING", "BIGINT"), F.try_variant_get(own, "$", "string")).when(wraps, (wide - power(64)).cast("bigint").cast("string"))
    rows = rows.withColumn("_id", F.coalesce(key, F.raise_error(F.lit(f"no usable {id_field}"))))
    columns = {c.name: casts.json_cast(F.try_variant_get("doc", f"$['{c.name}']", "variant"), c.type) for c in (table.all_columns if table else []) if c.name != id_field}
    return rows.withColumns(columns) if columns else rows


def linked(text: Column, rules: list[LinkRule]) -> Column:
    """JSON text in which every object that is a link under a rule is ``{"tb", "id"}``; what isn't JSON stays as it is."""
    known = [(r.kind, r.field, r.table) for r in rules]

    def walk(value):
        if isinstance(value, list):
            return [walk(x) for x in value]
        if not isinstance(value, dict):
            return value
        for kind, field, table in known:
            if value.get("type") == kind and isinstance(value.get(field), str):
                return {"tb": table, "id": value[field]}
        return {k: walk(x) for k, x in value.items()}

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            try:
                doc = json.loads(t)
            except ValueError:
                out.append(t)
                continue
            # the row itself is no link
            out.append(json.dumps({k: walk(x) for k, x in doc.items()} if isinstance(doc, dict) else doc, ensure_ascii=False))
        return pd.Series(out, dtype=object)

    return run(text)


class LinkRule:
    """``type="kind",field table:field``: an object of that type with a text in that field is a link to the table."""

    def __init__(self, text: str):
        kind, comma, rest = text.partition(",")
        name, space, target = rest.strip().partition(" ")
        table, colon, field = target.strip().partition(":")
        kind = kind.strip()
        if not (comma and space and colon and kind.startswith('type="') and kind.endswith('"') and ":" not in field):
            raise ValueError(f'expected type="value",id_field table:id_field, not {text}')
        if name != field:
            raise ValueError(f"{name} is not {field}")
        self.kind, self.field, self.table = kind[6:-1], name, table

    def link(self, value: Column) -> Column:
        """The link that an object (as JSON text) is under this rule, else NULL."""
        parsed = F.try_parse_json(value)
        text = F.try_variant_get(parsed, f"$.{self.field}", "variant")
        holds = (F.try_variant_get(parsed, "$.type", "string") == self.kind) & (F.schema_of_variant(text) == "STRING")
        return F.when(holds, F.struct(F.lit(self.table).alias("tb"), F.try_variant_get(parsed, f"$.{self.field}", "string").alias("id")))
