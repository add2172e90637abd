"""Decoded change records, as text or rows, to changes: ``_table``, ``_op``, ``_id``, ``_pos`` and the image as variant ``data``.

``_id`` is an array of the key's parts as texts, a part that is null staying null, so that no two keys are ever one; a stage flattens it where a text is
wanted. A document's key is one text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import casts
from ..operators.changes import as_of, numbered
from ..schema import Table


def _op(column, unknown: str):
    op = F.when(F.upper(column) == "INSERT", "c").when(F.upper(column) == "UPDATE", "u").when(F.upper(column) == "DELETE", "d")
    return op.otherwise(F.raise_error(F.concat(F.lit("unknown operation: "), column))) if unknown == "error" else op


def from_audit(rows: DataFrame, since: int = 0, size: int | None = None, unknown: str = "skip") -> DataFrame:
    """Rows of a trigger's audit table (sequence_id, table_name, operation, row_id as a JSON array, old_data, new_data) after a sequence number, in order."""
    own = rows.where(F.col("sequence_id") > since)
    own = own.orderBy("sequence_id").limit(size) if size else own
    ids = F.from_json("row_id", "array<string>")
    image = F.try_parse_json(F.coalesce("new_data", F.when(_op(F.col("operation"), "skip") == "d", F.lit(None).cast("string"))))
    out = own.select(F.col("table_name").alias("_table"), _op(F.col("operation"), unknown).alias("_op"), ids.alias("_id"), F.col("sequence_id").alias("_pos"), image.alias("data"))
    return out.where("_op is not null")


def from_wal2json(lines: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """``value`` (one wal2json v2 action a line) and ``_pos``. Keys are the ``pk`` names, or ``id``; deletes have theirs in ``identity``."""
    field = "array<struct<name:string,type:string,value:variant>>"
    doc = F.from_json("value", f"struct<action:string,schema:string,table:string,columns:{field},identity:{field},pk:array<struct<name:string,type:string>>>")
    # lines of other actions go unread; inline keeps the optimizer from reading a line once for each use
    rows = lines.where(F.col("value").rlike(r'"action"\s*:\s*"[IUD]"')).select("_pos", F.inline(F.array(doc))).where(F.col("action").isin("I", "U", "D"))
    for prefix in skip:
        rows = rows.where(~F.col("table").startswith(prefix))
    names = F.when(F.size("pk") > 0, F.transform("pk", lambda p: p["name"])).otherwise(F.array(F.lit("id")))
    gone = F.col("action") == "D"
    cells = F.when(gone, F.col("identity")).otherwise(F.col("columns"))
    of = lambda n: F.try_variant_get(F.get(F.filter(cells, lambda c: c["name"] == n), F.lit(0))["value"], "$", "string")
    op = F.when(F.col("action") == "I", "c").when(F.col("action") == "U", "u").otherwise("d")
    data = F.when(~gone, F.to_variant_object(F.map_from_entries(F.transform("columns", lambda c: F.struct(c["name"], c["value"])))))
    return rows.select(F.col("table").alias("_table"), op.alias("_op"), F.transform(names, of).alias("_id"), "_pos", data.alias("data"))


def pg_cells(changes: DataFrame, table: Table) -> DataFrame:
    """``changes`` with a column for each declared one, typed from the image as PostgreSQL writes its cells."""
    cells = {c.name: casts.pg_cell(F.try_variant_get("data", f"$['{c.name}']", "variant"), c.type) for c in table.all_columns}
    return changes.withColumns(cells)


def from_pgoutput(messages: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded logical-replication messages (_pos, kind, relation_id, old and new as arrays of text cells; a truncate has neither) and the
    relation messages of the same stream (_pos, relation_id, name, columns as an array of struct<name,key>): changes as elsewhere, and the renames
    and truncates met, as ``_pos``, ``what``, ``_table`` and ``was``.

    A message has the layout of the last relation message before it. A relation's new name is a rename of its table.
    """
    known = as_of(messages, relations, "relation_id", "_pos", ["name", "columns"])
    old_or_new = F.when(F.col("kind") == "D", F.col("old")).otherwise(F.col("new"))
    # an update that changes the key has the old one
    key_of = F.when(F.col("kind") == "U", F.coalesce("old", "new")).otherwise(old_or_new)
    pairs = F.arrays_zip("columns", key_of.alias("cells"))
    key = F.transform(F.filter(pairs, lambda p: p["columns"]["key"]), lambda p: p["cells"])
    op = F.when(F.col("kind") == "I", "c").when(F.col("kind") == "U", "u").when(F.col("kind") == "D", "d").otherwise(F.raise_error(F.concat(F.lit("unknown message: "), F.col("kind"))))
    data = F.when(F.col("kind") != "D", F.to_variant_object(F.map_from_arrays(F.transform("columns", lambda c: c["name"]), F.col("new"))))
    checked = F.when(F.col("name").isNull(), F.raise_error(F.lit("a message before its relation"))).otherwise(F.col("name"))
    changes = known.where("kind <> 'T'").select(checked.alias("_table"), op.alias("_op"), key.alias("_id"), "_pos", data.alias("data"))
    # a relation is described a few times
    was = F.lag("name").over(Window.partitionBy("relation_id").orderBy("_pos"))
    renames = relations.withColumn("was", was).where("was is not null and was <> name").select("_pos", F.lit("rename").alias("what"), F.col("name").alias("_table"), "was")
    truncates = known.where("kind = 'T'").select("_pos", F.lit("truncate").alias("what"), F.col("name").alias("_table"), F.lit(None).cast("string").alias("was"))
    return changes, renames.unionByName(truncates)


def from_mongo(lines: DataFrame) -> DataFrame:
    """``value`` (a change event a line) and ``_pos``; update and replace carry the whole document, other operations are an error."""
    doc = F.try_parse_json("value")
    kind = F.try_variant_get(doc, "$.operationType", "string")
    op = F.when(kind == "insert", "c").when(kind.isin("update", "replace"), "u").when(kind == "delete", "d").otherwise(F.raise_error(F.concat(F.lit("unknown operation: "), F.coalesce(kind, F.lit("null")))))
    key = F.coalesce(F.try_variant_get(doc, "$.documentKey._id['$oid']", "string"), F.try_variant_get(doc, "$.documentKey._id", "string"))
    return lines.select(F.try_variant_get(doc, "$.ns.coll", "string").alias("_table"), op.alias("_op"), key.alias("_id"), "_pos", F.when(kind != "delete", F.try_variant_get(doc, "$.fullDocument", "variant")).alias("data"))


def from_cdc(rows: DataFrame, table: str, keys: list[str], low, high, lsn: str = "start_lsn", operation: str = "operation") -> DataFrame:
    """Rows of a change table in (low, high]: 1 deletes, 2 inserts, 3 is an update's image before and drops out, 4 the one after."""
    own = rows.where((F.col(lsn) > low) & (F.col(lsn) <= high) & (F.col(operation) != 3))
    op = F.when(F.col(operation) == 1, "d").when(F.col(operation) == 2, "c").when(F.col(operation) == 4, "u").otherwise(F.raise_error(F.lit("unknown operation")))
    ids = F.array(*[F.col(k).cast("string") for k in keys])
    return own.select(F.lit(table).alias("_table"), op.alias("_op"), ids.alias("_id"), F.col(lsn).alias("_pos"), *[c for c in rows.columns if c not in (lsn, operation)])


def from_binlog(rows: DataFrame, database: str, tables: list[str], keys: list[str], null_after: str = "keep_before") -> DataFrame:
    """Decoded row events (db, table, op, before, after, file, pos). An update's key is the one before; NULLs after it keep the value before, or not with ``plain``."""
    own = rows.where((F.col("db") == database) & F.col("table").isin(tables))
    fields = rows.schema["after"].dataType.names
    after = {f: F.coalesce(F.col(f"after.{f}"), F.col(f"before.{f}")) if null_after == "keep_before" else F.col(f"after.{f}") for f in fields}
    value = lambda f: F.when(F.col("op") == "d", F.col(f"before.{f}")).otherwise(F.when(F.col("op") == "u", F.coalesce(F.col(f"before.{f}"), after[f]) if f in keys else after[f]).otherwise(F.col(f"after.{f}")))
    return own.select(F.col("table").alias("_table"), F.col("op").alias("_op"), F.struct("file", "pos").alias("_pos"), *[value(f).alias(f) for f in fields])


def with_positions(lines: DataFrame, order: list[str]) -> DataFrame:
    """Opaque resume tokens have no order; arrival in the log has. Lines are numbered from 1, by ranges of ``order``."""
    return numbered(lines, order, 1).withColumn("_pos", F.col("row_index") + 1).drop("row_index", "chunk_no")
