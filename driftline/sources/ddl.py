"""Statements in a log that change tables: renames, and the columns that rows have from a position on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.changes import as_of
from ..staging import staged

NAME = r"(?:`[^`]+`|\"[^\"]+\"|[\w$]+)"
TABLE = rf"(?:{NAME}\s*\.\s*)?{NAME}"
# what may be renamed inside a table, and so is no new name of it
PARTS = r"(?:COLUMN|INDEX|KEY|CONSTRAINT)\b"


def _name(text: Column) -> Column:
    """Without quotes and database."""
    return F.regexp_replace(F.trim(F.regexp_replace(text, r"^.*\.\s*(?=[^.]+$)", "")), r"[`\"]", "")


def statements(log: DataFrame, sql: str = "sql") -> DataFrame:
    """The statements of ``log`` (``_pos`` and the text) that change tables: ``what`` (create, alter, drop, truncate or rename), ``_table`` and, of a rename,
    ``was``; several renames of one statement are rows of their own, in their order by ``part``."""
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(sql, r"/\*.*?\*/", " "), r"(?m)(--\s|#).*$", " "), r"\s+", " "))
    pairs = F.regexp_extract_all(text, F.lit(rf"(?i)({TABLE} TO {TABLE})"), 1)
    renamed = F.transform(F.when(text.rlike(r"(?i)^RENAME TABLES? "), pairs), lambda p: F.struct(F.lit("rename").alias("what"), _name(F.regexp_extract(p, rf"(?i)^{TABLE} TO ({TABLE})$", 1)).alias("_table"), _name(F.regexp_extract(p, rf"(?i)^({TABLE}) TO ", 1)).alias("was")))
    altered = rf"(?i)^ALTER TABLE ({TABLE})(?: .*)?[ ,]RENAME (?!{PARTS})(?:TO |AS |= ?)?({TABLE})\s*;?$"
    one = lambda what, table, was=None: F.array(F.struct(F.lit(what).alias("what"), _name(table).alias("_table"), (F.lit(None).cast("string") if was is None else _name(was)).alias("was")))
    other = lambda pattern: F.regexp_extract(text, pattern, 1)
    create, alter = rf"(?i)^CREATE (?:TEMPORARY )?TABLE (?:IF NOT EXISTS )?({TABLE})", rf"(?i)^ALTER TABLE ({TABLE})"
    drop, empty = rf"(?i)^DROP (?:TEMPORARY )?TABLE (?:IF EXISTS )?({TABLE})", rf"(?i)^TRUNCATE (?:TABLE )?({TABLE})"
    found = F.coalesce(
        renamed,
        F.when(text.rlike(altered), one("rename", F.regexp_extract(text, altered, 2), F.regexp_extract(text, altered, 1))),
        *[F.when(text.rlike(p), one(what, other(p))) for what, p in (("create", create), ("alter", alter), ("drop", drop), ("truncate", empty))],
    )
    return log.select("_pos", F.posexplode(found).alias("part", "s")).select("_pos", "part", "s.*")


def final_names(renames: DataFrame) -> DataFrame:
    """For each rename (``_pos, part, _table, was``) the name that its table has at the end, as ``final``. Each step follows twice as many renames as the
    one before; there are as many rows as statements that rename."""
    order = F.struct("_pos", "part")
    rows = staged(renames.select(order.alias("at"), "was", F.col("_table").alias("now")), "renames")
    later = rows.select(F.col("at").alias("then"), F.col("was").alias("of"))
    follows = rows.join(later, (F.col("of") == F.col("now")) & (F.col("then") > F.col("at")), "left").groupBy("at", "was", "now").agg(F.min("then").alias("next"))
    rows = staged(follows, "renames")
    while not rows.where("next is not null").isEmpty():
        beyond = rows.select(F.col("at").alias("next"), F.col("now").alias("then_now"), F.col("next").alias("then_next"))
        jumped = rows.join(beyond, "next", "left")
        rows = staged(jumped.select("at", "was", F.coalesce("then_now", "now").alias("now"), F.col("then_next").alias("next")), "renames")
    return rows.select(F.col("at._pos").alias("_pos"), F.col("at.part").alias("part"), "was", F.col("now").alias("final"))


def under_present_names(changes: DataFrame, renames: DataFrame) -> DataFrame:
    """Changes (``_table``, ``_pos`` a number) under the names that their tables have at the end of the log: that of the first rename after them, followed on."""
    named = final_names(renames).withColumn("back", -F.col("_pos")).groupBy("was", "back").agg(F.min_by("final", "part").alias("final"))
    turned = changes.withColumn("back", -F.col("_pos"))
    # the last rename before, seen from the end of the log; one at the change's own position comes after it
    got = as_of(turned.withColumnRenamed("_table", "was"), named, "was", "back", ["final"])
    return got.withColumn("_table", F.coalesce("final", "was")).select(changes.columns)


def with_layouts(rows: DataFrame, layouts: DataFrame, key: str = "table_id", payload: list[str] = ["_table", "columns"]) -> DataFrame:
    """Rows with the layout of their table that was last described before them; a row without one is an error that names its table and position."""
    known = as_of(rows, layouts, key, "_pos", payload)
    missing = F.raise_error(F.concat(F.lit("no table map for "), F.col(key).cast("string"), F.lit(" at "), F.col("_pos").cast("string")))
    return known.withColumn(payload[0], F.when(F.col(payload[0]).isNull(), missing).otherwise(F.col(payload[0])))
