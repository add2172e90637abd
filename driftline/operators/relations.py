"""Foreign keys as record links, join tables as edges, graph scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import flatten_id, record
from ..schema import Relation, Table


def link_foreign_keys(df: DataFrame, table: Table, scalar_targets: frozenset[str] = frozenset()) -> DataFrame:
    """Columns of one-column foreign keys become links; composite ones and those to ``scalar_targets`` stay."""
    own = {k.columns[0]: record(k.table, F.col(k.columns[0])) for k in table.foreign_keys if len(k.columns) == 1 and k.table not in scalar_targets}
    return df.withColumns(own) if own else df


def edges(df: DataFrame, table: Table, relation: Relation, separator: str = ":") -> DataFrame:
    """``in``, ``out``, ``id`` and the remaining columns of a join table's rows."""
    end = lambda k: record(k.table, F.col(k.columns[0]) if len(k.columns) == 1 else flatten_id(F.array(*[F.col(c).cast("string") for c in k.columns]), separator))
    used = {*relation.inbound.columns, *relation.outbound.columns}
    key = flatten_id(F.array(*[F.col(c).cast("string") for c in table.key_columns]), separator)
    return df.select(end(relation.inbound).alias("in"), end(relation.outbound).alias("out"), key.alias("id"), *[F.col(c) for c in df.columns if c not in used])


def endpoints(edges: DataFrame, nodes: DataFrame, key: str, start: str, end: str, columns: list[str]) -> DataFrame:
    """Edges with both nodes' columns, as ``start_*`` and ``end_*``."""
    side = lambda name, by: nodes.select(F.col(key).alias(by), *[F.col(c).alias(f"{name}_{c}") for c in columns])
    return edges.join(side("start", start), start).join(side("end", end), end)


def by_label(nodes: DataFrame, labels: str = "labels", first_only: bool = False) -> DataFrame:
    """A row for each label of a node, as a full scan writes them; ``first_only`` is what the tail does."""
    return nodes.withColumn("_table", F.get(labels, F.lit(0)) if first_only else F.explode(labels))
