"""Typed comparison of what was expected and what arrived, and rollups of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import Type

# fixed values: how far numbers of a type may differ
TOLERANCE = {"float32": 1e-6, "float64": 1e-10, "decimal": 1e-3}
INTEGERS = ("int8", "int16", "int32", "int64")
INSTANTS = ("zoned_datetime", "local_datetime", "local_datetime_nano")
DOCUMENTS = ("json", "jsonb", "object", "geometry")
#: The Spark types in which a value of a declared type may arrive; text for those that aren't here.
ARRIVES = {
    "bool": (T.BooleanType,), **dict.fromkeys((*INTEGERS, *TOLERANCE), (T.NumericType,)), **dict.fromkeys(("bytes", "blob"), (T.BinaryType,)),
    **dict.fromkeys(INSTANTS, (T.TimestampType, T.TimestampNTZType)), "duration": (T.DayTimeIntervalType,), "set": (T.ArrayType,), "date": (T.StringType, T.DateType),
    "array": (T.ArrayType,), "struct": (T.StructType,), "thing": (T.StructType, T.StringType), **dict.fromkeys(DOCUMENTS, (T.StringType, T.VariantType, T.StructType, T.MapType, T.ArrayType)),
}


def _document(c: Column, kind: T.DataType) -> Column:
    """A document as a variant, whose keys are sorted and in which 1 and 1.0 are one number."""
    if isinstance(kind, T.VariantType):
        return F.try_parse_json(F.to_json(c))
    return F.try_parse_json(c if isinstance(kind, T.StringType) else F.to_json(c))


def _documents(expected: Column, actual: Column, was: T.DataType, came: T.DataType) -> Column:
    a, b = _document(expected, was), _document(actual, came)
    alike = F.coalesce(F.to_json(a) == F.to_json(b), F.lit(False))
    if isinstance(was, T.StringType) and isinstance(came, T.StringType):
        alike = alike | (expected == actual)  # texts that are no JSON
    one, other = (F.try_variant_get(v, "$", "map<string,variant>") for v in (a, b))
    keys = F.array_sort(F.array_union(F.map_keys(one), F.map_keys(other)))
    differs = F.filter(keys, lambda k: ~F.to_json(F.try_element_at(one, k)).eqNullSafe(F.to_json(F.try_element_at(other, k))))
    return F.when(~alike, F.coalesce(F.concat(F.lit("."), F.get(differs, F.lit(0))), F.lit("")))


def difference(expected: Column, actual: Column, declared: Type, was: T.DataType, came: T.DataType) -> Column:
    """Where two values of a declared type first differ: the rest of a path (``""`` for the value itself, ``[2].price`` within it), NULL where they are alike.

    NULL equals NULL and a field that one side lacks; a value in a type that the declared one doesn't arrive in (a decimal as text, say) differs. Numbers are
    compared within their type's tolerance, instants by microsecond, UUIDs in any case, sets as multisets, arrays by place, structs by their declared fields
    (a field beyond those differs if it has a value), documents by their content, named down to their first key. ``was`` and ``came`` are the columns' types.
    """
    kind = declared.name
    if not isinstance(came, ARRIVES.get(kind, (T.StringType,))):
        inner = F.lit("")
    elif kind == "array" and isinstance(was, T.ArrayType):
        pairs = F.zip_with(expected, actual, lambda e, a: difference(e, a, declared.item, was.elementType, came.elementType))
        places = F.transform(pairs, lambda d, i: F.when(d.isNotNull(), F.concat(F.lit("["), i.cast("string"), F.lit("]"), d)))
        ends = F.when(F.size(expected) != F.size(actual), F.concat(F.lit("["), F.least(F.size(expected), F.size(actual)).cast("string"), F.lit("]")))
        inner = F.coalesce(F.get(F.array_compact(places), F.lit(0)), ends)
    elif kind == "struct" and isinstance(was, T.StructType):
        field = lambda c, of, n: (c[n], of[n].dataType) if n in of.names else (F.lit(None), T.NullType())
        named = {c.name: c.type for c in declared.fields}
        places = []
        for n, own in named.items():
            (e, e_type), (a, a_type) = field(expected, was, n), field(actual, came, n)
            places.append(F.concat(F.lit(f".{n}"), difference(e, a, own, e_type, a_type)))
        places += [F.when(actual[n].isNotNull(), f".{n}") for n in came.names if n not in named]
        inner = F.coalesce(*places, F.lit(None).cast("string"))
    elif kind in DOCUMENTS:
        inner = _documents(expected, actual, was, came)
    else:
        if kind in TOLERANCE:
            equal = F.abs(expected.try_cast("double") - actual.cast("double")) < TOLERANCE[kind]
        elif kind in INTEGERS:
            equal = (expected.try_cast("bigint") if isinstance(was, T.StringType) else expected) == actual
        elif kind in INSTANTS:
            equal = F.unix_micros(expected.cast("timestamp")) == F.unix_micros(actual.cast("timestamp"))
        elif kind == "set":
            equal = F.array_sort(expected) == F.array_sort(actual)
        elif kind == "uuid":
            equal = F.lower(expected) == F.lower(actual)
        elif kind == "date":
            equal = expected.cast("string") == actual.cast("string")
        elif isinstance(was, T.StructType) != isinstance(came, T.StructType) or isinstance(was, T.ArrayType) != isinstance(came, T.ArrayType):
            equal = F.lit(False)
        else:
            equal = expected == actual
        inner = F.when(~F.coalesce(equal, F.lit(False)), "")
    return F.when(expected.isNull() & actual.isNull(), None).when(expected.isNull() | actual.isNull(), "").otherwise(inner)


def compare(expected: DataFrame, actual: DataFrame, keys: list[str], kinds: dict[str, str | Type], ignored: tuple[str, ...] = ()) -> DataFrame:
    """A row for each key of either side: ``status`` matched, missing, extra or mismatched, the mismatched ``fields``, and ``paths`` to where each first differs."""
    kinds = {c: k if isinstance(k, Type) else Type.of(k) for c, k in sorted(kinds.items()) if c not in ignored}
    was, came = expected.schema, actual.schema
    a = expected.select(*keys, F.struct(*kinds).alias("_e"))
    b = actual.select(*keys, F.struct(*kinds).alias("_a"))
    rest = [F.struct(F.lit(c).alias("name"), difference(F.col(f"_e.{c}"), F.col(f"_a.{c}"), k, was[c].dataType, came[c].dataType).alias("rest")) for c, k in kinds.items()]
    both = F.col("_e").isNotNull() & F.col("_a").isNotNull()
    joined = a.join(b, keys, "full_outer").withColumn("_d", F.when(both, F.filter(F.array(*rest), lambda x: x["rest"].isNotNull())))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra").when(F.size("_d") > 0, "mismatched").otherwise("matched")
    return joined.select(*keys, status.alias("status"), F.col("_d.name").alias("fields"), F.transform("_d", lambda x: F.concat(x["name"], x["rest"])).alias("paths"))


def report(compared: DataFrame, by: list[str] = []) -> DataFrame:
    """expected, found, missing, mismatched, matched and pass_rate (1 if nothing was expected)."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    out = compared.groupBy(*by).agg(n("matched", "missing", "mismatched").alias("expected"), n("matched", "mismatched").alias("found"), n("missing").alias("missing"), n("mismatched").alias("mismatched"), n("matched").alias("matched"))
    return out.withColumn("pass_rate", F.when(F.col("expected") == 0, 1.0).otherwise(F.col("matched") / F.col("expected"))).withColumn("success", (F.col("missing") == 0) & (F.col("mismatched") == 0))


def rollup(runs: DataFrame) -> DataFrame:
    """Containers' runs (status, rows, seconds, tables) as one line."""
    done = F.col("status") == "completed"
    sums = runs.agg(F.count(F.lit(1)).alias("total"), F.count_if(done).alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("seconds").alias("seconds"), F.sum(F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds"))).alias("rows_per_second"))
    return sums


def distinct_tables(runs: DataFrame, tables: str = "tables") -> DataFrame:
    return runs.select(F.explode(tables).alias("t")).agg(F.count_distinct("t").alias("n_tables"))


def regressions(now: DataFrame, baseline: DataFrame, keys: list[str], metric: str, percent: float = 10.0) -> DataFrame:
    """Change of a metric in percent where it was measured before, and whether it fell by more than the threshold."""
    joined = now.select(*keys, F.col(metric).alias("now")).join(baseline.select(*keys, F.col(metric).alias("before")), keys)
    change = (F.col("now") - F.col("before")) / F.col("before") * 100
    return joined.withColumn("change", F.when(F.col("before") != 0, change)).withColumn("regressed", F.coalesce(F.col("change") < -percent, F.lit(False)))
