"""Record to table row: one ``select`` built from an entity's spec."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemirror.functions import normalize as N
from tidemirror.functions import quality as Q
from tidemirror.operators.lookup import lookup
from tidemirror.plans.entities import ChildSpec, EntitySpec, stored_type
from tidemirror.sources import nested

CUSTOM = "custom_field"
# How many times of a row were told but could not be read.
UNREADABLE = "_unreadable"
# The record of a row that breaks a rule, as JSON; null for other rows.
RECORD = "_record"


def record_type(spec: EntitySpec) -> str:
    """Type a record is read with: scalars as texts, so bad values can be told from nulls.

    Fields with a default are read as VARIANT, where a missing key and a null differ.
    """
    texts: dict[str, str] = {}
    for f in spec.declared:
        name = f.name
        source = spec.sources.get(name, name)
        if name.startswith("cf_"):
            texts[CUSTOM] = "MAP<STRING,STRING>"
        elif name in spec.defaults or name in spec.truthy:
            texts[source] = "VARIANT"
        elif name in spec.joined:
            texts[source] = "ARRAY<STRING>"
        elif name in spec.first_of:
            array, item_field = spec.first_of[name]
            texts[array] = f"ARRAY<STRUCT<`{item_field}`: STRING>>"
        elif name not in spec.lookups and name not in spec.always_null:
            texts[source] = "STRING"
    for child in spec.children:
        texts[child.array] = child_array_type(child)
    return "STRUCT<" + ", ".join(f"`{name}`: {kind}" for name, kind in texts.items()) + ">"


def child_array_type(child: ChildSpec) -> str:
    if child.item_column:
        return "ARRAY<STRING>"
    names = [child.sources.get(f.name, f.name) for f in _child_fields(child) if f.name != child.parent_column]
    return "ARRAY<STRUCT<" + ", ".join(f"`{n}`: STRING" for n in names) + ">>"


def envelope_type(spec: EntitySpec) -> str:
    """Type of the items under the envelope key, which may hold the records inside."""
    record = record_type(spec)
    if spec.nested_in:
        return f"STRUCT<`{spec.nested_in[1]}`: ARRAY<{record}>>"
    if spec.option_of:
        return f"STRUCT<name: STRING, choices: ARRAY<{record}>>"
    return record


def unwrap(read: DataFrame, spec: EntitySpec) -> DataFrame:
    """Records out of nested arrays or option lists; other entities pass through.

    ``item`` is a record's position inside what holds it. Option lists are found among
    all fields of a page set, in page order.
    """
    where = [c for c in read.columns if c != "rec"]
    if spec.nested_in:
        items = nested.nested_items(read, F.col("rec")[spec.nested_in[1]], where, "item")
        return items.withColumnRenamed("_item", "rec")
    if spec.option_of:
        named = read.filter(F.col("rec.name") == spec.option_of)
        # Only the first field of the name counts; field definitions are a page or two.
        first = named.groupBy("entity", "view_id").agg(F.min(F.struct("page", "pos")).alias("_at"))
        at = first.select(F.col("entity").alias("_e"), F.col("view_id").alias("_v"), "_at")
        same = (F.col("entity") == F.col("_e")) & (F.col("view_id") == F.col("_v")) & (F.struct("page", "pos") == F.col("_at"))
        choices = named.join(at, same, "left_semi")
        return nested.nested_items(choices, F.col("rec.choices"), where, "item").withColumnRenamed("_item", "rec")
    return read.withColumn("item", F.lit(0))


def project(records: DataFrame, spec: EntitySpec, dimensions: dict[str, DataFrame] | None = None) -> DataFrame:
    """Typed rows with their list of broken rules, and the record of those that break one.

    ``records`` has the record as struct column ``rec``; its other columns are dropped.
    """
    columns: list[str] = []
    raws: list[str] = []
    rules: list[Q.Rule] = []
    times: list[str] = []
    for f in spec.declared:
        value, raw = _value(f, spec)
        columns.append(f"CAST({value} AS {stored_type(f.dataType).simpleString()}) AS `{f.name}`")
        if raw is not None and (f.name in spec.joined or isinstance(f.dataType, T.NumericType)):
            raws.append(f"{raw} AS `_raw_{f.name}`")
        if raw is not None and isinstance(f.dataType, (T.TimestampNTZType, T.DateType)):
            raws.append(f"coalesce(trim({raw}) <> '', false) AS `_told_{f.name}`")
            times.append(f.name)
        rules += _rules(f, spec, raw is not None)
    names = [f"`{n}`" for n in spec.declared.names]
    # Rules look at the finished columns, so no value is computed twice.
    rows = records.selectExpr(*columns, *raws, f"rec AS {RECORD}")
    lost = " + ".join(["0", *[f"int(`_told_{t}` AND `{t}` IS NULL)" for t in times]])
    rows = rows.selectExpr(*names, f"{Q.errors_sql(rules)} AS {Q.ERRORS}", f"{lost} AS {UNREADABLE}", RECORD)
    for column, (dimension, foreign_key) in spec.lookups.items():
        rows = lookup(rows, (dimensions or {}).get(dimension), foreign_key, column)
    return rows.selectExpr(*names, Q.ERRORS, UNREADABLE, f"CASE WHEN size({Q.ERRORS}) > 0 THEN to_json({RECORD}) END AS {RECORD}")


def _rules(f: T.StructField, spec: EntitySpec, has_raw: bool) -> list[Q.Rule]:
    """Rules of one column. Unreadable times become null and are counted; unreadable numbers are errors."""
    rules = []
    if has_raw and f.name in spec.joined:
        rules.append(Q.no_null_items(f.name, f"`_raw_{f.name}`"))
    if has_raw and isinstance(f.dataType, T.NumericType):
        rules.append(Q.readable(f.name, f"`_raw_{f.name}`", f"`{f.name}`"))
    if not f.nullable:
        rules.append(Q.required(f.name))
    if isinstance(f.dataType, T.VarcharType) and f.name not in spec.lookups:
        rules.append(Q.max_length(f.name, f.dataType.length))
    return rules


def project_children(records: DataFrame, spec: EntitySpec, child: ChildSpec) -> DataFrame:
    """Child rows or relation pairs of the batch, keyed by their parent."""
    parent = F.expr(N.typed_sql(f"rec.`{spec.key}`", "bigint")).alias(child.parent_column)
    items = nested.nested_items(records, F.col("rec")[child.array], [parent])
    if child.item_column:
        return items.selectExpr(child.parent_column, f"{N.typed_sql('_item', 'bigint')} AS {child.item_column}")
    columns = []
    for f in _child_fields(child):
        if f.name == child.parent_column:
            columns.append(f"`{f.name}`")
            continue
        raw = f"_item.`{child.sources.get(f.name, f.name)}`"
        columns.append(f"{N.typed_sql(raw, stored_type(f.dataType).simpleString())} AS `{f.name}`")
    return items.selectExpr(*columns)


def _child_fields(child: ChildSpec) -> T.StructType:
    return T.StructType.fromDDL(child.ddl)


def _value(f: T.StructField, spec: EntitySpec) -> tuple[str, str | None]:
    """SQL of a column's value and of the raw value it was read from, if any."""
    name = f.name
    kind = stored_type(f.dataType).simpleString()
    if name in spec.lookups or name in spec.always_null:
        return "NULL", None
    if name in spec.first_of:
        array, item_field = spec.first_of[name]
        raw = N.first_sql(f"rec.`{array}`", item_field)
        return N.typed_sql(raw, kind), raw
    raw = f"rec.{CUSTOM}['{name}']" if name.startswith("cf_") else f"rec.`{spec.sources.get(name, name)}`"
    if name in spec.defaults:
        return N.default_sql(raw, spec.defaults[name], kind), None
    if name in spec.truthy:
        return N.truthy_sql(raw), None
    if name in spec.joined:
        return N.joined_sql(raw), raw
    return N.typed_sql(raw, kind), raw
