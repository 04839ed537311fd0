"""Custom fields that the data has and the specification does not know."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemirror.functions import normalize as N
from tidemirror.operators.align import spare_names


class TooManyFields(ValueError):
    """More new fields than a table should be widened by."""


def unknown_fields(records: DataFrame, fields: str, known: Iterable[str]) -> DataFrame:
    """One row per field outside ``known``: ``field``, ``kind``, ``records`` that have it and ``filled`` that are not null.

    ``fields`` names a VARIANT column that holds an object; rows without one tell nothing.
    Names are compared without regard to case, as columns are; spellings that differ by case
    alone are one field, told in the smallest one. ``kind`` is the narrowest of BOOLEAN, BIGINT,
    DOUBLE and STRING that takes every value; objects, lists, mixed values and nulls alone are
    STRING. Counts and types are combined in each task before rows are shuffled.
    """
    rows = records.select(F.col(fields).alias("fields"))
    each = rows.sparkSession.sql("SELECT key, value FROM {rows}, LATERAL variant_explode(fields)", rows=rows)
    names = [name.lower() for name in known]
    new = each.filter(~F.lower("key").isin(names)) if names else each
    void = F.expr("is_variant_null(value)")
    found = new.groupBy(F.lower("key").alias("_name")).agg(
        F.min("key").alias("field"),
        F.schema_of_variant_agg("value").alias("_type"),
        F.count("*").alias("records"),
        F.count_if(~void).alias("filled"),
    )
    whole = F.col("_type").rlike(r"^(BIGINT|DECIMAL\([0-9]+,0\))$")
    broken = F.col("_type").rlike("^(DECIMAL|DOUBLE|FLOAT)")
    kind = F.when(F.col("_type") == "BOOLEAN", "BOOLEAN").when(whole, "BIGINT").when(broken, "DOUBLE").otherwise("STRING")
    return found.select("field", kind.alias("kind"), "records", "filled")


def new_columns(found: DataFrame, least: int = 1, most: int = 200) -> dict[str, str]:
    """Kinds by name of the fields that at least ``least`` records fill; more than ``most`` of them are an error.

    A source that invents names by the record would otherwise widen the table without end.
    """
    rows = found.filter(F.col("filled") >= least).orderBy("field").limit(most + 1).collect()
    if len(rows) > most:
        raise TooManyFields(f"more than {most} new fields, the first {[r['field'] for r in rows[:3]]}")
    return {r["field"]: r["kind"] for r in rows}


def with_fields(records: DataFrame, fields: str, columns: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """``keep`` and a typed column for each of ``columns``, read from the object by the rules of ``normalize``.

    Values that do not fit are null. Together with ``align.evolve`` it widens a table by what the data has.
    """
    (entries,) = spare_names(records, "_entries")
    texts = F.expr(f"from_json(to_json(`{fields}`), 'map<string,string>')")
    read = records.select(*keep, F.map_entries(texts).alias(entries))

    def value(name: str) -> Column:
        # The first of several spellings that differ by case.
        return F.get(F.filter(entries, lambda e: F.lower(e["key"]) == name.lower()), F.lit(0))["value"]

    raws = read.select(*keep, F.struct(*[value(name).alias(f"f{n}") for n, name in enumerate(columns)] or [F.lit(None).alias("none")]).alias(entries))
    typed = [F.expr(N.typed_sql(f"`{entries}`.f{n}", kind)).alias(name) for n, (name, kind) in enumerate(columns.items())]
    return raws.select(*keep, *typed)
