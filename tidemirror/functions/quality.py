"""Row rules: each broken rule adds one text to an error list; rows are then split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS = "_errors"


@dataclass(frozen=True)
class Rule:
    """A named condition, as SQL text, that marks a row as bad when true."""

    name: str
    broken: str


def required(column: str) -> Rule:
    return Rule(f"{column}:missing", f"`{column}` IS NULL")


def max_length(column: str, limit: int) -> Rule:
    return Rule(f"{column}:too_long", f"length(`{column}`) > {limit}")


def in_range(column: str, low, high) -> Rule:
    return Rule(f"{column}:out_of_range", f"NOT (`{column}` BETWEEN {low} AND {high})")


def readable(name: str, raw: str, value: str) -> Rule:
    """A raw value was there but could not be typed."""
    return Rule(f"{name}:unreadable", f"{raw} IS NOT NULL AND {value} IS NULL")


def no_null_items(name: str, items: str) -> Rule:
    return Rule(f"{name}:null_item", f"exists({items}, item -> item IS NULL)")


def errors_sql(rules: list[Rule]) -> str:
    """The names of all broken rules, as one SQL text: wide tables have a hundred of them."""
    marks = ", ".join(f"CASE WHEN {rule.broken} THEN '{rule.name}' END" for rule in rules)
    return f"array_compact(array({marks}))" if rules else "CAST(array() AS ARRAY<STRING>)"


def error_list(rules: list[Rule]) -> Column:
    return F.expr(errors_sql(rules))


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.withColumn(ERRORS, error_list(rules))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the error list, and the quarantined rows with it.

    Both parts read ``checked``, so rows of a wide projection should be written first;
    filtered in the same plan, its many aliases also make the optimizer slow.
    """
    bad = F.size(ERRORS) > 0
    return checked.filter(~bad).drop(ERRORS), checked.filter(bad)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


class RejectedBatch(ValueError):
    """A strict entity met bad rows, or a batch broke a table constraint."""


def require_clean(checked: DataFrame, entity: str) -> None:
    """Strict policy: any bad row fails the whole batch."""
    bad = checked.filter(F.size(ERRORS) > 0)
    sample = bad.select(ERRORS).head(1)
    if sample:
        raise RejectedBatch(f"{entity}: bad rows in a strict batch, first errors {sample[0][0]}")
