"""The column functions for SQL text: temporary functions whose bodies are SQL, so Catalyst inlines them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemirror.functions import normalize as N

# Name: arguments, type of the result, body.
_SCALARS = {
    "parse_ts": ("raw STRING", "TIMESTAMP_NTZ", N.ts_sql("raw")),
    "parse_day": ("raw STRING", "DATE", N.date_sql("raw")),
    "to_bit": ("raw STRING", "BOOLEAN", N.bit_sql("raw")),
    "truthy_bit": ("value VARIANT", "BOOLEAN", N.truthy_sql("value")),
    "bit_or_default": ("value VARIANT, otherwise BOOLEAN", "BOOLEAN", "CASE WHEN value IS NULL THEN otherwise ELSE try_variant_get(value, '$', 'boolean') END"),
}

# Records under a key of a page's body as VARIANT, with their place; a body that cannot be read has none.
_RECORDS = """
    SELECT CAST(pos AS INT), col
    FROM posexplode(CAST(try_variant_get(try_parse_json(body), concat('$.', record_key), 'array<variant>') AS ARRAY<VARIANT>))
"""


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the functions in the session and give their names, each with ``prefix`` in front.

    ``parse_ts``, ``parse_day``, ``to_bit``, ``truthy_bit`` and ``bit_or_default`` are the column functions
    of ``normalize``; ``page_records(body, record_key)`` is a table function, to be joined laterally.
    A null argument gives what the column functions give. Registering them again replaces them.
    """
    for name, (arguments, kind, body) in _SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {kind} RETURN {body}")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}page_records(body STRING, record_key STRING) "
        f"RETURNS TABLE(pos INT, rec VARIANT) RETURN {_RECORDS}"
    )
    return [f"{prefix}{name}" for name in (*_SCALARS, "page_records")]
