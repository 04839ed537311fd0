"""Turn raw source values into typed ones.

Each function takes the raw value as a column name or SQL expression, as text (or
VARIANT where a missing key and an explicit null differ), and gives a column. None
raises on bad input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts read as true (compared in lower case, without trimming).
TRUE_TEXTS = ("true", "1", "si", "sí", "yes")

# Accepted range of a stored timestamp, both ends included.
MIN_TIMESTAMP = "1753-01-01 00:00:00"
MAX_TIMESTAMP = "9999-12-31 00:00:00"

# Accepted besides ISO 8601: what a text looks like, and how its date is read. Month comes
# first in the slash form, unless it would exceed 12.
OTHER_DATES = (
    ("^(?:1[3-9]|2[0-9]|3[01])/", "d/M/yyyy"),
    ("^[0-9]{1,2}/", "M/d/yyyy"),
    ("^[0-9]{4}/", "yyyy/M/d"),
    ("^[0-9]{4}-", "yyyy-M-d"),
    ("^[0-9]{8}T", "yyyyMMdd''T''HHmmss"),
    ("^[0-9]{8}", "yyyyMMdd"),
    ("^[A-Za-z]{3} ", "MMM d[,] yyyy"),
    ("^[A-Za-z]+ ", "MMMM d[,] yyyy"),
    ("^[0-9]{1,2} [A-Za-z]{3} ", "d MMM yyyy"),
    ("^[0-9]{1,2} [A-Za-z]+ ", "d MMMM yyyy"),
)
# Their time of day, with and without a half of the day; brackets mark what may be missing.
_HALF_DAY, _DAY = " h:mm[:ss] a", "[ H:mm[:ss]]"

# Dropped before those: a day of the week in front, and after a time its sub-seconds and zone.
_WEEKDAY = "^ *(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,? +"
_ZONE = "(:[0-9]{2})(?:[.,][0-9]+)? *(?:Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2})? *$"

# The commonest of them, read with one fixed format: "Tue, 05 Mar 2024 10:11:12 GMT".
_MAIL = "^ *(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun), ([0-9]{2} [A-Za-z]{3} [0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}) *(?:Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2})? *$"

# A full date, then a time; sub-seconds and the offset fall outside the group, so
# they are dropped without a conversion. A bare cast would complete "2024" or "2024-03".
_ISO = (
    "^ *([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[T ][0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)?)"
    "(?:[.,][0-9]+)? *(?:Z|UTC|GMT|[+-][0-9]{2}(?::?[0-9]{2})?)? *$"
)


def parse_ts(raw: str) -> Column:
    """Lenient timestamp: offset dropped unconverted, sub-seconds cut, range checked."""
    return F.expr(ts_sql(raw))


def parse_date(raw: str) -> Column:
    return F.expr(date_sql(raw))


def to_bit(raw: str) -> Column:
    """Null stays null, a true text is true, anything else is false."""
    return F.expr(bit_sql(raw))


def truthy_bit(value: str) -> Column:
    """VARIANT to bit: missing, null, false, zero and empty are false, the rest true."""
    return F.expr(truthy_sql(value))


def default_if_missing(value: str, default: bool, sql_type: str = "boolean") -> Column:
    """VARIANT to typed value: the default for a missing key, null for an explicit null."""
    return F.expr(default_sql(value, default, sql_type))


def join_list(items: str, separator: str = ",") -> Column:
    """Text of a list; a null or empty list gives an empty text."""
    return F.expr(joined_sql(items, separator))


def first_element(items: str, field: str) -> Column:
    """One field of a list's first struct, null for a missing or empty list."""
    return F.expr(first_sql(items, field))


def typed(raw: str, sql_type: str) -> Column:
    """Text to ``sql_type``; null where it cannot be read."""
    return F.expr(typed_sql(raw, sql_type))


def flatten_json_fields(raw: str, fields: dict[str, str]) -> list[Column]:
    """Typed columns out of a JSON object with dynamic keys.

    ``fields`` maps each key to BIT or a Spark type. The object is read as a map of
    texts, which keeps the spelling of numbers and booleans.
    """
    found = f"from_json({raw}, 'map<string,string>')"
    return [F.expr(typed_sql(f"{found}['{name}']", kind)).alias(name) for name, kind in fields.items()]


# The same as SQL texts. A wide projection is one list of them, which plans much faster
# than a tree of single calls.


def typed_sql(raw: str, sql_type: str) -> str:
    """Text to ``sql_type`` by the rules above; null where it cannot be read."""
    kind = sql_type.lower()
    if kind in ("bit", "boolean"):
        return bit_sql(raw)
    if kind == "timestamp_ntz":
        return ts_sql(raw)
    if kind == "date":
        return date_sql(raw)
    if kind == "string":
        return raw
    if kind in ("bigint", "int"):
        # A JSON number such as 5.0 is no integer text; its fraction is cut.
        cut = f"try_cast(try_cast({raw} AS DECIMAL(38,6)) AS {kind})"
        return f"coalesce(try_cast({raw} AS {kind}), {cut})"
    return f"try_cast({raw} AS {sql_type})"


def ts_sql(raw: str) -> str:
    iso = f"try_cast(regexp_extract({raw}, '{_ISO}', 1) AS TIMESTAMP_NTZ)"
    plain = f"trim(regexp_replace(regexp_replace(r, '{_WEEKDAY}', ''), '{_ZONE}', '$1'))"
    date = " ".join(f"WHEN p RLIKE '{shape}' THEN '{form}'" for shape, form in OTHER_DATES)
    # One reading per text: its shape decides the format.
    form = f"concat(CASE {date} END, if(p RLIKE '[AaPp][Mm]$', '{_HALF_DAY}', '{_DAY}'))"
    # As functions of a list's items, the rare spellings stay out of the generated code,
    # which a row of many times would otherwise make too long to compile.
    read = f"CAST(try_to_timestamp(p, {form}) AS TIMESTAMP_NTZ)"
    other = f"get(transform(transform(array({raw}), r -> {plain}), p -> {read}), 0)"
    mail = f"CAST(try_to_timestamp(nullif(regexp_extract({raw}, '{_MAIL}', 1), ''), 'dd MMM yyyy HH:mm:ss') AS TIMESTAMP_NTZ)"
    found = f"coalesce({iso}, {mail}, {other})"
    low, high = f"TIMESTAMP_NTZ '{MIN_TIMESTAMP}'", f"TIMESTAMP_NTZ '{MAX_TIMESTAMP}'"
    # A list of one text again: it is read once, whatever is asked of it.
    return f"get(filter(array({found}), t -> t BETWEEN {low} AND {high}), 0)"


def date_sql(raw: str) -> str:
    return f"CAST({ts_sql(raw)} AS DATE)"


def bit_sql(raw: str) -> str:
    texts = ", ".join(f"'{text}'" for text in TRUE_TEXTS)
    return f"CASE WHEN {raw} IS NOT NULL THEN lower({raw}) IN ({texts}) END"


def truthy_sql(value: str) -> str:
    return f"""coalesce(to_json({value}) NOT IN ('null', 'false', '0', '""', '[]', '{{}}'), false)"""


def default_sql(value: str, default: bool, sql_type: str = "boolean") -> str:
    typed_value = f"try_variant_get({value}, '$', '{sql_type}')"
    return f"CASE WHEN {value} IS NULL THEN CAST('{default}' AS {sql_type}) ELSE {typed_value} END"


def joined_sql(items: str, separator: str = ",") -> str:
    return f"concat_ws('{separator}', {items})"


def first_sql(items: str, field: str) -> str:
    return f"get({items}, 0).`{field}`"
