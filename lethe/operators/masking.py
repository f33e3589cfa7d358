"""Replace values: tokens per column, in whole tables or in the rows that match."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lethe.functions.hashing import column_token, value_token
from lethe.functions.identity import has_map, quoted
from lethe.functions.text import sql_quote
from lethe.settings import CONTROL_COLUMNS

TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def masked_value(
    field: T.StructField, mode: str = "column_token", salt: str = "", on_non_string: str = "null"
) -> Column:
    """What replaces a value of a column; always of the column's own type.

    ``column_token``: hash of the column's name, the same in every row. ``value_hash``: hash of
    salt and value. ``null``: nothing. A token is text, so columns of other types become null,
    or an error with ``on_non_string="error"``.
    """
    if mode not in ("column_token", "value_hash", "null"):
        raise ValueError("mode is 'column_token', 'value_hash' or 'null'")
    if mode != "null" and isinstance(field.dataType, T.StringType):
        if mode == "column_token":
            return F.lit(column_token(field.name))
        return value_token(F.col(quoted(field.name)), salt)
    if mode != "null" and on_non_string == "error":
        raise TypeError(f"column {field.name} is {field.dataType.simpleString()}, not text")
    return F.lit(None).cast(field.dataType)


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of the columns that the table has, in the table's order."""
    wanted = set(columns)
    return [c for c in df.columns if c in wanted]


def mask(
    df: DataFrame,
    columns: Iterable[str],
    mode: str = "column_token",
    salt: str = "",
    on_non_string: str = "null",
    where: Column | None = None,
) -> DataFrame:
    """Mask columns of all rows, or of the rows under ``where``; others stay as they are."""
    changed = {}
    for name in present(df, columns):
        value = masked_value(df.schema[name], mode, salt, on_non_string)
        if where is not None:
            value = F.when(where, value).otherwise(F.col(quoted(name)))
        changed[name] = value
    return df.withColumns(changed) if changed else df


def strip_control_columns(df: DataFrame) -> DataFrame:
    """Table columns only, without those the report added."""
    return df.drop(*CONTROL_COLUMNS)


def match_columns(
    schema: T.StructType, name_contains: str | None = None, leave_out: Iterable[str] = ()
) -> list[str]:
    """Columns that identify a row for an update: all but points in time.

    By type; with ``name_contains`` by a fragment of the name instead. Maps have no equality
    and are left out.
    """
    skipped = set(leave_out) | set(CONTROL_COLUMNS)
    if name_contains is not None:
        kept = [f for f in schema.fields if name_contains not in f.name]
    else:
        kept = [f for f in schema.fields if not isinstance(f.dataType, TIME_TYPES)]
    return [f.name for f in kept if f.name not in skipped and not has_map(f.dataType)]


def _literal(field: T.StructField) -> Column:
    """SQL text of a value: numbers bare, everything else quoted, null as NULL."""
    text = F.col(quoted(field.name)).cast("string")
    bare = isinstance(field.dataType, (T.NumericType, T.BooleanType))
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        value = F.when(F.isnan(quoted(field.name)), sql_quote(text)).otherwise(text)
    else:
        value = text if bare else sql_quote(text)
    return F.coalesce(value, F.lit("NULL"))


def _equals(field: T.StructField) -> Column:
    name = field.name
    return F.when(F.col(quoted(name)).isNull(), f"{name} IS NULL").otherwise(
        F.concat(F.lit(f"{name} = "), _literal(field))
    )


def update_script(
    flagged: DataFrame,
    table_name: str,
    columns: Iterable[str],
    match: Sequence[str] | None = None,
) -> DataFrame:
    """One SQL UPDATE text per flagged row, for a warehouse that is changed by script."""
    rows = strip_control_columns(flagged)
    match = list(match) if match is not None else match_columns(rows.schema)
    changes = []
    for name in present(rows, columns):
        text = isinstance(rows.schema[name].dataType, T.StringType)
        changes.append(f"{name} = '{column_token(name)}'" if text else f"{name} = NULL")
    if not changes:
        return rows.select(F.lit("").alias("statement")).where(F.lit(False))
    conditions = F.concat_ws(" AND ", *[_equals(rows.schema[c]) for c in match])
    head = f"UPDATE {table_name} SET {', '.join(changes)} WHERE "
    return rows.select(F.concat(F.lit(head), conditions, F.lit(";")).alias("statement"))
