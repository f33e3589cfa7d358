"""Steps of the search: seed, route, probe, harvest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lethe.functions.identity import (
    as_text,
    equals_text,
    id_of_json,
    partition_text,
    quoted,
    row_json,
    sort_key,
)
from lethe.operators.lookup import Size, lookup_join, measure
from lethe.operators.screen import screen
from lethe.settings import Limits

PAIR = T.StructType([T.StructField("column", T.StringType()), T.StructField("value", T.StringType())])
SORT_KEY = T.ArrayType(
    T.StructType(
        [
            T.StructField("whole", T.LongType()),
            T.StructField("number", T.DoubleType()),
            T.StructField("text", T.StringType()),
        ]
    )
)
HIT_SCHEMA = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("pass", T.IntegerType()),
        T.StructField("matched_column", T.StringType()),
        T.StructField("matched_value", T.StringType()),
        T.StructField("row_id", T.StringType()),
        T.StructField("partition", T.StringType()),
        T.StructField("row_json", T.StringType()),
        T.StructField("keys", T.ArrayType(PAIR)),
        T.StructField("order_key", SORT_KEY),
    ]
)
_STORED = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
PROBE_SCHEMA = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("table_name", T.StringType()),
    ]
)


def find_by_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column, taken as text, is the value."""
    return df.where(equals_text(df.schema, column, [value]))


def frontier_seed(subjects: DataFrame, link_columns: Sequence[str]) -> DataFrame:
    """``(subject, column, value)``: every address column may hold every subject."""
    return subjects.select(
        "subject",
        F.explode(F.array(*[F.lit(c) for c in link_columns])).alias("column"),
        F.col("subject").alias("value"),
    )


def route(frontier: DataFrame, table_columns: DataFrame) -> DataFrame:
    """Pair each search value with the tables that have its column, before any scan."""
    return frontier.join(table_columns.select("table_name", "column"), "column").select(
        "subject", "column", "value", "table_name"
    )


def still_open(routed: DataFrame, closed: DataFrame, size: Size, limits: Limits) -> DataFrame:
    """Leave out tables already found for the subject. ``size`` bounds ``closed``."""
    on = ["subject", "table_name"]
    return lookup_join(routed, closed, on, "left_anti", limits, size, spread_by=routed.columns)


def remaining_tables(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """``(subject, table_name)`` without those found."""
    return wanted.join(found, ["subject", "table_name"], "left_anti")


def key_pairs(columns: Sequence[str]) -> Column:
    """A row's key columns as ``(column, value)`` pairs; a missing value stays null.

    Nulls match nothing and are not harvested, so they need no filter per row here.
    """
    if not columns:
        return F.array().cast(T.ArrayType(PAIR))
    return F.array(
        *[F.struct(F.lit(c).alias("column"), as_text(c).alias("value")) for c in columns]
    )


def probe(
    df: DataFrame,
    name: str,
    source: str,
    probes: DataFrame,
    probe_columns: Sequence[str],
    key_columns: Sequence[str],
    size: Size,
    limits: Limits,
    literals: Mapping[str, Sequence[str]] | None = None,
    partition_columns: Sequence[str] = (),
    order_columns: Sequence[str] | None = None,
) -> DataFrame:
    """All hits of one table with all search values of all subjects, in one scan: its matches, as hits."""
    found = matches(df, probes, probe_columns, size, limits, literals)
    return as_hits(found, name, source, df.schema, key_columns, partition_columns, order_columns)


def matches(
    df: DataFrame,
    probes: DataFrame,
    probe_columns: Sequence[str],
    size: Size,
    limits: Limits,
    literals: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows of ``df`` as they are, once for each search value they hold, with ``__subject``, ``__column`` and ``__value``.

    ``probes`` is ``(subject, column, value)`` of measured ``size``. With ``literals``
    (column -> values, the same values) the scan itself skips what cannot match. Search values too many to
    broadcast meet a broadcast table if that is small; else they screen the rows by a filter of bounded size first,
    so that the join shuffles hardly any row without a match.
    """
    rows = df
    if literals is not None:
        condition = F.lit(False)
        for column, values in literals.items():
            condition = condition | equals_text(df.schema, column, values)
        rows = rows.where(condition)
    if len(probe_columns) == 1:
        only = probe_columns[0]
        rows = rows.where(F.col(quoted(only)).isNotNull()).select(
            "*", F.lit(only).alias("__column"), as_text(only).alias("__value")
        )
    else:
        rows = rows.select("*", F.inline(key_pairs(probe_columns)).alias("__column", "__value"))
    values = probes.selectExpr(
        "column AS __column", "value AS __value", "subject AS __subject"
    )
    on = ["__column", "__value"]
    names = [quoted(c) for c in (*df.columns, "__subject", *on)]
    if size.fits(limits):
        matched = lookup_join(rows, values, on, "inner", limits, size)
        if size.rows > limits.literal_pairs:
            # a few splits or one shared value can hold most matches: even them out, and write
            # well-sized files; only matched rows are shuffled
            matched = matched.hint("rebalance")
        return matched.select(*names)
    if df.count() <= limits.broadcast_rows and measure(rows).fits(limits):
        return values.join(F.broadcast(rows), on).select(*names)
    rows = screen(probes, size.rows, limits).passed(rows, *on)
    if len(probe_columns) == 1:
        # the column's name would be carried through the shuffle with every row, and its text beside the value itself
        column = F.lit(probe_columns[0])
        values = values.where(F.col("__column") == column).drop("__column")
        typed = _typed(values, df.schema, probe_columns[0])
        if typed is None:
            matched = lookup_join(rows.drop("__column"), values, ["__value"], "inner", limits, size)
        else:
            matched = lookup_join(rows.drop(*on), typed, [probe_columns[0]], "inner", limits, size)
            matched = matched.withColumn("__value", as_text(probe_columns[0]))
        return matched.withColumn("__column", column).select(*names)
    return lookup_join(rows, values, on, "inner", limits, size).select(*names)


def _typed(values: DataFrame, schema: T.StructType, column: str) -> DataFrame | None:
    """Search values in the type of their column, under its name; ``None`` unless equal values are the same as equal text.

    That holds for text and whole numbers. A value that is not the exact text of such a number matches nothing and is left out.
    """
    dtype = schema[column].dataType
    if dtype == T.StringType():
        typed = values
    elif isinstance(dtype, T.IntegralType):
        number = F.col("__value").try_cast(dtype)
        typed = values.where(number.cast("string") == F.col("__value")).withColumn("__value", number)
    else:
        return None
    return typed.select(F.col("__value").alias(column), "__subject")


def as_hits(
    found: DataFrame,
    name: str,
    source: str,
    schema: T.StructType,
    key_columns: Sequence[str],
    partition_columns: Sequence[str] = (),
    order_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Matches of a table of this schema as hits: JSON text, row id and keys follow from the row."""
    columns = schema.fieldNames()
    keys = [c for c in key_columns if c in columns]
    order = sort_key(schema, order_columns) if order_columns else F.lit(None).cast(SORT_KEY)
    hits = found.select(
        F.col("__subject").alias("subject"),
        F.lit(source).alias("source"),
        F.lit(name).alias("table_name"),
        F.col("__column").alias("matched_column"),
        F.col("__value").alias("matched_value"),
        partition_text(partition_columns).alias("partition"),
        row_json(columns).alias("row_json"),
        key_pairs(keys).alias("keys"),
        order.alias("order_key"),
    )
    return hits.select("*", id_of_json(F.col("row_json")).alias("row_id"))


def storable(schema: T.StructType) -> bool:
    """Whether files can keep rows of this schema as they are."""

    def plain(dtype: T.DataType) -> bool:
        if isinstance(dtype, T.StructType):
            return bool(dtype.fields) and all(plain(f.dataType) for f in dtype.fields)
        if isinstance(dtype, T.ArrayType):
            return plain(dtype.elementType)
        if isinstance(dtype, T.MapType):
            return plain(dtype.keyType) and plain(dtype.valueType)
        return isinstance(dtype, _STORED)

    return plain(schema)


def harvest(hits: DataFrame, mode: str = "all", only: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Keys of the hit rows, other than the one that matched: ``(subject, column, value)``.

    ``only`` (table -> columns) leaves out all other keys. ``all`` takes every row's keys. ``first`` takes, per subject, table and matched pair, the
    keys of the first row by the table's stated order (by row id where none is stated). All hits of a table name the same
    keys, so those of a pair whose column is the only one are left out before rows are sorted.
    """
    if mode == "first":
        group = ["subject", "source", "table_name", "matched_column", "matched_value"]
        leads = hits.where(F.exists("keys", lambda key: key["column"] != F.col("matched_column")))
        rows = leads.groupBy(*group).agg(
            F.min_by("keys", F.struct("order_key", "row_id")).alias("keys")
        )
    elif mode == "all":
        rows = hits
    else:
        raise ValueError("mode is 'all' or 'first'")
    wanted = F.lit(only is None)
    for table, columns in (only or {}).items():
        wanted = wanted | ((F.col("table_name") == table) & F.col("key.column").isin(list(columns)))
    return (
        rows.select("subject", "table_name", "matched_column", F.explode("keys").alias("key"))
        .where("key.column <> matched_column AND key.value IS NOT NULL")
        .where(wanted)
        .select("subject", F.col("key.column").alias("column"), F.col("key.value").alias("value"))
        .distinct()
    )


def first_pairs(rows: DataFrame, subject: str, pair: Sequence[str]) -> DataFrame:
    """For subjects that several pairs lead to rows of a table, the lowest one, by column name and then value.

    ``(subject, __first_column, __first_value)``. Each pair counts once, before subjects are put together.
    """
    first = F.min(F.struct(F.col(pair[0]).alias("column"), F.col(pair[1]).alias("value"))).alias("first")
    several = rows.select(subject, *pair).distinct().groupBy(subject).agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    return several.select(subject, F.col("first.column").alias("__first_column"), F.col("first.value").alias("__first_value"))


def hit_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("subject", "source", "table_name").agg(F.count(F.lit(1)).alias("n_hits"))


def pair_fanout(hits: DataFrame) -> DataFrame:
    """Rows reached by each pair: shows which keys link far too much."""
    return hits.groupBy("table_name", "matched_column", "matched_value").agg(
        F.count(F.lit(1)).alias("n_hits")
    )
