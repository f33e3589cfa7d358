"""Row identity and text form of values, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nulls stay visible and microseconds are kept; the defaults of to_json drop both. A fixed time
# zone keeps row ids the same in every session.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"

ID_TEXT = r"\A[0-9a-f]{64}\z"
MADE_ID = "__made_id"

_INTEGRAL_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def quoted(column: str) -> str:
    """A column name that may hold dots or spaces, for use where Spark parses names."""
    return "`" + column.replace("`", "``") + "`"


def row_json(columns: Sequence[str]) -> Column:
    """The whole row as one JSON text."""
    return F.to_json(F.struct(*[F.col(quoted(c)) for c in columns]), JSON_OPTIONS)


def row_id(columns: Sequence[str]) -> Column:
    """SHA-256 of the row's JSON text. Identical copies of a row share an id."""
    return id_of_json(row_json(columns))


def id_of_json(text: Column) -> Column:
    return F.sha2(text, 256)


def without_made_ids(df: DataFrame) -> DataFrame:
    """``row_id`` is left out where it is that of ``row_json``, and ``MADE_ID`` says so: the id is 64 characters that no compression shortens."""
    made = F.col("row_id").eqNullSafe(id_of_json(F.col("row_json")))
    return df.withColumn(MADE_ID, made).withColumn("row_id", F.when(~F.col(MADE_ID), F.col("row_id")))


def with_made_ids(df: DataFrame) -> DataFrame:
    """The rows that ``without_made_ids`` was given; rows that never were stay as they are."""
    if MADE_ID not in df.columns:
        return df
    made = F.when(F.coalesce(MADE_ID, F.lit(False)), id_of_json(F.col("row_json"))).otherwise(F.col("row_id"))
    return df.withColumn("row_id", made).drop(MADE_ID)


def id_as_bytes(id_text: Column) -> tuple[Column, Column]:
    """An id as the bytes that its text stands for, and any other text as it is; one of the two is null."""
    is_id = F.coalesce(id_text.rlike(ID_TEXT), F.lit(False))
    return F.when(is_id, F.unhex(id_text)), F.when(~is_id, id_text)


def bytes_as_id(number: Column, other: Column) -> Column:
    return F.coalesce(F.lower(F.hex(number)), other)


def as_text(column: str) -> Column:
    """A value the way the search compares it."""
    return F.col(quoted(column)).cast("string")


def _canonical_integer(text: str, bits: int) -> int | None:
    digits = text[1:] if text.startswith("-") else text
    if not (digits.isascii() and digits.isdigit()) or str(int(text)) != text:
        return None
    number = int(text)
    return number if -(1 << (bits - 1)) <= number < (1 << (bits - 1)) else None


def equals_text(schema: T.StructType, column: str, values: Iterable[str]) -> Column:
    """``column``, taken as text, is one of ``values``.

    For text and whole numbers the comparison is done in the column's own type, which a
    file scan can use to skip row groups; a value that is not the exact text of such a
    number (``05`` for 5) cannot match and is left out. Values become literals and never text that
    Spark parses, where ``${...}`` would be replaced.
    """
    dtype = schema[column].dataType
    col = F.col(quoted(column))
    if isinstance(dtype, T.StringType):
        return col.isin(list(values))
    bits = _INTEGRAL_BITS.get(type(dtype))
    if bits is None:
        return col.cast("string").isin(list(values))
    numbers = [n for n in (_canonical_integer(v, bits) for v in values) if n is not None]
    if not numbers:
        return F.lit(False)
    return col.isin([F.lit(n).cast(dtype) for n in numbers])


def partition_text(partition_columns: Sequence[str]) -> Column:
    """Partition of a row as ``value/value/...``; null for a table without partitions."""
    if not partition_columns:
        return F.lit(None).cast("string")
    return F.concat_ws(
        "/", *[F.coalesce(as_text(c), F.lit(DEFAULT_PARTITION)) for c in partition_columns]
    )


def sort_key(schema: T.StructType, columns: Sequence[str]) -> Column:
    """Values of mixed types in one orderable shape that is the same for every table."""

    def part(column: str) -> Column:
        dtype = schema[column].dataType
        col = F.col(quoted(column))
        whole, number, text = (F.lit(None).cast(t) for t in ("bigint", "double", "string"))
        if type(dtype) in _INTEGRAL_BITS:
            whole = col.cast("bigint")
        elif isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
            number = col.cast("double")
        else:
            text = col.cast("string")
        return F.struct(whole.alias("whole"), number.alias("number"), text.alias("text"))

    return F.array(*[part(c) for c in columns])


def has_map(dtype: T.DataType) -> bool:
    """Map values have no equality or hash in Spark, also inside structs and arrays."""
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(has_map(f.dataType) for f in dtype.fields)
    return False


def same_text_place(schema: T.StructType, *more: Column) -> Column:
    """A 64-bit hash that rows of the same JSON text share, made without the text; others share it by chance only.

    Broken characters look alike in the text, so they do here. Nested values go through their own text.
    """

    def part(field: T.StructField) -> Column:
        col = F.col(quoted(field.name))
        if isinstance(field.dataType, T.StringType):
            return F.make_valid_utf8(col)
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return row_json([field.name])
        return col

    return F.xxhash64(*more, *[part(f) for f in schema.fields])


def row_hash(schema: T.StructType, *more: Column) -> Column:
    """64-bit hash of the row for checksums (rows with maps go through their JSON text); another one with ``more``."""
    if has_map(schema):
        return F.xxhash64(*more, row_json(schema.fieldNames()))
    return F.xxhash64(*more, *[quoted(c) for c in schema.fieldNames()])
