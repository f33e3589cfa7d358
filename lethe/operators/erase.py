"""Take flagged rows out of a table, or mask them in place, as DataFrame functions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lethe.functions.identity import ID_TEXT, quoted, row_hash, row_id
from lethe.operators.lookup import lookup_join, measure
from lethe.operators.masking import mask, match_columns
from lethe.operators.screen import most_slots, screen_of
from lethe.settings import Limits

ROW_ID = "row_id"
_ID = "__row_id"
_FLAG = "__flagged"
_MAY = "__may"
_GONE, _SLICE, _ROWS = "__gone", "__slice", "__rows"
_PIECE = 4096


def tag_flagged(
    df: DataFrame,
    flagged: DataFrame,
    limits: Limits = Limits(),
    columns: Sequence[str] | None = None,
    numbers: Sequence[str] = (),
    different: bool = False,
) -> DataFrame:
    """``df`` with a boolean column that tells the rows whose id is among ``flagged.row_id``.

    The ids are measured; the table itself is shuffled only when they are too many to broadcast. A row's id is that of
    all columns, or of ``columns``. With ``numbers``, whole-number columns that ``flagged.row_json`` holds too, a filter of
    bounded size tells the rows whose numbers are no flagged row's, and the text and id of these are not made. ``different``:
    no id comes twice, so that they need no shuffle to be told apart.
    """
    # ids are joined as bytes, which are half as long as their text; what is no id's text is no row's id
    asked = F.when(F.col(ROW_ID).rlike(ID_TEXT), F.unhex(ROW_ID))
    ids = flagged.select(asked.alias(_ID))
    ids = (ids if different else ids.distinct()).withColumn(_FLAG, F.lit(True))
    names = [quoted(c) for c in df.columns]
    own = F.unhex(row_id(columns or df.columns))
    if numbers:
        place = F.xxhash64(*[F.col(quoted(c)).cast("bigint") for c in numbers])
        marked = screen_of(numbers_of(flagged, numbers).select(place), most_slots(limits)).marked(df, place, _MAY)
        tagged = lookup_join(marked.withColumn(_ID, F.when(F.col(_MAY), own)), ids, [_ID], "left", limits)
    else:
        tagged = lookup_join(df.withColumn(_ID, own), ids, [_ID], "left", limits)
    return tagged.select(*names, F.col(_FLAG).isNotNull().alias(_FLAG))


def numbers_of(flagged: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """The whole numbers in these columns of the flagged rows, read back from their text."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in numbers])
    return flagged.select(F.from_json("row_json", schema).alias("__n")).select("__n.*")


def tag_equal(
    df: DataFrame, flagged: DataFrame, match: Sequence[str], limits: Limits = Limits()
) -> DataFrame:
    """The same for rows that equal a flagged row in the match columns; nulls are equal."""
    keys = flagged.select(*[quoted(c) for c in match]).distinct().withColumn(_FLAG, F.lit(True))
    tagged = lookup_join(df, keys, match, "left", limits, null_safe=True)
    names = [quoted(c) for c in df.columns]
    return tagged.select(*names, F.col(_FLAG).isNotNull().alias(_FLAG))


def untag(df: DataFrame) -> DataFrame:
    return df.drop(_FLAG)


def is_flagged():
    return F.col(_FLAG)


def remove_copies(df: DataFrame, flagged: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rows that equal no flagged row; nulls are equal. All identical copies go."""
    flagged = flagged.select(*[quoted(c) for c in df.columns]).distinct()
    return lookup_join(df, flagged, df.columns, "left_anti", limits, null_safe=True)


def remove_counted(df: DataFrame, flagged: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``df`` minus ``flagged`` as multisets: one copy goes per flagged row.

    Only rows that equal a flagged row are counted; all others pass through. Equal rows are counted in up to
    ``limits.salts`` slices (by task, so a repeated task counts the same), so a value with a large share of the rows is no single task's work; a slice keeps what the
    slices before it leave over of the flagged count, and its rows are written out again in pieces.
    """
    names = [quoted(c) for c in df.columns]
    flagged = flagged.select(*names)
    once = flagged.groupBy(*names).agg(F.count(F.lit(1)).alias(_GONE))
    values = once.drop(_GONE)
    size = measure(values)
    other = lookup_join(df, values, df.columns, "left_anti", limits, size, null_safe=True)
    equal = lookup_join(df, values, df.columns, "left_semi", limits, size, null_safe=True)
    slices = (
        equal.select(*names, F.pmod(F.spark_partition_id(), F.lit(max(limits.salts, 1))).alias(_SLICE))
        .groupBy(*names, _SLICE)
        .agg(F.count(F.lit(1)).alias(_ROWS))
    )
    # at most ``salts`` rows for each value from here on, until they are written out
    before = Window.partitionBy(*names).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    counted = lookup_join(slices, once, df.columns, "left", limits, null_safe=True)
    counted = counted.withColumn("__before", F.coalesce(F.sum(_ROWS).over(before), F.lit(0)))
    taken = F.least(F.greatest(F.col(_GONE) - F.col("__before"), F.lit(0)), F.col(_ROWS))
    pieces = counted.withColumn(_ROWS, F.col(_ROWS) - taken).where(F.col(_ROWS) > 0)
    pieces = pieces.withColumn(
        "__at", F.explode(F.expr(f"sequence(0L, ({_ROWS} - 1) div {_PIECE}, 1L)"))
    ).repartition(F.col(_SLICE), F.col("__at"), *[F.col(n) for n in names])
    copies = F.least(F.col(_ROWS) - F.col("__at") * _PIECE, F.lit(_PIECE)).cast("int")
    again = pieces.withColumn("__copy", F.explode(F.array_repeat(F.lit(True), copies)))
    return other.select(*names).unionByName(again.select(*names))


def remove_by_id(df: DataFrame, flagged: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rows whose id is not flagged; works for every column type. All identical copies go."""
    return untag(tag_flagged(df, flagged, limits).where(~is_flagged()))


def mask_by_id(
    df: DataFrame,
    flagged: DataFrame,
    columns: Iterable[str],
    mode: str = "column_token",
    salt: str = "",
    on_non_string: str = "null",
    limits: Limits = Limits(),
) -> DataFrame:
    """Flagged rows masked, all others unchanged, in one pass over the table."""
    tagged = tag_flagged(df, flagged, limits)
    return untag(mask(tagged, columns, mode, salt, on_non_string, where=is_flagged()))


def erase(
    df: DataFrame,
    flagged: DataFrame,
    action: str = "mask",
    match: str = "row_id",
    columns: Iterable[str] = (),
    mode: str = "column_token",
    salt: str = "",
    on_non_string: str = "null",
    limits: Limits = Limits(),
) -> DataFrame:
    """The table after an erasure.

    ``match="row_id"`` takes ``flagged`` as ids; ``copies`` and ``counted`` take whole rows.
    ``action="mask"`` keeps the rows with masked ``columns``, ``delete`` takes them out.
    """
    if action not in ("mask", "delete"):
        raise ValueError("action is 'mask' or 'delete'")
    if match == "row_id":
        if action == "delete":
            return remove_by_id(df, flagged, limits)
        return mask_by_id(df, flagged, columns, mode, salt, on_non_string, limits)
    if match not in ("copies", "counted"):
        raise ValueError("match is 'row_id', 'copies' or 'counted'")
    remove = remove_copies if match == "copies" else remove_counted
    kept = remove(df, flagged, limits).select(*[quoted(c) for c in df.columns])
    if action == "delete":
        return kept
    if match == "copies":
        flagged = lookup_join(
            df,
            flagged.select(*[quoted(c) for c in df.columns]).distinct(),
            df.columns,
            "left_semi",
            limits,
            null_safe=True,
        )
    masked = mask(flagged.select(*[quoted(c) for c in df.columns]), columns, mode, salt, on_non_string)
    return kept.unionByName(masked)


def update_by_row_match(
    df: DataFrame,
    flagged: DataFrame,
    columns: Iterable[str],
    match: Sequence[str] | None = None,
    mode: str = "column_token",
    salt: str = "",
    limits: Limits = Limits(),
) -> DataFrame:
    """Mask the rows that equal a flagged row in all match columns (by default all but times)."""
    match = list(match) if match is not None else match_columns(df.schema)
    return untag(mask(tag_equal(df, flagged, match, limits), columns, mode, salt, where=is_flagged()))


def swap_check(old: DataFrame, new: DataFrame, masked: DataFrame) -> DataFrame:
    """One row: are the rows that ``new`` has beyond ``old`` just the masked rows?

    As multisets, by one aggregation: copies are counted by two 64-bit hashes of the row, before the shuffle, so neither rows
    nor copies of a frequent row move. ``passed`` tells whether the swap may go on.
    """
    names = [quoted(c) for c in old.columns]

    def sided(df: DataFrame, name: str) -> DataFrame:
        mark = F.lit(1).cast("long")
        sides = {c: mark if c == name else F.lit(0).cast("long") for c in ("old", "new", "masked")}
        first, second = row_hash(df.schema), row_hash(df.schema, F.lit("second"))
        return df.select(first.alias("h1"), second.alias("h2"), *[v.alias(k) for k, v in sides.items()])

    rows = sided(old.select(*names), "old").unionByName(sided(new.select(*names), "new"))
    rows = rows.unionByName(sided(masked.select(*names), "masked"))
    sums = rows.groupBy("h1", "h2").agg(*[F.sum(c).alias(c) for c in ("old", "new", "masked")])
    added = F.greatest(F.col("new") - F.col("old"), F.lit(0))
    total = sums.agg(
        F.sum(added).alias("n_added"),
        F.sum("masked").alias("n_masked"),
        F.sum(F.least(added, F.col("masked"))).alias("n_common"),
    )
    counts = total.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_added", "n_masked", "n_common")])
    return counts.withColumn(
        "passed",
        (F.col("n_added") == F.col("n_common")) & (F.col("n_masked") == F.col("n_common")),
    )
