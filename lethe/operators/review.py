"""The report of what was found, and the reviewer's decisions on it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lethe.functions.identity import (
    JSON_OPTIONS,
    bytes_as_id,
    id_as_bytes,
    quoted,
    row_json,
    with_made_ids,
    without_made_ids,
)
from lethe.functions.text import date_partition
from lethe.operators.screen import most_slots, screen_of
from lethe.scratch import new_folder, write_table
from lethe.settings import (
    FLAG_COLUMN,
    FLAG_ERASE,
    FLAG_KEEP,
    NO_DATA,
    NO_TIME,
    REPORT_FIRST_COLUMNS,
    WAREHOUSE,
    Limits,
)

ROW = ("subject", "source", "table_name", "row_id")
REPORT_KEY = ("subject", *REPORT_FIRST_COLUMNS, "row_id")
REPORT_SCHEMA = (
    f"subject string, `{REPORT_FIRST_COLUMNS[0]}` string, `{REPORT_FIRST_COLUMNS[1]}` string, `{FLAG_COLUMN}` string, "
    "copies long, `partition` string, row_id string, row_json string"
)
_BUCKET = "subject_bucket"
_TIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


def annotate(df: DataFrame, source: str, table_name: str, flag: str = FLAG_ERASE) -> DataFrame:
    """A table's rows as the report shows them: source and table name first, flag last."""
    first = [F.lit(source).alias(REPORT_FIRST_COLUMNS[0]), F.lit(table_name).alias(REPORT_FIRST_COLUMNS[1])]
    return df.select(*first, "*", F.lit(flag).alias(FLAG_COLUMN))


def placeholders(df: DataFrame) -> DataFrame:
    """All values as text, with a word where a number, text or time is missing."""

    def shown(field: T.StructField) -> Column:
        col = F.col(quoted(field.name))
        text = F.to_json(col) if _is_nested(field.dataType) else col.cast("string")
        if isinstance(field.dataType, _TIME):
            return F.coalesce(text, F.lit(NO_TIME)).alias(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            text = F.when(~F.isnan(col), text)
        return F.coalesce(text, F.lit(NO_DATA)).alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def typed_rows(hits: DataFrame, schema: T.StructType) -> DataFrame:
    """``hits`` with a column ``row``: the found row in its table's own types."""
    formats = {k: v for k, v in JSON_OPTIONS.items() if k.endswith("Format")}
    return hits.withColumn("row", F.from_json("row_json", schema, formats))


def read_rows(hits: DataFrame, table_name: str, schema: T.StructType) -> DataFrame:
    """Hits of one table as typed rows again: ``subject, row_id`` and the table's columns."""
    own = typed_rows(hits.where(F.col("table_name") == table_name), schema)
    return own.select("subject", "row_id", "row.*")


def report(hits: DataFrame, parts: Sequence = ()) -> DataFrame:
    """Each found row once per subject, with the number of its identical copies.

    A row found by several pairs has the same id each time and its copies are counted per pair. Only rows
    that a subject has more than once are shuffled: hashes are counted first, and those that repeat screen the hits. With ``parts``, all
    parts of the search that made ``hits``, this is done with the rows as the search keeps them, once and at the call, so that text is
    made only of rows that are read.
    """
    row = [*ROW, "partition", "row_json"]
    if parts:
        kept = [(part.rows, part.place, part.hits) for part in parts]
    else:
        kept = [(hits, F.xxhash64("subject", "source", "table_name", "row_json"), lambda rows: rows)]
    # 40 bits are enough to tell nearly all rows apart, and others do no harm
    kept = [(rows, F.shiftrightunsigned(place, 24), made) for rows, place, made in kept]
    places = reduce(DataFrame.unionByName, [rows.select(place.alias("__same")) for rows, place, _ in kept])
    counted = places.groupBy("__same").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__same")
    if parts:  # found once, however often the report is read; mostly none or few
        counted = write_table(counted, new_folder(hits.sparkSession, "repeated"), (), "zstd")
    if parts and counted.isEmpty():
        marked = [(rows.withColumn("__again", F.lit(False)), made) for rows, _, made in kept]
    else:
        repeated = screen_of(counted.select(F.xxhash64("__same")), most_slots(Limits()))
        marked = [(repeated.marked(rows, F.xxhash64(place), "__again"), made) for rows, place, made in kept]

    def those(condition: str) -> DataFrame:
        found = [made(rows.where(condition)).select(*row, "matched_column", "matched_value") for rows, made in marked]
        return reduce(DataFrame.unionByName, found)

    again = those("__again").groupBy(*row, "matched_column", "matched_value").agg(F.count(F.lit(1)).alias("copies"))
    once = those("NOT __again").select(*row, F.lit(1).cast("bigint").alias("copies"))
    return (
        again.groupBy(*row)
        .agg(F.max("copies").alias("copies"))
        .unionByName(once)
        .select(
            "subject",
            F.col("source").alias(REPORT_FIRST_COLUMNS[0]),
            F.col("table_name").alias(REPORT_FIRST_COLUMNS[1]),
            F.lit(FLAG_ERASE).alias(FLAG_COLUMN),
            "copies",
            "partition",
            "row_id",
            "row_json",
        )
    )


def report_order(reported: DataFrame) -> list[Column]:
    """Warehouse before lake, then by table and row."""
    return [
        F.when(F.col("Source") == WAREHOUSE, 0).otherwise(1),
        F.col(quoted("Table Name")),
        F.col("row_id"),
    ]


def write_report(reported: DataFrame, path: str, buckets: int | None = None, placed: bool = False) -> None:
    """One folder per subject, rows in reading order, for the reviewer.

    For many people ``buckets`` gives that number of folders instead, chosen by hash: a person's rows lie together in
    one of them, each line names its subject, and the files are compressed (gzip). ``placed``: the rows come with each
    bucket's side by side, as read from a report of the same number of them, and need no shuffle.
    """
    if buckets is not None:
        named = reported.withColumn(_BUCKET, F.pmod(F.xxhash64("subject"), F.lit(buckets)))
        if not placed:  # ids are made again after the shuffle
            named = with_made_ids(without_made_ids(named).hint("rebalance", _BUCKET))
        (
            named.sortWithinPartitions(_BUCKET, "subject", *report_order(reported))
            .write.mode("errorifexists")
            .partitionBy(_BUCKET)
            .option("compression", "gzip")
            .json(path)
        )
        return
    (
        reported.hint("rebalance", "subject")
        .sortWithinPartitions("subject", *report_order(reported))
        .write.mode("errorifexists")
        .partitionBy("subject")
        .json(path)
    )


def apply_decisions(reported: DataFrame, decisions: DataFrame, default: str = FLAG_ERASE) -> DataFrame:
    """The report with the reviewer's flags; rows without a decision get the default.

    ``decisions`` is ``(subject, source, table_name, row_id, update_flag)``. A decision that is given twice counts once;
    different ones on the same row are an error when the result is computed, since one of them would be overruled.
    Rows without a decision are told apart by a filter of the decided rows and not shuffled, those of tables without any
    decision by the table's name. The decisions are computed once, when this is called, and kept in the shared folder.
    """
    keys = ["subject", F.col("source").alias("Source"), F.col("table_name").alias("Table Name"), "row_id"]
    flags = decisions.groupBy(*keys).agg(F.min(FLAG_COLUMN).alias("__first"), F.max(FLAG_COLUMN).alias("__last"))
    spark = decisions.sparkSession
    kept = write_table(flags, new_folder(spark, "decisions"), (), "zstd")
    # as many names as the catalog has tables; rows without a table have no decision
    name = F.col(quoted("Table Name"))
    names = [r[0] for r in kept.select(name).where(name.isNotNull()).distinct().collect()]
    differ = F.raise_error(F.concat(F.lit("conflicting decisions on row "), F.col("row_id")))
    conflict = F.col("__first") != F.col("__last")
    decided = kept.select(*map(quoted, REPORT_KEY), F.when(conflict, differ).otherwise(F.col("__first")).alias("__decided"))
    place = F.xxhash64(*map(quoted, REPORT_KEY))
    in_tables = F.coalesce(name.isin(names), F.lit(False))
    marked = screen_of(kept.select(place), most_slots(Limits())).marked(reported.where(in_tables), place, "__may")
    joined = marked.where("__may").join(decided, list(REPORT_KEY), "left")
    joined = joined.withColumn(FLAG_COLUMN, F.coalesce("__decided", F.lit(default)))
    columns = [quoted(c) for c in reported.columns]
    plain = marked.where("NOT __may").select(*columns).unionByName(reported.where(~in_tables))
    plain = plain.withColumn(FLAG_COLUMN, F.lit(default))
    # never a row; the flags are looked at, so that a conflict is an error even if no row has a decision
    none = decided.where(F.length(F.coalesce("__decided", F.lit(""))) < 0)
    checked = none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in reported.schema.fields])
    return joined.select(*columns).unionByName(plain.select(*columns)).unionByName(checked)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The report of ``write_report``, as it is in its files now. Lines that are no JSON are an error."""
    return spark.read.schema(REPORT_SCHEMA).option("mode", "FAILFAST").json(path).drop(_BUCKET)


def apply_edits(reported: DataFrame, edited: DataFrame) -> DataFrame:
    """The report with the flags of its edited copy.

    A row whose line was taken out is kept (``FLAG_KEEP``). Lines of rows that were never reported, flags other than
    the two and two different flags on one row are errors when the result is computed. All lines are compared by their
    keys and flags: by sums for each person and table first, and one by one where these differ. Rows whose flag stays as
    reported are told apart by a filter of the changed ones and not shuffled.
    """
    keys = [F.col(quoted(c)) for c in REPORT_KEY]
    group = keys[:-1]
    number, other = id_as_bytes(F.col("row_id"))
    lines = differing_lines(reported, edited).select(*group, number.alias("__id"), other.alias("__other"), "__flags")
    lines = lines.groupBy(*group, "__id", "__other").agg(F.bit_or("__flags").alias("__flags"))
    lines = lines.select(*group, bytes_as_id(F.col("__id"), F.col("__other")).alias("row_id"), "__flags")
    given, own = F.col("__flags").bitwiseAND(7), F.col("__flags").bitwiseAND(56)
    row = F.coalesce(F.col("row_id"), F.lit("null"))
    flag = F.when(given == 1, FLAG_ERASE).otherwise(FLAG_KEEP)
    checked = (
        F.when(own == 0, F.raise_error(F.concat(F.lit("row was not reported: "), row)))
        .when(F.bit_count(given) > 1, F.raise_error(F.concat(F.lit("conflicting decisions on row "), row)))
        .when(given == 4, F.raise_error(F.concat(F.lit("no valid flag on row "), row)))
        .otherwise(flag)
    )
    as_reported = F.when(own == 8, FLAG_ERASE).when(own == 16, FLAG_KEEP).otherwise("")

    changed = lines.withColumn("__decided", flag).where(F.col("__decided") != as_reported)
    # only rows whose flag changes are shuffled with their text
    place = F.xxhash64(*keys)
    marked = screen_of(changed.select(place), most_slots(Limits())).marked(reported, place, "__may")
    decided = changed.select(*[F.col(quoted(c)).alias(f"__key_{k}") for k, c in enumerate(REPORT_KEY)], "__decided")
    same = reduce(and_, [F.col(quoted(c)).eqNullSafe(F.col(f"__key_{k}")) for k, c in enumerate(REPORT_KEY)])
    joined = marked.where("__may").join(decided, same, "left")
    joined = joined.withColumn(FLAG_COLUMN, F.coalesce("__decided", FLAG_COLUMN))
    columns = [quoted(c) for c in reported.columns]
    # never a row, but every line is checked for it, in this one place; all columns hang on the check, so no later
    # condition on the result can spare it
    never = lines.withColumn("__decided", checked).where(F.length("__decided") < 0)
    never = never.select(*[F.col("__decided").try_cast(f.dataType).alias(f.name) for f in reported.schema.fields])
    return joined.select(*columns).unionByName(marked.where("NOT __may").select(*columns)).unionByName(never)


def differing_lines(reported: DataFrame, edited: DataFrame) -> DataFrame:
    """Keys and flags of both reports' lines, without those of a person and table whose lines all have one flag and have it still.

    These are told by sums over the hashes of their keys, which a task makes from the lines as they lie. A few others may be let through.
    """
    keys = [F.col(quoted(c)) for c in REPORT_KEY]
    group = keys[:-1]

    def flags(flag: Column, first: int) -> Column:
        """Which flag it is as one of three bits, so that a line's flags are one number."""
        return F.when(flag == FLAG_ERASE, first).when(flag == FLAG_KEEP, first * 2).otherwise(first * 4).alias("__flags")

    both = edited.select(*keys, flags(F.upper(F.trim(F.col(FLAG_COLUMN))), 1), F.lit(1).alias("__side")).unionByName(
        reported.select(*keys, flags(F.col(FLAG_COLUMN), 8), F.lit(-1).alias("__side"))
    )
    sums = [
        F.sum(F.col("__side") * half).alias(f"__sum_{k}{i}")
        for k in range(2)
        for i, half in enumerate(_halves(F.xxhash64(F.lit(k), *keys)))
    ]
    groups = both.groupBy(*group).agg(F.bit_or("__flags").alias("__flags"), F.sum("__side").alias("__lines"), *sums)
    even = [F.col(c) == 0 for c in groups.columns if c.startswith("__") and c != "__flags"]
    differing = groups.where(~(F.col("__flags").isin(1 | 8, 2 | 16) & reduce(and_, even)))
    place = F.xxhash64(*group)
    marked = screen_of(differing.select(place), most_slots(Limits())).marked(both, place, "__differs")
    return marked.where("__differs").select(*keys, "__flags")


def _halves(number: Column) -> tuple[Column, Column]:
    """A 64-bit number as two of 32 bits, whose sums do not overflow."""
    return number.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(number, 32)


def flagged_rows(reviewed: DataFrame, source: str, flag: str = FLAG_ERASE) -> DataFrame:
    """Rows of one source with the flag."""
    return reviewed.where((F.col(FLAG_COLUMN) == flag) & (F.col("Source") == source))


def erase_targets(flagged: DataFrame, deny: Iterable[str] = ()) -> DataFrame:
    """``(table_name)``: tables to change, without those that must not be touched."""
    names = flagged.select(F.col(quoted("Table Name")).alias("table_name")).distinct()
    denied = list(deny)
    return names.where(~F.col("table_name").isin(denied)) if denied else names


def partitions_touched(flagged: DataFrame, year: str, month: str, day: str) -> DataFrame:
    """``(partition)`` as ``yyyy/MM/dd``, each once."""
    return flagged.select(
        date_partition(F.col(year), F.col(month), F.col(day)).alias("partition")
    ).distinct()


def rows_as_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return df.select(row_json(df.columns).alias("row_json"))
