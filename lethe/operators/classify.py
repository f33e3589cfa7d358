"""Find tables and columns with personal data by fragments of their names.

All functions take column metadata rows (see ``lethe.sources.catalog``) and return
DataFrames. Lake tables count as personal when both their database's and their own name have
the phrase, warehouse tables when either has it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.functions.text import qualify
from lethe.settings import LAKE, WAREHOUSE, Settings

TABLE = ("source", "db", "table")


def _qualified() -> Column:
    return qualify(F.col("db"), F.col("table"))


def is_personal_table(settings: Settings) -> Column:
    """The rule of the row's source: AND for the lake, OR for the warehouse."""
    phrase = settings.search_phrase
    both = F.col("db").contains(phrase) & F.col("table").contains(phrase)
    return F.when(F.col("source") == WAREHOUSE, _qualified().contains(phrase)).otherwise(both)


def is_link_column(settings: Settings) -> Column:
    return F.col("column").contains(settings.link_phrase)


def is_candidate_key(settings: Settings) -> Column:
    found = F.lit(False)
    for fragment in settings.key_fragments:
        found = found | F.col("column").contains(fragment)
    return found


def is_searched_link(settings: Settings) -> Column:
    """Address columns count everywhere in the warehouse, in the lake in personal tables."""
    searched = (F.col("source") == WAREHOUSE) | is_personal_table(settings)
    return is_link_column(settings) & searched


def is_personal_column(settings: Settings) -> Column:
    """Not a link or partition column, in a personal table (by bare name in the warehouse)."""
    in_table = F.when(
        F.col("source") == WAREHOUSE, F.col("table").contains(settings.search_phrase)
    ).otherwise(is_personal_table(settings))
    return in_table & ~is_link_column(settings) & ~F.col("is_partition")


def lake(columns: DataFrame) -> DataFrame:
    return columns.where(F.col("source") == LAKE)


def warehouse(columns: DataFrame) -> DataFrame:
    return columns.where(F.col("source") == WAREHOUSE)


def databases(columns: DataFrame, settings: Settings) -> DataFrame:
    """``(source, db, is_personal)``: all databases or schemas, marked by the phrase."""
    return (
        columns.select("source", "db")
        .distinct()
        .withColumn("is_personal", F.col("db").contains(settings.search_phrase))
    )


def personal_tables(columns: DataFrame, settings: Settings) -> DataFrame:
    """``(source, db, table, qualified)`` of tables with personal data."""
    return (
        columns.where(is_personal_table(settings))
        .select(*TABLE, _qualified().alias("qualified"))
        .distinct()
    )


def personal_table_names(columns: DataFrame, settings: Settings) -> DataFrame:
    """Bare names with the phrase, whatever their database: ``(table)``."""
    return columns.where(F.col("table").contains(settings.search_phrase)).select("table").distinct()


def link_columns(columns: DataFrame, settings: Settings) -> DataFrame:
    """``(source, column)``: address columns, in the lake of personal tables only."""
    return columns.where(is_searched_link(settings)).select("source", "column").distinct()


def tables_with_link(columns: DataFrame, settings: Settings) -> DataFrame:
    """``(source, db, table, qualified)`` of all tables that have an address column."""
    return (
        columns.where(is_link_column(settings))
        .select(*TABLE, _qualified().alias("qualified"))
        .distinct()
    )


def personal_tables_by_link(columns: DataFrame, settings: Settings) -> DataFrame:
    """Personal tables with ``has_link``: one aggregation, one row per table."""
    return (
        columns.where(is_personal_table(settings))
        .groupBy(*TABLE)
        .agg(F.bool_or(is_link_column(settings)).alias("has_link"))
        .withColumn("qualified", _qualified())
    )


def personal_tables_with_link(columns: DataFrame, settings: Settings) -> DataFrame:
    return (
        personal_tables_by_link(columns, settings).where("has_link").select(*TABLE, "qualified")
    )


def personal_tables_without_link(columns: DataFrame, settings: Settings) -> DataFrame:
    return (
        personal_tables_by_link(columns, settings).where("not has_link").select(*TABLE, "qualified")
    )


def tables_to_search(columns: DataFrame, settings: Settings) -> DataFrame:
    """Link tables together with the personal tables that have no link: each table once."""
    return personal_tables(columns, settings)


def personal_columns(columns: DataFrame, settings: Settings) -> DataFrame:
    """``(source, column)``: columns of personal tables except links and partition columns."""
    return columns.where(is_personal_column(settings)).select("source", "column").distinct()


def candidate_keys(columns: DataFrame, settings: Settings) -> DataFrame:
    """``(source, column)``: personal columns whose name has one of the key fragments."""
    return personal_columns(columns, settings).where(is_candidate_key(settings))


def mask_columns(
    columns: DataFrame, settings: Settings, mask_link_columns: bool = True
) -> DataFrame:
    """``(source, column)`` to mask by default: personal columns and address columns."""
    found = personal_columns(columns, settings)
    if mask_link_columns:
        found = found.unionByName(link_columns(columns, settings)).distinct()
    return found


def search_names(columns: DataFrame, settings: Settings) -> DataFrame:
    """``(kind, name)``: tables to search, link columns and key columns, in one pass."""
    kinds = {
        "table": (is_personal_table(settings), _qualified()),
        "link": (is_searched_link(settings), F.col("column")),
        "key": (is_personal_column(settings) & is_candidate_key(settings), F.col("column")),
    }
    found = F.array(
        *[
            F.when(condition, F.struct(F.lit(kind).alias("kind"), name.alias("name")))
            for kind, (condition, name) in kinds.items()
        ]
    )
    return columns.select(F.inline(F.array_compact(found))).distinct()


def columns_in_table(columns: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(source, db, table, column)``: each table's columns that are in a list of columns."""
    return columns.join(wanted, ["source", "column"], "left_semi").select(*TABLE, "column")


def common_items(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


@dataclass(frozen=True)
class Classification:
    """The lists a search and an erasure need, as DataFrames over one metadata DataFrame."""

    columns: DataFrame
    settings: Settings

    @property
    def tables(self) -> DataFrame:
        return tables_to_search(self.columns, self.settings)

    @property
    def link_columns(self) -> DataFrame:
        return link_columns(self.columns, self.settings)

    @property
    def personal_columns(self) -> DataFrame:
        return personal_columns(self.columns, self.settings)

    @property
    def candidate_keys(self) -> DataFrame:
        return candidate_keys(self.columns, self.settings)

    @property
    def mask_columns(self) -> DataFrame:
        return mask_columns(self.columns, self.settings)

    def write(self, path: str) -> None:
        """One folder per list, for people to edit."""
        for name in ("tables", "link_columns", "personal_columns", "candidate_keys", "mask_columns"):
            getattr(self, name).write.mode("errorifexists").json(f"{path}/{name}")


LISTS = {
    "tables": TABLE,
    "link_columns": ("source", "column"),
    "personal_columns": ("source", "column"),
    "candidate_keys": ("source", "column"),
    "mask_columns": ("source", "column"),
}


@dataclass(frozen=True)
class EditedLists:
    """The lists as people left them; ``search(..., lists=...)`` follows these and no name rules."""

    tables: DataFrame
    link_columns: DataFrame
    personal_columns: DataFrame
    candidate_keys: DataFrame
    mask_columns: DataFrame

    def search_names(self, source: str) -> DataFrame:
        """``(kind, name)`` as from ``search_names``."""
        parts = [
            self.tables.select("source", F.lit("table").alias("kind"), F.col("qualified").alias("name")),
            self.link_columns.select("source", F.lit("link").alias("kind"), F.col("column").alias("name")),
            self.candidate_keys.select("source", F.lit("key").alias("kind"), F.col("column").alias("name")),
        ]
        found = parts[0].unionByName(parts[1]).unionByName(parts[2])
        return found.where(F.col("source") == source).select("kind", "name").distinct()


def _listed(entries: DataFrame, known: DataFrame, keys: tuple[str, ...], name: str) -> DataFrame:
    """Each entry once; one that no metadata row has is an error when the list is computed."""
    both = entries.select(*keys, F.lit(True).alias("__listed")).unionByName(
        known.select(*keys, F.lit(False).alias("__listed"))
    )
    entry = F.concat_ws(".", *[F.coalesce(F.col(k), F.lit("null")) for k in keys])
    unknown = F.raise_error(F.concat(F.lit(f"{name}: not in the metadata: "), entry))
    return (
        both.groupBy(*keys)
        .agg(F.max("__listed").alias("__listed"), F.min("__listed").alias("__unknown"))
        .where("__listed")
        .select(F.when(F.col("__unknown"), unknown).otherwise(F.col(keys[0])).alias(keys[0]), *keys[1:])
    )


def read_classification(spark: SparkSession, path: str, columns: DataFrame) -> EditedLists:
    """The lists of ``Classification.write`` after people have edited them.

    ``columns`` is the metadata they were made from. Entries may be removed, repeated and added, but every one must
    name a table or column of the metadata, and partition columns cannot be masked. Lines that are no JSON, missing
    values and missing lists are errors.
    """
    lists = {}
    for name, keys in LISTS.items():
        schema = ", ".join(f"`{k}` string" for k in keys)
        entries = spark.read.schema(schema).option("mode", "FAILFAST").json(f"{path}/{name}")
        known = columns.where(~F.col("is_partition")) if name == "mask_columns" else columns
        lists[name] = _listed(entries, known, keys, name)
    lists["tables"] = lists["tables"].withColumn("qualified", _qualified())
    return EditedLists(**lists)


def classify(columns: DataFrame, settings: Settings = Settings()) -> Classification:
    return Classification(columns, settings)
