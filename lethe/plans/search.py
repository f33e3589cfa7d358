"""Find all rows of a person: passes over the open tables until nothing new is found."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lethe.functions.identity import as_text, quoted, same_text_place
from lethe.operators import classify as C
from lethe.operators import linkage as L
from lethe.operators.lookup import Size, lookup_join, measure, value_bytes
from lethe.scratch import local_table, new_folder, remove, write_table
from lethe.settings import LAKE, Limits, Settings

HIT, NO_VALUE, NO_COLUMN, ERROR = "hit", "no_value", "no_column", "error"
NOT_SEARCHED = "not_searched"
CLOSED = ("subject", "table_name")
AT_ONCE = 8  # tables of a pass that are read side by side


class SearchFailed(RuntimeError):
    """A table could not be searched, and the caller wants all hits or none."""


@dataclass(frozen=True)
class Part:
    """Hits of one table and pass: the rows as they are kept, and how hits are made from them."""

    rows: DataFrame
    hits: Callable[[DataFrame], DataFrame]
    subject: str
    """The column of ``rows`` that names the subject."""
    place: Column
    """A hash of ``rows`` that those share whose hits have the same subject, table and text; made without the text where that is possible."""
    value: Column | None = None
    """The matched value as it follows from the other columns of ``rows``, if it does."""

    def shuffled(self, move: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``rows`` after a shuffle that does not carry what follows from the other columns."""
        if self.value is None:
            return move(self.rows)
        return move(self.rows.drop("__value")).withColumn("__value", self.value)


@dataclass
class SearchResult:
    """Hits as DataFrame over written files, and what is needed to account for every table."""

    spark: SparkSession
    source: str
    subjects: DataFrame
    tables: tuple[str, ...]
    folder: str
    hits: DataFrame
    probes: DataFrame
    passes: int
    errors: dict[str, str] = field(default_factory=dict)
    complete: bool = True
    """Whether the search ended by itself. If ``max_passes`` ended it, tables without a hit may hold rows."""
    parts: list[Part] = field(default_factory=list)
    """What ``hits`` is made of, for those that shuffle rows before their text is made."""

    def coverage(self) -> DataFrame:
        """One row per subject and table: hit, no_value, no_column, not_searched or error.

        ``not_searched``: nothing was found, but the search was ended before it had run out of keys.
        One shuffle: all three inputs are counted together.
        """
        none = F.lit(None).cast("int")
        wanted = self.subjects.select(
            "subject", F.explode(F.array(*[F.lit(t) for t in self.tables])).alias("table_name")
        ).select("*", F.lit(0).alias("probed"), F.lit(0).alias("hit"), none.alias("pass"))
        probed = self.probes.select(
            "subject", "table_name", F.lit(1).alias("probed"), F.lit(0).alias("hit"), none.alias("pass")
        )
        found = self.hits.select(
            "subject", "table_name", F.lit(1).alias("probed"), F.lit(1).alias("hit"), "pass"
        )
        failed = F.col("table_name").isin(list(self.errors)) if self.errors else F.lit(False)
        status = (
            F.when(failed, ERROR)
            .when(F.col("n_hits") > 0, HIT)
            .when(F.lit(not self.complete), NOT_SEARCHED)
            .when(F.col("was_probed") > 0, NO_VALUE)
            .otherwise(NO_COLUMN)
        )
        return (
            wanted.unionByName(probed)
            .unionByName(found)
            .groupBy("subject", "table_name")
            .agg(
                F.max("probed").alias("was_probed"),
                F.sum("hit").alias("n_hits"),
                F.min("pass").alias("found_pass"),
            )
            .select(
                "subject",
                F.lit(self.source).alias("source"),
                "table_name",
                status.alias("status"),
                "found_pass",
                "n_hits",
            )
        )

    def probed(self) -> DataFrame:
        """The part of the coverage that grows with what was searched and not with people times tables.

        Rows as in ``coverage`` for pairs that were probed. A table that could not be read, or with ``complete`` false any
        table, has one more row without a subject: it holds for all people without a row of their own. All other
        pairs are ``no_column``.
        """
        open_status = None if self.complete else NOT_SEARCHED
        whole = [(t, ERROR if t in self.errors else open_status) for t in self.tables]
        whole = [row for row in whole if row[1]]
        failed = F.col("table_name").isin(list(self.errors)) if self.errors else F.lit(False)
        probed = self.probes.select("subject", "table_name", F.lit(0).alias("hit"), F.lit(None).cast("int").alias("pass"))
        found = self.hits.select("subject", "table_name", F.lit(1).alias("hit"), "pass")
        status = (
            F.when(failed, ERROR)
            .when(F.col("n_hits") > 0, HIT)
            .when(F.lit(not self.complete), NOT_SEARCHED)
            .otherwise(NO_VALUE)
        )
        pairs = (
            probed.unionByName(found)
            .groupBy("subject", "table_name")
            .agg(F.sum("hit").alias("n_hits"), F.min("pass").alias("found_pass"))
        )
        columns = ("subject", "source", "table_name", "status", "found_pass", "n_hits")
        rows = pairs.select("*", status.alias("status"), F.lit(self.source).alias("source")).select(*columns)
        if not whole:
            return rows
        tables = local_table(self.spark, whole, "table_name, status").select(
            F.lit(None).cast("string").alias("subject"),
            F.lit(self.source).alias("source"),
            "table_name",
            "status",
            F.lit(None).cast("int").alias("found_pass"),
            F.lit(0).cast("bigint").alias("n_hits"),
        )
        return rows.unionByName(tables)

    def open_tables(self) -> DataFrame:
        """``(subject, table_name)`` where nothing was found."""
        return self.coverage().where(F.col("status") != HIT).select(*CLOSED)

    def discard(self) -> None:
        """Delete the files behind this result; they hold personal data."""
        remove(self.spark, self.folder)


def search(
    tables: Mapping[str, DataFrame],
    subjects: DataFrame,
    settings: Settings = Settings(),
    *,
    columns: DataFrame,
    source: str = LAKE,
    max_passes: int | None = None,
    harvest: str = "all",
    first_match: bool = False,
    close_tables: bool = True,
    partition_columns: Collection[str] = (),
    order_columns: Mapping[str, Sequence[str]] | None = None,
    lists: C.EditedLists | None = None,
    limits: Limits = Limits(),
    allow_errors: bool = True,
) -> SearchResult:
    """Search the personal tables among ``tables`` for all subjects at once.

    ``columns`` is the column metadata of the source. Pass 1 looks for the addresses in the
    address columns. Each next pass looks for the keys found in the pass before, in columns of
    the same name, and only in tables not yet found for that subject (``close_tables``; without
    it, until no new key turns up). ``first_match`` keeps, from pass 2 on, just the lowest pair
    that has rows in a table. The loop ends when no table is left to probe. ``lists`` are edited lists of tables,
    address columns and keys, which then replace the rules by name. A table that cannot be read is ``error`` in the
    coverage, which must then be looked at; with ``allow_errors`` false it ends the search with ``SearchFailed``,
    for those that use the hits alone.
    """
    spark = subjects.sparkSession
    order_columns = order_columns or {}
    own = columns.where(F.col("source") == source)
    names = _names(C.search_names(own, settings) if lists is None else lists.search_names(source))
    wanted, link = names["table"], names["link"]
    key_columns = sorted((set(names["key"]) | set(link)) - settings.exclude_keys)
    probe_columns = set(key_columns) | set(link)
    errors = {name: "table not available" for name in wanted if name not in tables}
    if errors and not allow_errors:
        raise SearchFailed(f"tables not available: {', '.join(sorted(errors))}")
    opened = {name: tables[name] for name in wanted if name in tables}
    schemas = {t: df.schema for t, df in opened.items()}
    by_table = {t: [c for c in df.columns if c in probe_columns] for t, df in opened.items()}
    table_columns = local_table(
        spark, [(t, c) for t, found in by_table.items() for c in found], "table_name, column"
    )

    folder = new_folder(spark, "search")
    subjects, subject_size = _fix_subjects(subjects, f"{folder}/subjects", limits)
    # a subject closes each table at most once, so this bounds that side of the join
    n_tables = max(len(opened), 1)
    longest = max(map(len, opened), default=0)
    closed_size = Size(
        subject_size.rows * n_tables, (subject_size.bytes + subject_size.rows * longest) * n_tables
    )

    all_hits: list[DataFrame] = []
    all_parts: list[Part] = []
    by_found: dict[str, list[DataFrame]] = {}
    all_probes: list[DataFrame] = []
    frontier = L.frontier_seed(subjects, link) if link else None
    # how many search values one hit can lead to: keys of a row, times the tables with that column
    spread = max((sum(c in f for f in by_table.values()) for c in probe_columns), default=0)
    fan = spread * max(map(len, by_table.values()), default=0)
    bound = subject_size.rows * len(link) * spread
    number, complete = 0, True
    while frontier is not None:
        routed = L.route(frontier, table_columns)
        if all_hits and close_tables:
            # other tables are searched from their own rows only, which closes them; one without any hit is closed for nobody
            routed = routed.where(F.col("table_name").isin(sorted(targets)))
            closed = [frame for t in sorted(targets & by_found.keys()) for frame in by_found[t]]
            if closed:
                routed = L.still_open(routed, _union(closed).select(*CLOSED).distinct(), closed_size, limits)
        elif all_hits:
            routed = routed.join(_union(all_probes), L.PROBE_SCHEMA.fieldNames(), "left_anti")
        probes = _fix_probes(routed, bound, f"{folder}/probes/pass={number + 1}", limits)
        open_now = [t for t in probes.sizes if t not in errors]
        if not open_now:
            break
        if max_passes is not None and number >= max_passes:
            complete = False  # there would have been something to look for
            break
        number += 1
        all_probes.append(probes.frame)

        def scan(t: str) -> DataFrame:
            values, size = probes.frame.where(F.col("table_name") == t), probes.sizes[t]
            searched = [c for c in by_table[t] if c in probes.columns[t]]
            return L.matches(opened[t], values, searched, size, limits, probes.literals.get(t))

        def as_hits(t: str, found: DataFrame) -> DataFrame:
            parts = [c for c in opened[t].columns if c in partition_columns]
            return L.as_hits(found, t, source, opened[t].schema, key_columns, parts, order_columns.get(t))

        found = _write_matches(
            spark, open_now, scan, as_hits, number, f"{folder}/hits/pass={number}", errors, limits, schemas, probes.columns, allow_errors
        )
        kept = {t: part for t, (part, n) in found.items() if n}
        if first_match and number > 1:
            first = f"{folder}/first/pass={number}"
            kept = {t: _first_matches(part, f"{first}/table={k}", limits) for k, (t, part) in enumerate(kept.items())}
        parts = {t: part.hits(part.rows) for t, part in kept.items()}
        all_parts += kept.values()
        all_hits += parts.values() or [spark.createDataFrame([], L.HIT_SCHEMA)]
        for t, hits in parts.items():
            by_found.setdefault(t, []).append(hits)
        # keys that no other table has lead nowhere: whoever has a hit in a table has it closed. A column that alone was
        # searched is every hit's matched one, whose value is not followed
        leads = {
            t: [
                c for c in by_table[t]
                if c in key_columns and probes.columns[t] != {c} and _reached(c, t, by_table, close_tables)
            ]
            for t in parts
        }
        leads = {t: columns for t, columns in leads.items() if columns}
        targets = {u for t, columns in leads.items() for c in columns for u in _reached(c, t, by_table, close_tables)}
        frontier = L.harvest(_union([parts[t] for t in leads]), harvest, leads) if leads else None
        bound = sum(found[t][1] for t in leads) * fan

    return SearchResult(
        spark,
        source,
        subjects,
        tuple(wanted),
        folder,
        _union(all_hits) if all_hits else spark.createDataFrame([], L.HIT_SCHEMA),
        _union(all_probes) if all_probes else spark.createDataFrame([], L.PROBE_SCHEMA),
        number,
        errors,
        complete,
        all_parts,
    )


def _first_matches(part: Part, path: str, limits: Limits) -> Part:
    """The hits of a table by each subject's lowest pair; those by other pairs are left out before any text is made.

    Only subjects with several pairs are looked up, so rows are not shuffled unless these are very many.
    """
    pair = ["__column", "__value"] if part.subject == "__subject" else ["matched_column", "matched_value"]
    first = write_table(L.first_pairs(part.rows, part.subject, pair), path)
    size = measure(first)
    if not size.rows:
        return part
    column, value = F.col("__first_column"), F.col("__first_value")
    rows = lookup_join(part.rows, first, [part.subject], "left", limits, size)
    rows = rows.where(column.isNull() | ((F.col(pair[0]) == column) & (F.col(pair[1]) == value)))
    return replace(part, rows=rows.select(*map(quoted, part.rows.columns)))


def _names(found: DataFrame) -> dict[str, list[str]]:
    """Names of tables, address columns and keys: bounded by the catalog."""
    names: dict[str, list[str]] = {"table": [], "link": [], "key": []}
    for row in found.collect():
        names[row["kind"]].append(row["name"])
    return {kind: sorted(listed) for kind, listed in names.items()}


def _fix_subjects(subjects: DataFrame, path: str, limits: Limits) -> tuple[DataFrame, Size]:
    """Each subject once: on the driver if they are few, else in the shared folder."""
    wanted = subjects.select("subject").where("subject IS NOT NULL").distinct()
    some = wanted.limit(limits.driver_rows + 1).collect()
    if len(some) <= limits.driver_rows:
        size = Size(len(some), sum(64 + 4 * len(r["subject"]) for r in some))
        return local_table(subjects.sparkSession, some, "subject"), size
    kept = write_table(wanted, path)
    return kept, measure(kept)


@dataclass(frozen=True)
class _Probes:
    """Search values of one pass, fixed so that every later use sees the same rows."""

    frame: DataFrame
    sizes: dict[str, Size]
    columns: dict[str, set[str]]
    literals: dict[str, dict[str, list[str]]]


def _fix_probes(routed: DataFrame, bound: int, path: str, limits: Limits) -> _Probes:
    """Keep a provably small set on the driver; write any other to the shared folder."""
    fields = L.PROBE_SCHEMA.fieldNames()
    if bound <= limits.driver_rows:
        rows = routed.select(*fields).collect()
        sizes: dict[str, Size] = {}
        columns: dict[str, set[str]] = {}
        for row in rows:
            columns.setdefault(row["table_name"], set()).add(row["column"])
            old = sizes.get(row["table_name"], Size(0, 0))
            # four bytes per character bound any text, plus what a row costs
            sizes[row["table_name"]] = Size(old.rows + 1, old.bytes + 64 + 4 * sum(map(len, row)))
        frame = local_table(routed.sparkSession, rows, ", ".join(fields))
    else:
        frame = write_table(routed.select(*fields), path, ("table_name",), "zstd")
        sizes, columns = _sizes_by_table(frame)
        few = [t for t, s in sizes.items() if s.rows <= limits.literal_pairs]
        rows = frame.where(F.col("table_name").isin(few)).collect() if few else []
    values: dict[str, dict[str, dict[str, None]]] = {}
    for row in rows:
        if sizes[row["table_name"]].rows <= limits.literal_pairs:
            by_column = values.setdefault(row["table_name"], {})
            by_column.setdefault(row["column"], {})[row["value"]] = None
    literals = {t: {c: list(v) for c, v in by_column.items()} for t, by_column in values.items()}
    return _Probes(frame, sizes, columns, literals)


def _reached(column: str, table: str, by_table: Mapping[str, Sequence[str]], close_tables: bool) -> list[str]:
    """Tables in which a key from a row of ``table`` can still be looked for."""
    return [t for t, columns in by_table.items() if column in columns and not (close_tables and t == table)]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _sizes_by_table(routed: DataFrame) -> tuple[dict[str, Size], dict[str, set[str]]]:
    """Size and columns of each table's search values; one small row per table and column reaches the driver."""
    rows = (
        routed.groupBy("table_name", "column")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(value_bytes(["subject", "column", "value"])).alias("bytes"),
        )
        .collect()
    )
    sizes: dict[str, Size] = {}
    columns: dict[str, set[str]] = {}
    for r in rows:
        old = sizes.get(r["table_name"], Size(0, 0))
        sizes[r["table_name"]] = Size(old.rows + r["rows"], old.bytes + r["bytes"])
        columns.setdefault(r["table_name"], set()).add(r["column"])
    return sizes, columns


def _write_matches(
    spark: SparkSession,
    names: Sequence[str],
    scan: Callable[[str], DataFrame],
    as_hits: Callable[[str, DataFrame], DataFrame],
    number: int,
    path: str,
    errors: dict[str, str],
    limits: Limits,
    schemas: Mapping[str, T.StructType],
    columns: Mapping[str, Collection[str]],
    allow_errors: bool = True,
) -> dict[str, tuple[Part, int]]:
    """The hits of a pass and their number, by table: one job for each, several side by side.

    Written are the matched rows in their own types; the matched value, JSON text, row id and keys are made from them where
    hits are read, and only those that are used. Rows that files cannot keep are written as hits. A table that fails twice is
    reported as ``error`` in the coverage, or ends the search: an unreadable table must not look like one without data. The
    number comes from the write itself; a repeated task can only make it too high.
    """

    def write(name: str, target: str) -> tuple[Part, int]:
        found = scan(name)  # planning may read the table, so it can fail like the scan itself
        kept = L.storable(found.schema)
        if not kept:
            found = as_hits(name, found)
        counted = Observation()
        names_kept = [quoted(c) for c in found.columns if not (kept and c == "__value")]
        counting = found.select(*names_kept).observe(counted, F.count(F.lit(1)).alias("rows"))
        stored = write_table(counting, target, (), "zstd")

        def hits(rows: DataFrame) -> DataFrame:
            made = as_hits(name, rows) if kept else rows
            return made.withColumn("pass", F.lit(number)).select(L.HIT_SCHEMA.fieldNames())

        value = matched_value(columns[name]) if kept else None
        if kept:
            stored = stored.withColumn("__value", value)
            place = same_text_place(schemas[name], F.col("__subject"), F.lit(name))
        else:
            place = F.xxhash64("subject", "table_name", "row_json")
        return Part(stored, hits, "__subject" if kept else "subject", place, value), counted.get["rows"]

    def attempt(place: int) -> tuple[Part, int] | Exception:
        try:
            return write(names[place], f"{path}/table={place}")
        except Exception:  # noqa: BLE001 - any failed scan must end up in the coverage
            try:
                return write(names[place], f"{path}/table={place}-again")
            except Exception as failure:  # noqa: BLE001
                return failure

    with ThreadPoolExecutor(max(min(limits.tables_per_job, AT_ONCE, len(names)), 1)) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(attempt), range(len(names))))
    for name, result in zip(names, done):
        if isinstance(result, Exception):
            if not allow_errors:
                raise SearchFailed(f"{name} could not be searched: {type(result).__name__}") from result
            errors[name] = type(result).__name__
    return {name: result for name, result in zip(names, done) if not isinstance(result, Exception)}


def matched_value(columns: Collection[str]) -> Column:
    """What a matched row holds, as text, in the searched column that it was found by."""
    return F.coalesce(*[F.when(F.col("__column") == c, as_text(c)) for c in sorted(columns)])


def search_two_pass(
    tables: Mapping[str, DataFrame],
    subjects: DataFrame,
    settings: Settings = Settings(),
    **options,
) -> SearchResult:
    """The warehouse form: addresses first, then once the keys found, first match per table."""
    return search(tables, subjects, settings, max_passes=2, first_match=True, **options)


def write_hits(hits: DataFrame, path: str) -> None:
    """Hits as files, apart by source and subject, so that a person's can be purged."""
    (
        hits.hint("rebalance", "source", "subject")
        .write.mode("errorifexists")
        .partitionBy("source", "subject")
        .parquet(path)
    )
