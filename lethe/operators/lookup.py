"""Joins of a large table to a lookup table, with the lookup's size checked first."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.functions.identity import quoted
from lethe.settings import Limits

_SIDE = "__lookup_"
_SALT = "__salt"
_HOT = "__hot"
_ROW_OVERHEAD = 64  # bytes a broadcast row costs beside its values
_GROUPS = 1 << 16  # of keys, counted before the keys themselves


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, limits: Limits) -> bool:
        return self.rows <= limits.broadcast_rows and self.bytes <= limits.broadcast_bytes


def value_bytes(columns: Sequence[str]) -> Column:
    """Text bytes of a row's values."""
    size = F.lit(_ROW_OVERHEAD)
    for c in columns:
        size = size + F.coalesce(F.octet_length(F.col(quoted(c)).cast("string")), F.lit(0))
    return size


def measure(df: DataFrame) -> Size:
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(value_bytes(df.columns)), F.lit(0)).alias("bytes"),
    ).first()
    return Size(row["rows"], row["bytes"])


def _matches(
    left: Sequence[str], right: Sequence[str], left_df: DataFrame, right_df: DataFrame, null_safe
) -> Column:
    condition = None
    for a, b in zip(left, right):
        x, y = left_df[quoted(a)], right_df[quoted(b)]
        part = x.eqNullSafe(y) if null_safe else x == y
        condition = part if condition is None else condition & part
    return condition


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    limits: Limits,
    size: Size | None = None,
    null_safe: bool = False,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``big`` with ``lookup`` on equal columns.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. The result has the columns
    of ``big`` (those of ``on`` may come first) and, for ``inner`` and ``left``, the lookup's
    further columns. A lookup measured
    to be small is broadcast and ``big`` is not shuffled. A larger one is joined by shuffle;
    there, rows of ``big`` with one of the few very frequent keys are spread over several
    tasks and the lookup rows of these keys are repeated for each. They are spread by their
    place in the input, which suits rows scanned from files: a repeated task sees them in the same
    order. Where ``big`` comes out of a shuffle, ``spread_by`` names columns to spread them by.
    """
    small = (size or measure(lookup)).fits(limits)
    if small and not null_safe:
        return big.join(F.broadcast(lookup), list(on), how)
    renamed = lookup.select([F.col(quoted(c)).alias(_SIDE + c) for c in lookup.columns])
    keys = [_SIDE + c for c in on]
    if small:
        condition = _matches(on, keys, big, renamed, null_safe)
        joined = big.join(F.broadcast(renamed), condition, how)
    else:
        joined = _salted_join(big, renamed, list(on), keys, how, limits, null_safe, spread_by)
    if how in ("left_semi", "left_anti"):
        return joined.drop(_SALT)
    further = {_SIDE + c: c for c in lookup.columns if c not in on}
    return joined.drop(_SALT, _SIDE + _SALT, *keys).withColumnsRenamed(further)


def hot_keys(df: DataFrame, on: Sequence[str], limits: Limits) -> DataFrame | None:
    """Key values that hold more than ``1 / max_hot_keys`` of the rows; ``None`` if there are none.

    By this definition there are fewer than ``max_hot_keys`` of them. A frequent key makes its group of keys as
    frequent, so keys are counted in a fixed number of groups first, and one by one only in those. Rows are counted
    before the shuffle, so neither the frequent keys nor the number of different keys cost anything.
    """
    group = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in on]), F.lit(_GROUPS))
    counts = {r[0]: r[1] for r in df.groupBy(group.alias(_HOT)).count().collect()}
    floor = sum(counts.values()) // max(limits.max_hot_keys, 1)
    heavy = [g for g, n in counts.items() if n > floor]
    if not heavy:
        return None
    return (
        df.where(group.isin(heavy))
        .groupBy(*[F.col(quoted(c)) for c in on])
        .agg(F.count(F.lit(1)).alias(_HOT))
        .where(F.col(_HOT) > floor)
        .select(*[F.col(quoted(c)) for c in on])
    )


def _salted_join(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    keys: list[str],
    how: str,
    limits: Limits,
    null_safe: bool,
    spread_by: Sequence[str] | None,
) -> DataFrame:
    frequent = hot_keys(big, on, limits)
    if frequent is None:
        return big.join(lookup, _matches(on, keys, big, lookup, null_safe), how)
    hot = frequent.select(*[F.col(quoted(c)).alias("__h_" + c) for c in on], F.lit(True).alias(_HOT))
    hot_on = ["__h_" + c for c in on]

    def tagged(df: DataFrame, columns: list[str]) -> DataFrame:
        # fewer than max_hot_keys rows, whatever the data: safe to broadcast
        condition = _matches(columns, hot_on, df, hot, null_safe)
        return df.join(F.broadcast(hot), condition, "left").drop(*hot_on)

    place = F.xxhash64(*map(quoted, spread_by)) if spread_by else F.monotonically_increasing_id()
    spread = F.when(F.col(_HOT), F.pmod(place, F.lit(limits.salts)))
    big_salted = tagged(big, on).withColumn(
        _SALT, F.coalesce(spread, F.lit(0)).cast("int")
    ).drop(_HOT)
    repeats = F.when(F.col(_HOT), F.sequence(F.lit(0), F.lit(limits.salts - 1)))
    lookup_salted = (
        tagged(lookup, keys)
        .withColumn(_SIDE + _SALT, F.explode(F.coalesce(repeats, F.array(F.lit(0)))))
        .drop(_HOT)
    )
    condition = _matches(on + [_SALT], keys + [_SIDE + _SALT], big_salted, lookup_salted, null_safe)
    return big_salted.join(lookup_salted, condition, how)
