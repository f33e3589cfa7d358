"""A Bloom filter of search values, so that a table's other rows are dropped in its scan and never shuffled.

The filter is a table of ``slots`` rows with ``WORDS`` numbers of 64 bits each, broadcast whatever the number of
search values: its size follows from the limits alone. It lets every matching row through, and a few others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.functions.identity import quoted
from lethe.settings import Limits

WORDS, WORD_BITS = 8, 64
SLOT_BYTES = 2 * WORDS * 8  # as broadcast, with what a row costs
BITS_PER_VALUE = 16  # at most 2 rows of 100 too many, until the limits bound the filter
_SLOT, _PLACE = "__slot", "__place"


@dataclass(frozen=True)
class Screen:
    frame: DataFrame
    slots: int

    def passed(self, rows: DataFrame, column: str, value: str) -> DataFrame:
        """Rows whose pair may be among the search values; no shuffle."""
        found = rows.where(F.col(value).isNotNull()).withColumn(_PLACE, F.xxhash64(column, value))
        joined = self._joined(found, "inner")
        for passed in self._tests():
            joined = joined.where(passed)
        return joined.select(*map(quoted, rows.columns))

    def marked(self, rows: DataFrame, place: Column, name: str) -> DataFrame:
        """All rows, with a column that is false where a place is surely not among the filter's; no shuffle."""
        first, second = self._tests()
        joined = self._joined(rows.withColumn(_PLACE, place), "left")
        return joined.select(*map(quoted, rows.columns), F.coalesce(first & second, F.lit(False)).alias(name))

    def _joined(self, rows: DataFrame, how: str) -> DataFrame:
        # at most ``slots`` rows are broadcast
        return rows.join(F.broadcast(self.frame), _slot(F.col(_PLACE), self.slots) == self.frame[_SLOT], how)

    def _tests(self) -> list[Column]:
        words = F.array(*[F.col(_word(k)) for k in range(WORDS)])
        return [F.getbit(F.get(words, word), bit) == 1 for word, bit in _bits(F.col(_PLACE))]


def screen(values: DataFrame, n_values: int, limits: Limits) -> Screen:
    """The filter of ``(column, value)`` pairs, at most ``n_values`` of them."""
    return screen_of(values.select(F.xxhash64("column", "value")), slots_for(n_values, limits))


def screen_of(hashes: DataFrame, slots: int) -> Screen:
    """The filter of a table with one column, 64-bit hashes."""
    places = hashes.toDF(_PLACE).select(_slot(F.col(_PLACE), slots).alias(_SLOT), _PLACE)
    (word_a, bit_a), (word_b, bit_b) = _bits(F.col(_PLACE))
    places = places.select(_SLOT, word_a.alias("wa"), bit_a.alias("ba"), word_b.alias("wb"), bit_b.alias("bb"))

    def mask(k: int) -> Column:
        return F.expr(f"bit_or(if(wa = {k}, shiftleft(1L, ba), 0L) | if(wb = {k}, shiftleft(1L, bb), 0L))")

    return Screen(places.groupBy(_SLOT).agg(*[mask(k).alias(_word(k)) for k in range(WORDS)]), slots)


def slots_for(n_values: int, limits: Limits) -> int:
    """A power of two: enough for the search values, and within what may be broadcast."""
    most = max(min(limits.broadcast_bytes // SLOT_BYTES, limits.broadcast_rows), 1)
    wanted = max(n_values * BITS_PER_VALUE // (WORDS * WORD_BITS), 1)
    return min(1 << (wanted - 1).bit_length(), 1 << (most.bit_length() - 1))


def most_slots(limits: Limits) -> int:
    """For a number of values that is not known; slots without a value cost nothing."""
    return slots_for(limits.broadcast_bytes, limits)


def _word(k: int) -> str:
    return f"__word_{k}"


def _slot(place: Column, slots: int) -> Column:
    # never null, and known to be: else a join on it would put a test of its own into one of several uses of the same rows
    return F.coalesce(F.pmod(place, F.lit(slots)), F.lit(0))


def _bits(place: Column) -> list[tuple[Column, Column]]:
    """Two bits of a slot, by the upper part of the hash: which word, and which bit of it."""
    upper = [F.shiftrightunsigned(place, 64 - 9 * (k + 1)) for k in range(2)]
    return [
        (F.pmod(F.shiftright(u, 6), F.lit(WORDS)).cast("int"), F.pmod(u, F.lit(WORD_BITS)).cast("int")) for u in upper
    ]
