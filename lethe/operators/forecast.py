"""How many rows a pass would reach, bounded from above before it runs.

A count-min sketch of every key column: ``depth`` rows of ``width`` counters, kept as a table. Its size depends on
the number of key columns only, whatever the data hold, and a scan of the key columns alone fills it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.functions.identity import quoted
from lethe.operators.linkage import key_pairs

WIDTH, DEPTH = 1 << 14, 4
CELL = ("table_name", "column", "depth", "cell")


def _cells(value: str, width: int, depth: int) -> Column:
    """The value's counter in each row of the sketch."""
    cells = [
        F.struct(F.lit(d).alias("depth"), F.pmod(F.xxhash64(F.col(value), F.lit(d)), F.lit(width)).alias("cell"))
        for d in range(depth)
    ]
    return F.inline(F.array(*cells))


def key_sketch(
    tables: Mapping[str, DataFrame],
    key_columns: Mapping[str, Sequence[str]],
    width: int = WIDTH,
    depth: int = DEPTH,
) -> DataFrame:
    """``(table_name, column, depth, cell, n)``: at most ``width * depth`` rows for each key column.

    Counted before the shuffle, so a value that fills a table costs no more than others. Nulls match nothing and
    are not counted.
    """
    parts = []
    for name, columns in key_columns.items():
        if not columns:
            continue
        keys = tables[name].select(*[F.col(quoted(c)) for c in columns]).select(F.inline(key_pairs(columns)))
        parts.append(keys.where("value IS NOT NULL").select(F.lit(name).alias("table_name"), "column", "value"))
    if not parts:
        raise ValueError("no table has a key column")
    counted = reduce(DataFrame.unionByName, parts).select("table_name", "column", _cells("value", width, depth))
    return counted.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))


def forecast(sketch: DataFrame, probes: DataFrame, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """``(table_name, column, value, at_most)``: rows that each search value can reach at most.

    Never below the true number; above it only by rows of other values that share all ``depth`` counters.
    ``width`` and ``depth`` are those of the sketch. Each search value counts once, whoever it is searched for.
    """
    pairs = probes.select("table_name", "column", "value").distinct()
    return (
        pairs.select("*", _cells("value", width, depth))
        .join(sketch, list(CELL), "left")
        .groupBy("table_name", "column", "value")
        .agg(F.min(F.coalesce("n", F.lit(0))).alias("at_most"))
    )


def pass_forecast(sketch: DataFrame, probes: DataFrame, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """``(table_name, column, n_values, at_most)``: what a pass over these search values can reach at most."""
    return (
        forecast(sketch, probes, width, depth)
        .groupBy("table_name", "column")
        .agg(F.count(F.lit(1)).alias("n_values"), F.sum("at_most").alias("at_most"))
    )
