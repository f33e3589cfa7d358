"""Vector codes: each part of a vector as the number of its nearest codebook entry.

A vector of integer coordinates is cut into ``PARTS`` consecutive parts. Each part position has a codebook of at most
64 entries: at first those parts of the vectors with the smallest ids, then, for ``rounds`` rounds, every part goes
to its nearest entry and every entry moves to the rounded-down mean of its parts.

*Nearest entry by slices and masks.* In each dimension the entries' coordinates are sorted, and a mask of
64 bits says for every prefix of that order which entries are in it. A part and a radius select a range in each
dimension; the two prefix masks at its ends, combined by XOR, are the entries in the range, and the AND over the dimensions
is exactly the set of entries in the box around the part. Their distances are computed one set bit after the other. If the
best is within the radius, no entry outside of the box can be nearer; else the radius becomes that distance, or twice
as large where the box is empty, and the part is looked up again. Ties go to the lower number.

*On Spark.* Codebooks (64 vectors in all) go to all tasks; each task adds up its parts by entry, Spark adds up the tasks'
sums, and only one sum for each codebook coordinate returns. Vectors are never shuffled.

Defined cases: rows whose vector is null, has null or non-finite entries, is empty, or has another length than most are
left out; with fewer vectors than 64 the codebooks are smaller; entries without parts stay; null ids come last in the order
of ids; rows with equal ids are ordered by vector; rows with a null label share one label; an empty table gives no rows.
A dimension that 16 does not divide is cut as evenly as can be. Coordinates are limited to about 2^30 / sqrt(d);
``label_error`` is null beyond 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lethe.llm.frames import ship, stored
from lethe.llm.vectors import matrix, scaled
from lethe.operators.lookup import lookup_join
from lethe.settings import Limits

PARTS, ENTRIES, ROUNDS = 16, 64, 2


class SlicedBook:
    """A codebook's entries, sorted by each coordinate, with the masks of all prefixes."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        bits = np.uint64(1) << np.arange(len(entries), dtype=np.uint64)
        none = np.zeros(1, np.uint64)
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = [entries[o, k] for k, o in enumerate(self.order.T)]
        self.prefix = [np.append(none, np.bitwise_or.accumulate(bits[o])) for o in self.order.T]
        self.all = np.bitwise_or.reduce(bits)
        apart = ((entries[:, None] - entries[None]) ** 2).sum(2)
        np.fill_diagonal(apart, np.iinfo(np.int64).max)
        near = apart.min(0) if len(entries) > 1 else np.ones(1, np.int64)
        #: A typical distance between neighbouring entries, to begin with.
        self.radius = max(1, int(np.sqrt(np.median(near))))

    def in_box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each row the mask of the entries that differ by at most the radius in every coordinate."""
        mask = np.full(len(x), self.all)
        for k, (coordinates, prefix) in enumerate(zip(self.sorted, self.prefix)):
            low = np.searchsorted(coordinates, x[:, k] - radius, side="left")
            high = np.searchsorted(coordinates, x[:, k] + radius, side="right")
            mask &= prefix[high] ^ prefix[low]
        return mask

    def best_of(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest entry in each mask; -1 where the mask is empty."""
        which = np.full(len(x), -1)
        best = np.full(len(x), np.iinfo(np.int64).max)
        rows = np.flatnonzero(mask)
        left = mask[rows]
        while len(rows):
            lowest = left & (~left + np.uint64(1))
            entry = np.frexp(lowest.astype(np.float64))[1] - 1
            away = ((x[rows] - self.entries[entry]) ** 2).sum(1)
            nearer = away < best[rows]
            which[rows[nearer]], best[rows[nearer]] = entry[nearer], away[nearer]
            left = left ^ lowest
            rows, left = rows[left != 0], left[left != 0]
        return which, best

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each row's nearest entry."""
        which, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        rows, radius = np.arange(len(x)), np.full(len(x), self.radius, np.int64)
        while len(rows):
            entry, away = self.best_of(x[rows], self.in_box(x[rows], radius))
            some = entry >= 0
            reach = np.where(some, np.ceil(np.sqrt(away.astype(np.float64))).astype(np.int64) + 1, 2 * radius)
            done = some & (away <= radius * radius)
            which[rows[done]], best[rows[done]] = entry[done], away[done]
            rows, radius = rows[~done], np.minimum(reach[~done], 1 << 31)
        return which, best


def cuts(d: int, parts: int = PARTS) -> list[slice]:
    return [slice(d * k // parts, d * (k + 1) // parts) for k in range(parts)]


def _assigned(x: np.ndarray, books: list[SlicedBook], at: list[slice]) -> tuple[np.ndarray, np.ndarray]:
    """(number of entry, squared distance) for each vector and part."""
    found = [book.nearest(np.ascontiguousarray(x[:, s])) for book, s in zip(books, at)]
    return np.array([f[0] for f in found]).T, np.array([f[1] for f in found]).T


def first_vectors(rows: DataFrame, d: int, entries: int = ENTRIES) -> np.ndarray:
    """The vectors of the smallest ids, at most ``entries``."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    return np.array([r["x"] for r in first], dtype=np.int64).reshape(len(first), d)


def train(rows: DataFrame, d: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks side by side: row ``e`` holds the entries number ``e`` of all parts."""
    at, book = cuts(d, parts), first_vectors(rows, d, entries)
    for _ in range(rounds if len(book) else 0):
        book = _moved(rows, d, at, book)
    return book


def _moved(rows: DataFrame, d: int, at: list[slice], book: np.ndarray) -> np.ndarray:
    """One round: entries at the mean of their parts."""
    k, part_of = len(book), np.repeat(np.arange(len(at)), [s.stop - s.start for s in at])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [SlicedBook(book[:, s]) for s in at]
        sums, counts = np.zeros((k, d), np.int64), np.zeros((k, len(at)), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), d)
            entry, _ = _assigned(x, books, at)
            for p, s in enumerate(at):
                np.add.at(sums[:, s], entry[:, p], x[:, s])
                counts[:, p] += np.bincount(entry[:, p], minlength=k)
        both = np.append(sums.ravel(), counts.ravel())
        place = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(both[place])], names=["place", "value"])

    found = rows.select("x").mapInArrow(task, "place long, value long").groupBy("place").agg(F.sum("value").alias("value"))
    both, table = np.zeros(k * (d + len(at)), np.int64), found.toArrow()
    both[table.column("place").to_numpy()] = table.column("value").to_numpy()
    sums, counts = both[: k * d].reshape(k, d), both[k * d :].reshape(k, -1)[:, part_of]
    return np.where(counts > 0, sums // np.maximum(counts, 1), book)


def digest(book: np.ndarray, parts: int = PARTS) -> str:
    """SHA-256 of all entries' components, by part, entry and position."""
    numbers = [str(v) for s in cuts(book.shape[1], parts) for entry in book[:, s].tolist() for v in entry]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for each row of (vec_id, embedding, label)."""
    if not 1 <= entries <= 64:
        raise ValueError("masks hold 64 entries at most")
    rows, d = scaled(df, "vec_id", "label")
    rows = stored(rows, "vectors")
    book, at = train(rows, d, parts, entries, rounds), cuts(d, parts)
    schema = StructType(
        [rows.schema["vec_id"], rows.schema["label"], StructField("code", StringType()), StructField("error", LongType())]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [SlicedBook(book[:, s]) for s in at]
        for batch in batches:
            entry, away = _assigned(matrix(batch.column(2), d), books, at)
            code = [bytes(row).hex() for row in entry.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(away.sum(1))], names=schema.names
            )

    coded = stored(rows.mapInArrow(task, schema), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = F.col("total") <= F.lit((1 << 63) - 1)
    sums = coded.groupBy("label").agg(total.alias("total"))
    sums = stored(sums.select("label", F.when(fits, F.col("total")).cast("long").alias("label_error")), "label-errors")
    joined = lookup_join(coded, sums, ["label"], "left", Limits(), null_safe=True)
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(book, parts)).alias("codebooks_sha256"))


ship(__name__)
