"""Repeated byte strings: every byte under a string of ``LENGTH`` bytes that also starts elsewhere goes.

*Finding what can repeat.* A window is a string of ``LENGTH`` bytes. Its anchor is its least-hashed gram of ``k``
bytes (the first one among equals), which depends on its bytes alone, so equal windows have equal anchors.
Neighbouring windows with the same anchor form a segment. Only segments whose anchor occurs at two places can
hold a repeated window; the texts' other parts are left out, and equal segments are held once.

*Merging Burrows-Wheeler transforms.* The segments of an anchor meet in a task, many anchors to a task;
those that share neither the bytes before the anchor nor those after it with another are left out. The
alphabet are grams of ``STEP`` bytes, so a segment is ``STEP`` strings over it, one for each remainder of
the place, and a window is its first ``LENGTH / STEP`` symbols. Shards of segments get a suffix array and a transform each. The
transforms are merged by refining an interleave: starting with the shards one after the other, each round reads the
transforms along the interleave and puts every entry, in this order, to the place of its preceding symbol. After
round k the interleave is sorted by k symbols. The limits of equal prefixes are carried along: a limit
appears in the round that is the common prefix's length. Suffixes are not sorted again. After the last
round, blocks with two entries or more are the repeated windows.

*Large groups.* Copies of a text are one text, which repeats as a whole. An anchor with more than ``most``
different segments is taken apart: their windows get anchors of longer grams, at the last level of whole windows,
of which equal ones are one. So no group is held whole and none is dropped.

Defined cases: a null text is empty; texts are taken as UTF-8 and never joined; texts below ``LENGTH``
bytes keep all; equal rows repeat each other and lose the same; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lethe.llm.frames import pick, ship, stored
from lethe.llm.words import mix, sliced

LENGTH = 200
GRAMS = (32, 100, 150, LENGTH)
STEP = 50
#: Different segments of an anchor that one task takes.
MOST = 4096
#: Bytes of segments in a task, and places in a shard.
TASK_BYTES, SHARD = 2 << 20, 1 << 17
_SLICE = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = 26
_BYTE = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from each place; fewer places than bytes by ``k - 1``."""
    if len(data) < k:
        return np.zeros(0, np.uint64)
    part, size, out, done = _BYTE[data], 1, None, 0
    rest = k
    while True:
        if rest & 1:
            out = part if out is None else out[: len(part) - done] * _power(size) + part[done:][: len(out)]
            done += size
        rest >>= 1
        if not rest:
            return mix(out[: len(data) - k + 1])
        part = part[: len(part) - size] * _power(size) + part[size:]
        size *= 2


def segments(offsets: np.ndarray, data: np.ndarray, k: int, length: int) -> tuple[np.ndarray, ...]:
    """(text, start in the text, windows, anchor, anchor's place in ``data``) of the segments of all texts."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    hashes = gram_hashes(data, k)
    if len(data) >= 1 << _PLACE_BITS:  # a very long text: hash and place do not fit one number
        least = _least_places(hashes, length - k + 1)
    else:
        places = np.arange(len(hashes), dtype=np.uint64)
        keys = (hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | places
        least = _sliding_least(keys, length - k + 1) & np.uint64((1 << _PLACE_BITS) - 1)
    least = least[:n].astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    valid = np.arange(n) + length <= offsets[text + 1]
    begins = valid.copy()
    begins[1:] &= (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    start = np.flatnonzero(begins)
    ends = np.flatnonzero(valid & ~np.append(valid[1:] & ~begins[1:], False)) + 1
    return text[start], start - offsets[text[start]], ends - start, hashes[least[start]], least[start]


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[: len(keys) - size], keys[size:])
        size *= 2
    more = width - size
    return np.minimum(keys[: len(keys) - more], keys[more:]) if more else keys


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    out, step = [], (1 << _PLACE_BITS) - width
    for i in range(0, max(1, len(hashes) - width + 1), step):
        part = hashes[i : i + step + width - 1]
        keys = (part >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(part), dtype=np.uint64)
        out.append((_sliding_least(keys, width) & np.uint64((1 << _PLACE_BITS) - 1)) + np.uint64(i))
    return np.concatenate(out)


# --- merging transforms ----------------------------------------------------------------------


def merged_repeats(data: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int, shard: int = SHARD):
    """Which places of the segments ``data[begin:begin + size]`` start a window that occurs twice.

    Gives (segment, place) of these. ``length`` is a multiple of ``STEP``.
    """
    step, rounds = STEP, length // STEP
    slots = size + 1  # a suffix for each place, the empty ones at the end too
    first = np.append(0, np.cumsum(slots))
    segment = np.repeat(np.arange(len(size)), slots)
    place = np.arange(first[-1]) - first[segment]
    held = (size[segment] - place) // step  # symbols from here
    hashes = gram_hashes(data, step)
    symbol = np.zeros(first[-1], np.uint64)
    some = np.flatnonzero(held > 0)
    symbol[some] = hashes[begin[segment[some]] + place[some]] | np.uint64(1)
    before = np.zeros(first[-1], np.uint64)
    some = np.flatnonzero(place >= step)
    before[some] = symbol[some - step]
    last = np.arange(first[-1]) + step * held  # where the string of a suffix ends
    # each shard: suffix array, transform
    suffixes, number, terminals = [], [], []
    cuts = [0]
    while cuts[-1] < len(size):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(first, first[cuts[-1]] + shard, side="right")) - 1))
    for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
        own = np.arange(first[a], first[b])
        keys = [last[own]]
        for m in reversed(range(int(held[own].max(initial=0)))):
            at = own + step * m
            keys.append(np.where(held[own] > m, symbol[np.minimum(at, first[b] - 1)], np.uint64(0)))
        suffixes.append(own[np.lexsort(keys)])
        number.append(len(own))
        terminals.append(int((held[own] == 0).sum()))
    suffix = np.concatenate(suffixes)
    transform = before[suffix]
    kind = np.uint16 if len(number) < 1 << 16 else np.int64
    ends = np.repeat(np.arange(len(number)), terminals).astype(kind)
    interleave = np.repeat(np.arange(len(number)), number).astype(kind)
    block = np.zeros(len(suffix), np.int64)
    for _ in range(rounds):
        along = np.empty(len(suffix), np.uint64)
        along[np.argsort(interleave, kind="stable")] = transform
        some = np.flatnonzero(along)
        order = some[np.argsort(along[some], kind="stable")]
        limit = np.append(True, (along[order][1:] != along[order][:-1]) | (block[order][1:] != block[order][:-1]))
        interleave = np.append(ends, interleave[order])
        # the ends of strings differ from each other
        block = np.append(np.arange(len(ends)), len(ends) + np.cumsum(limit[: len(order)]) - 1)
    whole = np.empty(len(suffix), np.int64)
    whole[np.argsort(interleave, kind="stable")] = suffix
    twice = np.bincount(block)[block] > 1
    found = np.sort(whole[twice & (held[whole] >= rounds)])
    return segment[found], place[found]


def _runs(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, number) of runs of neighbouring places."""
    begin = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1))[: len(row)])
    return row[begin], place[begin], np.diff(np.append(begin, len(row)))


def merger(length: int):
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # TASK_BYTES of segments, and one anchor's at least
        if not held:
            return
        s1, s2 = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in (0, 1))
        parts = [p for b in held for p in b.column(2).to_pylist()]
        size = np.array([len(p) for p in parts], np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        row, start, n = _runs(*merged_repeats(data, np.cumsum(size) - size, size, length))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (s1[row], s2[row], start, n)], names=["s1", "s2", "at", "n"])

    return merged


# --- tables ----------------------------------------------------------------------------------

ROWS = "o1 long, o2 long, start long, anchor long, s1 long, s2 long, left long, right long, part binary"


def _side(hashes: np.ndarray, at: np.ndarray, valid: np.ndarray) -> pa.Array:
    values = np.zeros(len(at), np.uint64)
    values[valid] = hashes[at[valid]]
    return pa.array(values.view(np.int64), mask=~valid)


def cutter(k: int, length: int):
    """(o1, o2, start, text bytes, anchors or null) to the segments with these anchors."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in sliced(batch.column(3), _SLICE):
                n = len(offsets) - 1
                text, start, windows, anchor, spot = segments(offsets, data, k, length)
                if batch.num_columns > 4:
                    wanted = batch.column(4).slice(row, n)
                    at = np.append(0, np.cumsum(wanted.value_lengths().to_numpy(zero_copy_only=False)))
                    values = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    keep = np.zeros(len(text), bool)
                    bounds = np.searchsorted(text, np.arange(n + 1))
                    for i in range(n):
                        mine = slice(bounds[i], bounds[i + 1])
                        keep[mine] = np.isin(anchor[mine], values[at[i] : at[i + 1]])
                    text, start, windows, anchor, spot = (x[keep] for x in (text, start, windows, anchor, spot))
                o1, o2, base = (batch.column(c).slice(row, n).to_numpy(zero_copy_only=False) for c in range(3))
                begin = offsets[text] + start
                end = begin + windows + length - 1
                # of a window's bytes beside the anchor at least half lie on one side of it
                half = (length - k + 1) // 2
                wide = gram_hashes(data, k + half)
                left = _side(wide, spot - half, spot - half >= begin)
                right = _side(wide, spot, spot + k + half <= end)
                for i in range(0, len(text), 20_000):
                    j = slice(i, i + 20_000)
                    parts = [data[a:b].tobytes() for a, b in zip(begin[j], end[j])]
                    digests = [hashlib.blake2b(p, digest_size=16).digest() for p in parts]
                    s = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(o1[text[j]]), pa.array(o2[text[j]]), pa.array(base[text[j]] + start[j]),
                            pa.array(anchor[j].view(np.int64)), pa.array(s[:, 0].copy()), pa.array(s[:, 1].copy()),
                            left[j], right[j], pa.array(parts, pa.binary()),
                        ],
                        names=["o1", "o2", "start", "anchor", "s1", "s2", "left", "right", "part"],
                    )

    return cut


def anchor_finder(k: int, length: int):
    """(k1, k2, text) to a row for each segment: (k1, k2, anchor, mark of the text and place)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in sliced(batch.column(2), _SLICE):
                text, start, _, anchor, _ = segments(offsets, data, k, length)
                k1, k2 = (batch.column(c).slice(row, len(offsets) - 1).to_numpy(zero_copy_only=False)[text] for c in (0, 1))
                mark = mix(k1.view(np.uint64) + mix(start.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1), pa.array(k2), pa.array(anchor.view(np.int64)), pa.array(mark.view(np.int64))],
                    names=["k1", "k2", "anchor", "mark"],
                )

    return found


def repeated_places(rows: DataFrame, length: int = LENGTH, grams=GRAMS, most: int = MOST) -> DataFrame:
    """(o1, o2, at, n): runs of repeated windows in the owners of ``rows`` (as ROWS; stored)."""
    different = stored(
        rows.groupBy("anchor", "s1", "s2").agg(*[F.first(c).alias(c) for c in ("part", "left", "right")], F.count(F.lit(1)).alias("owners")), "segments"
    )
    sizes = stored(
        different.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("part")).alias("bytes")).where("n > 1"),
        "anchor-sizes",
    )
    last = len(grams) == 1
    few = sizes if last else sizes.where(F.col("n") <= most)
    total = few.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES))
    # segments with a common window also share the anchor with half of the bytes beside it
    close = different.join(few.select("anchor"), "anchor", "left_semi").repartition(tasks, "anchor")
    for side in ("left", "right"):
        alike = F.count(side).over(Window.partitionBy("anchor", side))
        close = close.withColumn(f"{side}s", alike)
    found = [
        different.where("owners > 1").select("s1", "s2", F.lit(0).cast("long").alias("at"), (F.octet_length("part") - length + 1).cast("long").alias("n")),
        close.where("lefts > 1 or rights > 1")
        .select("s1", "s2", "part")
        .mapInArrow(merger(length), "s1 long, s2 long, at long, n long"),
    ]
    if not last:
        many = sizes.where(F.col("n") > most).select("anchor")
        if not many.isEmpty():
            apart = different.join(many, "anchor", "left_semi").select("s1", "s2", F.lit(0).cast("long").alias("start"), "part")
            deeper = stored(apart.mapInArrow(cutter(grams[1], length), ROWS), "segments-apart")
            found.append(
                repeated_places(deeper, length, grams[1:], most).select(F.col("o1").alias("s1"), F.col("o2").alias("s2"), "at", "n")
            )
    runs = stored(reduce(DataFrame.union, found), "repeated-runs")
    return rows.select("o1", "o2", "start", "s1", "s2").join(runs, ["s1", "s2"]).select(
        "o1", "o2", (F.col("start") + F.col("at")).alias("at"), "n"
    )


def trimmer(length: int):
    """What is left of texts (null: not asked for) without their repeated windows."""

    def trimmed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans in batches:
            out = []
            for text, runs in zip(texts, spans):
                if text is None:
                    out.append((0, 0, None))
                    continue
                data = np.frombuffer(text.encode(), np.uint8)
                edge = np.zeros(len(data) + 1, np.int64)
                for r in runs:
                    edge[r["at"]] += 1
                    edge[r["at"] + r["n"] + length - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                spans_ = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((int(gone.sum()), spans_, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            yield pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256"])

    return trimmed


def _text_keys(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")]


def remove_repeats(df: DataFrame, length: int = LENGTH, grams=GRAMS, most: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, copies) for each row of (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = pick(df, "doc_id", "text").select("doc_id", text.alias("text"), *_text_keys(text))
    anchors = stored(docs.select("k1", "k2", "text").mapInArrow(anchor_finder(grams[0], length), "k1 long, k2 long, anchor long, mark long"), "anchors")
    again = anchors.groupBy("anchor").agg(F.min("mark").alias("a"), F.max("mark").alias("b")).where("a != b").select("anchor")
    wanted = anchors.join(again, "anchor", "left_semi").groupBy("k1", "k2").agg(F.collect_set("anchor").alias("anchors"))
    wanted = stored(wanted, "repeated-anchors")
    texts = docs.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    ours = texts.join(wanted, ["k1", "k2"]).select("k1", "k2", F.lit(0).cast("long").alias("start"), "text", "anchors")
    rows = stored(ours.mapInArrow(cutter(grams[0], length), ROWS), "repeated-segments")
    runs = (
        repeated_places(rows, length, grams, most)
        .groupBy("o1", "o2")
        .agg(F.collect_set(F.struct("at", "n")).alias("runs"))
        .select(F.col("o1").alias("k1"), F.col("o2").alias("k2"), "runs")
    )
    copies = docs.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    known = stored(copies.join(runs, ["k1", "k2"], "full"), "repeats-of-texts")
    joined = docs.join(known, ["k1", "k2"], "left").withColumn("n_bytes", F.octet_length("text").cast("long"))
    whole = (F.coalesce("copies", F.lit(1)) > 1) & (F.col("n_bytes") >= length)
    part = ~whole & F.col("runs").isNotNull()
    trim = F.pandas_udf(trimmer(length), "n_removed long, n_spans long, kept_sha256 string")
    trimmed = trim(F.when(part, F.col("text")), F.when(part, F.col("runs")))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return joined.withColumn("t", trimmed).select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).when(part, F.col("t.n_removed")).otherwise(zero).alias("n_removed"),
        F.when(whole, one).when(part, F.col("t.n_spans")).otherwise(zero).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).when(part, F.col("t.kept_sha256")).otherwise(F.sha2("text", 256)).alias("kept_sha256"),
        F.coalesce("copies", one).alias("copies"),
    )


ship(__name__)
