"""MinHash near-duplicates: an LSH forest of sorted signature orders, verified, with components.

*Sets*: words of the text with A-Z in lower case, different shingles of ``SHINGLE`` words; a text with fewer words is one
shingle; a text without words has the empty set. Equal sets are one vertex, so copies are never paired.

*Signatures*: ``HASHES`` minimum values of a set under different hash functions, one byte of each. Two sets agree in each
byte with a probability of their Jaccard similarity (and 1/256 of the rest).

*Forest*: the signature, turned to begin at each ``DEPTH``-th byte, gives ``HASHES / DEPTH`` labels of a set. For each of these
orders all labels are sorted. Neighbours in an order are those with the longest common prefixes: a label is paired with
the next ones in its order as long as ``DEPTH`` leading bytes agree. Where many labels share a prefix (a passage
in many documents), the ``WINDOW`` next ones are those that agree furthest, so the depth adapts to each region. Sorting by
ranges splits a region of any size over tasks; the ends of the ranges are sorted and paired once more.

*Two passes*. The first pairs only direct neighbours in a few orders, verifies and joins sets into components: large groups of
near-copies become one component from a few links each. The second pairs labels of different components, in all orders, so
its window reaches over the copies that are already together. No pair of a group is left out that could still join components.

*Verification*: a pair is dropped early only by what its links cannot have: sizes whose ratio excludes the similarity, or signatures that
agree in far fewer bytes than similar sets do (4 standard deviations below). All others are compared on the full sets.

Recall: a pair with similarity 0.8 shares no prefix in any order with probability (1 - 0.8^4)^20 = 3e-5, and has a signature that
is dropped early with 3e-5. In a region wider than the window a text whose only partners stand elsewhere can be missed.

Defined cases: null and empty texts, and texts without words, are linked with nothing, their component is their own id;
``component_id`` is the least id in reach, nulls aside (null if the component has null ids only); ``kept`` compares null ids as
equal; repeated rows are kept; an empty table gives no rows. Hashes of 64 bits stand for shingles (48 within a
pair), and of 128 bits for sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from lethe.llm.frames import pick, ship, stored
from lethe.llm.simhash import components
from lethe.llm.words import mix, separators, sliced, words_of
from lethe.operators.lookup import lookup_join
from lethe.settings import Limits

SHINGLE = 2
#: Links have at least this many hundredths of their union in common.
PERCENT = 80
HASHES, DEPTH = 80, 4
#: Labels after its own that a label is paired with, in regions with more of them.
WINDOW = 24
#: The first pass: every so many orders, and neighbours in each.
FIRST_STEP, FIRST_WINDOW = 2, 1
#: Identifiers sent to all tasks at most (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 500_000
_BYTES = 6  # of a shingle's hash, within a pair
_rng = np.random.default_rng(13)
_FUNCTIONS = _rng.integers(1, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ALONE, _FIRST, _LOW, _HIGH = _rng.integers(1, 2**63, 4, dtype=np.uint64)
_SLICE = 4 << 20


# --- sets ------------------------------------------------------------------------------------


def shingles(words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the different shingles, by text and hash. The tables of ``words`` are those of ``words_of``."""
    counts = np.diff(words.first)
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(text)) - words.first[text]
    size_here = np.minimum(counts, size)[text]  # a short text is one shingle
    begin = np.flatnonzero(place + size_here <= counts[text])
    hashes = np.full(len(begin), _ALONE)
    for k in range(size):
        inside = k < size_here[begin]
        word = words.hash[np.minimum(begin + k, max(len(text) - 1, 0))]
        hashes = np.where(inside, mix((hashes ^ _FIRST) + word), hashes)
    order = np.lexsort((hashes, text[begin]))
    text, hashes = text[begin][order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def signatures(hashes: np.ndarray, starts: np.ndarray, count: int = HASHES) -> np.ndarray:
    """One row of bytes for each run of hashes."""
    out = np.empty((len(starts), count), np.uint8)
    for k in range(count):
        least = np.minimum.reduceat(hashes * _FUNCTIONS[k], starts)
        out[:, k] = (mix(least) & np.uint64(255)).astype(np.uint8)
    return out


def _packed(hashes: np.ndarray) -> np.ndarray:
    """The leading bytes of each hash; in the order of the hashes."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES]


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _BYTES, 8), np.uint8)
    out[:, :_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, _BYTES)
    return out.view(">u8").ravel()


def _texts_to_sets(shingle: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = separators()
        for batch in batches:
            for row, offsets, data in sliced(batch.column(1), _SLICE):
                n = len(offsets) - 1
                text, hashes = shingles(words_of(offsets, data, table, lower=True), shingle)
                own, starts = np.unique(text, return_index=True)
                sizes, keys = np.zeros(n, np.int64), np.zeros((2, n), np.uint64)
                marks, sets = [None] * n, [b""] * n
                if len(own):
                    sizes[own] = np.diff(np.append(starts, len(text)))
                    for key, salt in zip(keys, (_LOW, _HIGH)):
                        key[own] = np.add.reduceat(mix(hashes ^ salt), starts)
                    packed, ends = _packed(hashes), np.append(starts[1:], len(text))
                    for t, mark, a, b in zip(own, signatures(hashes, starts), starts, ends):
                        marks[t], sets[t] = mark.tobytes(), packed[a:b].tobytes()
                columns = [pa.array(sizes), *[pa.array(k.view(np.int64)) for k in keys]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), *columns, pa.array(marks, pa.binary()), pa.array(sets, pa.binary())],
                    names=["doc_id", "n_shingles", "low", "high", "signature", "hashes"],
                )

    return task


def shingle_sets(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(row, doc_id, n_shingles, low, high, signature, hashes) for each row of (doc_id, text); stored."""
    docs = pick(df, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    names = {"n_shingles": LongType(), "low": LongType(), "high": LongType(), "signature": BinaryType(), "hashes": BinaryType()}
    schema = StructType([docs.schema["doc_id"], *[StructField(k, v) for k, v in names.items()]])
    found = docs.mapInArrow(_texts_to_sets(shingle), schema)
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "shingle-sets")


# --- forest ----------------------------------------------------------------------------------


def least_agreeing(percent: int, hashes: int = HASHES) -> int:
    """Signature bytes that sets of this similarity share at least, but for 4 standard deviations."""
    p = percent / 100
    return int(np.floor(hashes * p - 4 * np.sqrt(hashes * p * (1 - p))))


def _neighbours(tree, labels, ids, sizes, groups, skip: int, window: int, percent: int):
    """(a, b) of rows in order, the later one not among the first ``skip``, that may be links of different groups."""
    if len(ids) < 2:
        return np.zeros((2, 0), np.int64)
    differ = labels[1:] != labels[:-1]
    common = np.where(differ.any(1), differ.argmax(1), labels.shape[1])
    common[tree[1:] != tree[:-1]] = 0
    near = common >= DEPTH
    found, least = [], least_agreeing(percent, labels.shape[1])
    for step in range(1, min(window, len(ids) - 1) + 1):
        if step > 1:  # the common prefix reaches over all rows between
            near = near[:-1] & (common[step - 1 :] >= DEPTH)
        a = np.flatnonzero(near)
        if not len(a):
            break
        a = a[a + step >= skip]
        b = a + step
        some = (groups[a] != groups[b]) & (100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b]))
        a, b = a[some], b[some]
        some = (labels[a] == labels[b]).sum(1) >= least
        found.append(np.array([np.minimum(ids[a[some]], ids[b[some]]), np.maximum(ids[a[some]], ids[b[some]])]))
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


_LABELS = "tree int, label binary, id long, n long, component long"
_NAMES = ["tree", "label", "id", "n", "component"]


def _arrays(batch: pa.RecordBatch):
    label = batch.column(1)
    wide = np.frombuffer(b"".join(label.to_pylist()), np.uint8).reshape(len(label), -1)
    return [batch.column(0).to_numpy(), wide, *[batch.column(k).to_numpy() for k in (2, 3, 4)]]


def _paired(window: int, percent: int):
    """Pairs of a sorted range, and its first and last rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, head = None, None
        nothing = lambda k: pa.nulls(k, pa.int64())

        def out(pairs=None, ends=None):
            k = pairs.shape[1] if pairs is not None else len(ends[2])
            if pairs is not None:
                columns = [pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), nothing(k), nothing(k), nothing(k), pa.array(pairs[0]), pa.array(pairs[1])]
            else:
                label = pa.array([x.tobytes() for x in ends[1]], pa.binary())
                columns = [pa.array(ends[0], pa.int32()), label, *[pa.array(c) for c in ends[2:]], nothing(k), nothing(k)]
            return pa.RecordBatch.from_arrays(columns, names=[*_NAMES, "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _arrays(batch)
            if head is None or len(head[2]) < window:
                begin = [c[:window] for c in rows]
                head = begin if head is None else [np.concatenate([x, y])[:window] for x, y in zip(head, begin)]
            skip = 0
            if before is not None:
                skip = len(before[2])
                rows = [np.concatenate([x, y]) for x, y in zip(before, rows)]
            yield out(_neighbours(*rows, skip, window, percent))
            before = [c[-window:] for c in rows]
        if before is not None:
            yield out(ends=head)
            yield out(ends=before)

    return task


def _pair_ends(window: int, percent: int):
    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in rows:
            if not batch.num_rows:
                continue
            now = _arrays(batch)
            skip = 0
            if held is not None:
                skip = len(held[2])
                now = [np.concatenate([x, y]) for x, y in zip(held, now)]
            a, b = _neighbours(*now, skip, window, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            held = [c[-window:] for c in now]

    return task


def forest_pairs(sets: DataFrame, step: int = 1, window: int = WINDOW, percent: int = PERCENT, hashes: int = HASHES) -> DataFrame:
    """(a, b): different ``id`` of ``sets`` (id, n, signature, component) near each other in some order.

    Every ``step``-th order is used, and pairs of one component are left out.
    """
    turned = [
        F.struct(
            F.lit(k).alias("tree"),
            F.concat(F.substring("signature", DEPTH * k + 1, hashes), F.substring("signature", 1, DEPTH * k)).alias("label"),
        )
        for k in range(0, hashes // DEPTH, step)
    ]
    labels = sets.select("id", "n", "component", F.explode(F.array(*turned)).alias("t")).select("t.tree", "t.label", "id", "n", "component")
    sort = ["tree", "label", "id"]
    ranges = max(1, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = stored(
        labels.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort).mapInArrow(_paired(window, percent), f"{_LABELS}, a long, b long"),
        "forest-neighbours",
    )
    # a few rows for each range, whatever its size
    ends = found.where("id is not null").select(*_NAMES).repartition(len(turned), "tree").dropDuplicates(["tree", "id"])
    across = ends.sortWithinPartitions(*sort).mapInArrow(_pair_ends(window, percent), "a long, b long")
    return found.where("a is not null").select("a", "b").union(across).distinct()


# --- verification ----------------------------------------------------------------------------


def _compare(percent: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for row, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = _unpacked(x.as_buffer()), _unpacked(y.as_buffer())
                both = np.concatenate([x, y])
                both.sort(kind="stable")  # two sorted runs: merged
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= percent * (len(both) - shared):
                    kept.append(row)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(kept, pa.int64())) for k in (0, 1)], names=["a", "b"])

    return task


def verified(pairs: DataFrame, hashes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose sets, from ``hashes`` (id, hashes), are similar enough; stored."""
    pairs = stored(pairs, "similar-candidates")
    ids = stored(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "candidate-ids")
    few = ids.count() <= BROADCAST_IDS
    some = stored(hashes.join(F.broadcast(ids) if few else ids, "id", "left_semi"), "candidate-sets")
    x, y = (some.select(F.col("id").alias(k), F.col("hashes").alias(f"{k}_set")) for k in ("a", "b"))
    joined = pairs.join(x, "a").join(y, "b").select("a", "b", "a_set", "b_set")
    return stored(joined.mapInArrow(_compare(percent), "a long, b long"), "similar-links")


def near_duplicates(
    df: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, window: int = WINDOW, first_window: int = FIRST_WINDOW
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of (doc_id, text)."""
    rows = shingle_sets(df, shingle)
    some = rows.where("n_shingles > 0")
    sets = stored(
        some.groupBy("low", "high", F.col("n_shingles").alias("n")).agg(
            F.min("row").alias("id"), F.min("doc_id").alias("least_id"), F.first("signature").alias("signature")
        ),
        "different-sets",
    )
    hashes = rows.select(F.col("row").alias("id"), "hashes")
    alone = sets.select("id", "n", "signature", F.col("id").alias("component"))
    links = verified(forest_pairs(alone, FIRST_STEP, first_window, percent), hashes, percent)
    first = stored(components(links), "first-components").withColumnRenamed("vertex", "id")
    together = stored(
        alone.drop("component").join(first, "id", "left").select("id", "n", "signature", F.coalesce("root", "id").alias("component")),
        "grouped-sets",
    )
    links = verified(forest_pairs(together, 1, window, percent), hashes, percent)
    group = together.select("id", "component")
    across = (
        links.join(group.withColumnsRenamed({"id": "a", "component": "x"}), "a")
        .join(group.withColumnsRenamed({"id": "b", "component": "y"}), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    last = stored(components(across), "last-components").withColumnRenamed("vertex", "component")
    named = stored(
        lookup_join(together.select("id", "component"), last, ["component"], "left", Limits()).select(
            "id", F.coalesce("root", "component").alias("root")
        ),
        "set-components",
    )
    by_set = stored(sets.select("id", "low", "high", F.col("n").alias("n_shingles"), "least_id").join(named, "id"), "sets-by-root")
    least = stored(by_set.groupBy("root").agg(F.min("least_id").alias("component_id")), "least-of-components")
    joined = lookup_join(by_set, least, ["root"], "inner", Limits())
    classes = stored(joined.select("low", "high", "n_shingles", "component_id"), "set-classes")
    linked = some.select("doc_id", "n_shingles", "low", "high").join(classes, ["low", "high", "n_shingles"])
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return (
        linked.select("doc_id", "n_shingles", "component_id")
        .union(empty)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


ship(__name__)
