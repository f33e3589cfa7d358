"""Stupid-backoff scores of all documents under counts of the whole corpus.

For neighbouring words ``u v`` of a document with corpus counts c (N words in all):

    score(v | u) = c(u v) / c(u)             if c(u v) >= least (1: any count above 0)
                   backoff * c(v) / N        else, and for the first word of a document

A document's score is the sum of the natural logarithms over its words; ``mean`` divides by their number.
Words are parted at white space, taken as they are, and known by 64-bit hashes.

*Relational plan.*

1. Word counts: each task counts a slice of texts, one aggregation by word hash adds up.
2. Frequent words (more than ``N / FREQUENT`` of N, so fewer than ``FREQUENT``) go to all tasks with their counts (16 MB at most),
   and so do frequent pairs (more than ``N / HOT`` of N; both words then are among the fewer than ``HOT`` words
   that are as frequent). Pairs with a frequent count need no join; so no key of step 3 has a large share.
3. All other pairs are exploded and dealt by the hash of the pair into buckets of about ``BUCKET`` pairs,
   packed as one row for a slice and bucket. A bucket holds its part of the table of pair counts; the pairs
   are joined to it there.
4. What a pair still needs of a word that is not frequent is joined to the word counts, by word.
5. One aggregation adds up everything of a document.

Defined cases: null and empty texts have no words, score 0 and a null mean; equal rows (id and text)
are counted as often as they are there and get equal scores; null ids are ids; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm.frames import pick, ship, stored
from lethe.llm.words import mix, separators, sliced, words_of

BACKOFF, LEAST = 0.4, 1
FREQUENT, HOT = 1 << 20, 4_096
BUCKET = 1_200_000
_RANK = np.uint64(24)  # bits of a frequent word's number in a pair
_RARE = np.uint64(1 << 63)
_SLICE = 6 << 20
_SALT = np.uint64(0x5851F42D4C957F2D)


def _slices(batches: Iterator[pa.RecordBatch], column: int):
    """(batch, first row, texts, words) of slices of the batches."""
    table = separators()
    for batch in batches:
        for row, offsets, data in sliced(batch.column(column), _SLICE):
            yield batch, row, len(offsets) - 1, words_of(offsets, data, table)


def _pairs(words) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the first words of pairs, and the text of every word."""
    text = np.repeat(np.arange(len(words.first) - 1, dtype=np.int32), np.diff(words.first))
    return np.flatnonzero(text[1:] == text[:-1]), text


def pair_hash(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(mix(u ^ _SALT) + v)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(part) -> pa.RecordBatch:
        word, n = np.unique(part[-1].hash, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])

    yield from map(counted, _slices(batches, 0))


def pair_counter(hot_words):
    """Counts pairs of the words in the broadcast, which are sorted."""

    def of_slice(part) -> pa.RecordBatch:
        known, words = hot_words.value, part[-1]
        at, held = _lookup(known, words.hash)
        at[~held] = -1
        u, _ = _pairs(words)
        both = u[(at[u] >= 0) & (at[u + 1] >= 0)]
        pair, n = np.unique(at[both] * len(known) + at[both + 1], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(of_slice, _slices(batches, 0))

    return counted


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together: sorted numbers then compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _from_planes(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether found) in sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


class Settings:
    """What all tasks know: frequent words and pairs with their counts (bounded), and totals."""

    def __init__(self, total, buckets, words, word_counts, pairs, pair_counts, backoff, least):
        self.total, self.buckets, self.backoff, self.least = total, buckets, backoff, least
        self.words, self.word_logs = words, np.log(word_counts.astype(np.float64))
        self.pairs, self.pair_logs = pairs, np.log(pair_counts.astype(np.float64))
        self.floor = np.log(backoff) - np.log(max(total, 1))


def dealer(settings):
    """Documents (key, text) to packed rows of buckets.

    A packed row holds the pairs of a bucket: those of two frequent words as one number, then the others as the
    numbers of two words each (a rare word by its hash, with the top bit set); ``at`` says which of ``docs`` each is
    in. A row with ``value`` holds what was known at once, and words that stand first and are rare.
    """

    def of_slice(part) -> pa.RecordBatch:
        s: Settings = settings.value
        batch, row, n, words = part
        docs = batch.column(0).slice(row, n).to_numpy(zero_copy_only=False).astype(np.int64)
        rank, known = _lookup(s.words, words.hash)
        name = np.where(known, rank.astype(np.uint64), words.hash | _RARE)
        u, text = _pairs(words)
        pair = pair_hash(words.hash[u], words.hash[u + 1])
        # pairs of frequent count, and first words, need no pair count
        hot_at, hot = _lookup(s.pairs, pair)
        value = np.zeros(n)
        np.add.at(value, text[u[hot]], s.pair_logs[hot_at[hot]] - s.word_logs[rank[u[hot]]])
        first = words.first[:-1][np.diff(words.first) > 0]
        easy, hard = first[known[first]], first[~known[first]]
        np.add.at(value, text[easy], s.word_logs[rank[easy]] + s.floor)
        some = np.flatnonzero(value)
        out = [
            (row % s.buckets, docs[np.append(some, text[hard])].tobytes(), value[some].tobytes(), name[hard].tobytes(), b"", b"")
        ]
        u, pair = u[~hot], pair[~hot]
        bucket = (pair % np.uint64(s.buckets)).astype(np.int64)
        order = np.lexsort((name[u + 1], name[u], bucket))
        bounds = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else []
        for a, b in zip(bounds, [*bounds[1:], len(order)]):
            mine = u[order[a:b]]
            plain = known[mine] & known[mine + 1]
            mine = np.append(mine[plain], mine[~plain])
            both, loose = mine[: plain.sum()], mine[plain.sum() :]
            own, at = np.unique(text[mine], return_inverse=True)
            key = (name[both] << _RANK) | name[both + 1]
            out.append(
                (int(bucket[order[a]]), docs[own].tobytes(), _planes(at.astype(np.uint32)), _planes(key), _planes(name[loose]), _planes(name[loose + 1]))
            )
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]], pa.array([True] + [False] * (len(out) - 1))],
            names=["bucket", "docs", "at", "key", "u", "v", "value"],
        )

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a call for each slice: what it worked with is freed before the next slice is read
        yield from map(of_slice, _slices(batches, 1))

    return dealt


DEALT = "bucket long, docs binary, at binary, key binary, u binary, v binary, value boolean"
PARTIAL = "key long, value double, word long, n long"


def bucket_joiner(settings):
    """Joins the pairs of a bucket to its part of the count table.

    Gives (document, value) rows, and where ``n`` is not 0 that many logarithms of the word's count are still to
    be added.
    """

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        s: Settings = settings.value
        docs, names, values, out = [], [], [], []
        for r in rows[rows["value"]].itertuples(index=False):
            doc, value, word = (np.frombuffer(x, t) for x, t in ((r.docs, np.int64), (r.at, np.float64), (r.key, np.uint64)))
            known, hard = doc[: len(value)], doc[len(value) :]
            zero = np.zeros(len(value), np.int64)
            out.append(pd.DataFrame({"key": known, "value": value, "word": zero, "n": zero}))
            out.append(pd.DataFrame({"key": hard, "value": np.full(len(hard), s.floor), "word": word.view(np.int64), "n": np.ones(len(hard), np.int64)}))
        for r in rows[~rows["value"]].itertuples(index=False):
            key, u, v = (_from_planes(x, np.uint64) for x in (r.key, r.u, r.v))
            docs.append(np.frombuffer(r.docs, np.int64)[_from_planes(r.at, np.uint32)])
            names.append(np.append(key >> _RANK, u))
            values.append(np.append(key & np.uint64((1 << 24) - 1), v))
        if docs:
            doc, u, v = (np.concatenate(x) for x in (docs, names, values))
            docs, names, values = [], [], []  # held once only
            _, which, counts = np.unique(pair_hash(u, v), return_inverse=True, return_counts=True)
            c = counts[which]
            seen = c >= s.least
            word, sign = np.where(seen, u, v), np.where(seen, -1, 1)
            value = np.where(seen, np.log(c), s.floor)
            rare = word >= _RARE
            value[~rare] += sign[~rare] * s.word_logs[word[~rare].astype(np.int64)]
            own, at = np.unique(doc, return_inverse=True)
            out.append(pd.DataFrame({"key": own, "value": np.bincount(at, value), "word": np.zeros(len(own), np.int64), "n": np.zeros(len(own), np.int64)}))
            some = np.flatnonzero(rare)
            out.append(pd.DataFrame({"key": doc[some], "value": np.zeros(len(some)), "word": word[some].view(np.int64), "n": sign[some]}))
        return pd.concat(out, ignore_index=True)

    return joined


def _sorted(rows: DataFrame, kind=np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Two number columns of few rows, by the first."""
    found = rows.toArrow()
    keys, n = (found.column(c).to_numpy().astype(np.int64) for c in (0, 1))
    order = np.argsort(keys.view(kind))
    return keys.view(kind)[order], n[order]


def score(
    df: DataFrame, backoff: float = BACKOFF, least: int = LEAST, frequent: int = FREQUENT, hot: int = HOT, bucket: int = BUCKET
) -> DataFrame:
    """(doc_id, n_words, score, mean) for each row of (doc_id, text)."""
    context = df.sparkSession.sparkContext
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = pick(df, "doc_id", "text").select("doc_id", text.alias("text"))
    counts = stored(
        docs.select("text").mapInArrow(count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "word-counts",
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    # fewer than ``frequent`` words, whatever the corpus: 16 megabytes at most
    words, word_counts = _sorted(counts.where(F.col("n") * frequent > total))
    hot_words = words[word_counts * hot > total]
    pairs = (
        docs.select("text")
        .mapInArrow(pair_counter(context.broadcast(hot_words)), "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") * hot > total) & (F.col("n") >= least))  # fewer than ``hot`` rows
    )
    numbers, pair_counts = _sorted(pairs, np.int64)
    hashes = pair_hash(hot_words[numbers // max(len(hot_words), 1)], hot_words[numbers % max(len(hot_words), 1)])
    order = np.argsort(hashes)
    settings = context.broadcast(
        Settings(total, max(1, total // bucket), words, word_counts, hashes[order], pair_counts[order], backoff, least)
    )
    keyed = docs.select(F.xxhash64("doc_id", F.xxhash64("text"), F.lit(1)).alias("key"), "text")
    dealt = keyed.mapInArrow(dealer(settings), DEALT)
    found = stored(dealt.groupBy("bucket").applyInPandas(bucket_joiner(settings), PARTIAL), "pair-scores")
    # rare words are known by 63 bits of their hash
    logs = counts.select(F.col("word").bitwiseOR(F.lit(-(1 << 63))).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("c"))
    late = found.where("n != 0").groupBy("word", "key").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    late = late.join(logs, "word").select("key", (F.col("value") + F.col("n") * F.log("c")).alias("value"))
    sums = (
        found.where("n = 0").select("key", "value").union(late).groupBy("key").agg(F.sum("value").alias("value"))
    )
    n_words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")
    rows = stored(
        docs.select("doc_id", F.xxhash64("doc_id", F.xxhash64("text"), F.lit(1)).alias("key"), n_words.alias("n_words")), "words-of-documents"
    )
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    return (
        rows.join(sums.join(copies, "key"), "key", "left")
        .select("doc_id", "n_words", F.coalesce(F.col("value") / F.col("copies"), F.lit(0.0)).alias("score"))
        .withColumn("mean", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")))
    )


ship(__name__)
