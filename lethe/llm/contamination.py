"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max bounds.

Every passage of every document is a query. Passages are windows of twice the longest item's
words, at half that distance, so every item that a document holds lies wholly in some passage. Terms
are words in lower case (A-Z), parted at white space and ASCII punctuation.

*Scores.* BM25 with the item as the document and each different term of the passage counted once,
divided by what the item scores against itself: from 0 to 1. A pair is retrieved if its score is
``threshold`` or more. Retrieval skips as block-max WAND does, for many passages at once and
without losing any pair over the threshold:

1. terms' greatest impacts, summed over a passage, bound all items: lower passages are skipped;
2. items lie in blocks; terms' greatest impacts in a block bound its items: lower blocks are skipped;
3. only the items of the blocks that are left get full scores.

*Verification.* Of the item's 5-word shingles, 0.8 or more must stand in the passage, and at least half of
the words of its question and of its answer (the last sentence; the rest is the question).

The index is made of a block of items of bounded size (``ITEMS``, ``ITEM_BYTES``) and sent to all tasks; a larger
benchmark takes several passes over the documents. Documents are not shuffled. Number of items, holders of
each term, mean and greatest length are those of the whole benchmark, so results do not depend on the blocks.

Defined cases: null texts are empty and match nothing; items without a word match nothing; items shorter
than a shingle are one shingle; equal items match alike; repeated rows are reported each; an empty
benchmark or table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.llm.frames import numbered, pick, ship, stored
from lethe.llm.words import separators, sliced, words_of

THRESHOLD = 0.6
SHINGLE, LEAST_SHARED, LEAST_PART = 5, 0.8, 0.5
K1, B = 1.2, 0.75
#: Bounds of an index: what is sent to the tasks at once.
ITEMS, ITEM_BYTES = 20_000, 16 << 20
BLOCK = 8  # items
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FOUND = "array<struct<item_id:long,score:double,shared:double,question:double,answer:double,first_word:long>>"


def _terms(texts: pa.Array):
    """(first row, words) of slices of the texts."""
    table = separators(_PUNCTUATION)
    for row, offsets, data in sliced(texts):
        yield row, words_of(offsets, data, table, lower=True)


def _parts(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence or line is the answer."""
    body = text.rstrip(" \t\r\n.!?")
    cut = max(body.rfind(". "), body.rfind("? "), body.rfind("! "), body.rfind("\n")) + 1
    return text[:cut], text[cut:]


def _shingles(words: np.ndarray, size: int) -> set[tuple]:
    words = words.tolist()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


@dataclass
class Index:
    """Postings in compressed rows: by term over blocks, and by term over items."""

    item_ids: list
    words: list  # of each item
    parts: list  # (question, answer) words of each item
    terms: np.ndarray  # sorted hashes
    greatest: np.ndarray  # greatest impact of each term
    block_at: np.ndarray
    blocks: np.ndarray
    block_most: np.ndarray
    item_at: np.ndarray
    items: np.ndarray
    impact: np.ndarray
    longest: int


@dataclass
class Whole:
    """Of the whole benchmark, whatever block an item is in."""

    items: int  # that have a word
    mean: float  # words
    longest: int


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (row, number of words, sorted different terms); texts without a word are left out."""
    for batch in batches:
        keys, sizes, terms = [], [], []
        for row, w in _terms(batch.column(1)):
            for k in np.flatnonzero(np.diff(w.first)):
                keys.append(batch.column(0)[row + int(k)].as_py())
                sizes.append(int(w.first[k + 1] - w.first[k]))
                terms.append(np.unique(w.hash[w.first[k] : w.first[k + 1]]).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int64()))], names=["key", "size", "terms"]
        )


def with_holders(benchmark: DataFrame) -> tuple[DataFrame, Whole]:
    """(item_id, text, terms, holders): how many items of the benchmark hold each term of an item."""
    rows = stored(pick(benchmark, "item_id", "text").withColumn("key", F.xxhash64("item_id", F.xxhash64("text"))), "benchmark-items")
    counted = stored(rows.select("key", "text").mapInArrow(count_terms, "key long, size long, terms array<long>"), "benchmark-terms")
    n, mean, longest = counted.agg(F.count(F.lit(1)), F.avg("size"), F.max("size")).first()
    exploded = counted.select("key", F.explode("terms").alias("term"))
    held = exploded.groupBy("term").agg(F.count(F.lit(1)).alias("holders"))
    of_item = (
        exploded.distinct()
        .join(held, "term")
        .groupBy("key")
        .agg(F.collect_list(F.struct("term", "holders")).alias("found"))
        .select("key", F.col("found.term").alias("terms"), F.col("found.holders").alias("holders"))
    )
    return rows.join(of_item, "key").select("item_id", "text", "terms", "holders"), Whole(n, mean or 0.0, longest or 0)


def build_index(rows: list[tuple], whole: Whole) -> Index | None:
    """From (item_id, text, terms, holders) rows; None if no item has a word."""

    def words(texts: list[str]) -> list[np.ndarray]:
        out = []
        for _, w in _terms(pa.array(texts, pa.string())):
            out += [w.hash[a:b] for a, b in zip(w.first, w.first[1:])]
        return out

    known, at = np.unique(np.concatenate([np.array(r[2], dtype=np.int64).view(np.uint64) for r in rows]), return_index=True)
    holders = np.concatenate([np.array(r[3], dtype=np.int64) for r in rows])[at]
    rows = [(r[0], r[1] or "") for r in rows]
    all_words = words([t for _, t in rows])
    rows = [r for r, w in zip(rows, all_words) if len(w)]
    all_words = [w for w in all_words if len(w)]
    if not rows:
        return None
    parts = [_parts(t) for _, t in rows]
    questions, answers = words([q for q, _ in parts]), words([a for _, a in parts])
    length = np.array([len(w) for w in all_words], dtype=np.float64)
    unique = [np.unique(w, return_counts=True) for w in all_words]
    term = np.concatenate([u for u, _ in unique])
    count = np.concatenate([c for _, c in unique]).astype(np.float64)
    item = np.repeat(np.arange(len(rows)), [len(u) for u, _ in unique])
    terms, term = np.unique(term, return_inverse=True)
    holders = holders[np.searchsorted(known, terms)]
    idf = np.log1p((whole.items - holders + 0.5) / (holders + 0.5))
    impact = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * length[item] / whole.mean))
    impact /= np.bincount(item, impact)[item]
    order = np.lexsort((item, term))
    term, item, impact = term[order], item[order], impact[order]
    item_at = np.searchsorted(term, np.arange(len(terms) + 1))
    greatest = np.maximum.reduceat(impact, item_at[:-1])
    block_key = term * (len(rows) // BLOCK + 1) + item // BLOCK
    begin = np.flatnonzero(np.append(True, block_key[1:] != block_key[:-1]))
    return Index(
        [i for i, _ in rows], all_words, list(zip(questions, answers)), terms, greatest,
        np.searchsorted(term[begin], np.arange(len(terms) + 1)), item[begin] // BLOCK, np.maximum.reduceat(impact, begin),
        item_at, item, impact, whole.longest,
    )


def _spread(at: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows ``chosen`` of a compressed table: (which of them, place) of each entry."""
    size = at[chosen + 1] - at[chosen]
    which = np.repeat(np.arange(len(chosen)), size)
    begin = np.cumsum(size) - size
    return which, np.arange(len(which)) - begin[which] + at[chosen][which]


_CLOSE = 1e-9  # sums may differ in the last digits; bounds must not lose a pair for it


def retrieve(index: Index, words: np.ndarray, first: np.ndarray, threshold: float) -> list[tuple]:
    """(text, start, end, item, score) of all passages and items with the threshold or more."""
    step = index.longest
    place = np.searchsorted(index.terms, words)
    place[place == len(index.terms)] = 0
    known = index.terms[place] == words
    bound = np.where(known, index.greatest[place], 0.0)
    total = np.append(0.0, np.cumsum(bound))
    lengths = np.diff(first)
    windows = np.maximum(1, -(-(lengths - step) // step))  # the last one reaches the end
    windows[lengths == 0] = 0
    text = np.repeat(np.arange(len(lengths)), windows)
    number = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = first[text] + number * step
    end = np.minimum(start + 2 * step, first[text + 1])
    open_ = np.flatnonzero(total[end] - total[start] >= threshold - _CLOSE)
    found = []
    for i in range(0, len(open_), 4096):  # bounds what is held at once
        some = open_[i : i + 4096]
        which, at = _ranges(start[some], end[some])
        keep = known[at]
        pair = np.unique(which[keep] * len(index.terms) + place[at[keep]])
        which, term = pair // len(index.terms), pair % len(index.terms)
        most = np.bincount(which, index.greatest[term], len(some))
        keep = most[which] >= threshold - _CLOSE
        which, term = which[keep], term[keep]
        blocks = len(index.item_ids) // BLOCK + 1
        entry, at = _spread(index.block_at, term)
        key, inverse = np.unique(which[entry] * blocks + index.blocks[at], return_inverse=True)
        left = key[np.bincount(inverse, index.block_most[at], len(key)) >= threshold - _CLOSE]
        if not len(left):
            continue
        entry, at = _spread(index.item_at, term)
        item = index.items[at]
        spot = np.searchsorted(left, which[entry] * blocks + item // BLOCK)
        spot[spot == len(left)] = 0
        keep = left[spot] == which[entry] * blocks + item // BLOCK
        key, inverse = np.unique((which[entry] * len(index.item_ids) + item)[keep], return_inverse=True)
        score = np.bincount(inverse, index.impact[at[keep]], len(key))
        for k, s in zip(key[score >= threshold - _CLOSE], score[score >= threshold - _CLOSE]):
            w = some[k // len(index.item_ids)]
            found.append((int(text[w]), int(start[w]), int(end[w]), int(k % len(index.item_ids)), float(s)))
    return found


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = end - start
    which = np.repeat(np.arange(len(start)), size)
    return which, np.arange(len(which)) - (np.cumsum(size) - size)[which] + start[which]


def verified(index: Index, item: int, passage: np.ndarray) -> tuple[float, float, float] | None:
    """(shingles shared, question shared, answer shared), or None if it is not enough."""
    own = _shingles(index.words[item], SHINGLE)
    size = min(SHINGLE, len(index.words[item]))
    shared = len(own & _shingles(passage, size)) / len(own)
    held = set(passage.tolist())
    question, answer = (
        sum(w in held for w in part.tolist()) / len(part) if len(part) else 1.0 for part in index.parts[item]
    )
    if shared < LEAST_SHARED or min(question, answer) < LEAST_PART:
        return None
    return shared, question, answer


def matcher(index, threshold: float):
    """A function of batches of texts; ``index`` is a broadcast variable."""

    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ix: Index = index.value
        for texts in batches:
            out: list[list[dict]] = [[] for _ in range(len(texts))]
            for row, w in _terms(pa.Array.from_pandas(texts, type=pa.string())):
                best: dict[tuple[int, int], dict] = {}
                for text, start, end, item, score in retrieve(ix, w.hash, w.first, threshold):
                    checked = verified(ix, item, w.hash[start:end])
                    key = (text, item)
                    if checked and (key not in best or best[key]["score"] < score):
                        names = ("shared", "question", "answer")
                        values = {"item_id": ix.item_ids[item], "score": score, "first_word": start - int(w.first[text])}
                        best[key] = values | dict(zip(names, checked))
                for (text, _), values in sorted(best.items()):
                    out[row + text].append(values)
            yield pd.Series(out)

    return matches


def _indexes(benchmark: DataFrame, items: int, item_bytes: int) -> Iterator[Index]:
    found, whole = with_holders(benchmark)
    rows, held = [], 0
    for r in found.orderBy("item_id", "text").toLocalIterator():
        size = len(r["text"] or "")
        if rows and (len(rows) >= items or held + size > item_bytes):
            if index := build_index(rows, whole):
                yield index
            rows, held = [], 0
        rows.append((r["item_id"], r["text"], r["terms"], r["holders"]))
        held += size
    if rows and (index := build_index(rows, whole)):
        yield index


def match_columns(
    benchmark: DataFrame, threshold: float = THRESHOLD, items: int = ITEMS, item_bytes: int = ITEM_BYTES
) -> list:
    """For each block of the benchmark a function from a text column to its matches."""
    context = benchmark.sparkSession.sparkContext
    return [
        F.pandas_udf(matcher(context.broadcast(index), threshold), FOUND)
        for index in _indexes(benchmark, items, item_bytes)
    ]


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, **bounds: int) -> DataFrame:
    """(doc_id, item_id, score, shared, question, answer, first_word): documents that hold items."""
    texts = pick(docs, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = [
        texts.select("doc_id", F.inline(matches("text"))) for matches in match_columns(benchmark, threshold, **bounds)
    ]
    if not found:
        return docs.sparkSession.createDataFrame([], texts.select("doc_id", F.inline(F.lit(None).cast(FOUND))).schema)
    return reduce(DataFrame.union, found)


def leaks(benchmark: DataFrame, text: Column, threshold: float = THRESHOLD, **bounds: int) -> Column:
    """Whether a text holds an item."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    found = [F.size(matches(text)) > 0 for matches in match_columns(benchmark, threshold, **bounds)]
    return reduce(lambda a, b: a | b, found, F.lit(False))


def keep_clean(df: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, **bounds: int) -> DataFrame:
    """The rows of ``df`` (with all columns) that hold no item."""
    rows, names = numbered(df)
    found = leaks(benchmark, F.col(names["text"]), threshold, **bounds)
    return rows.where(~found).toDF(*df.columns)


ship(__name__)
