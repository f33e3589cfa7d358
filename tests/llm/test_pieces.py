"""Sampled segmentations against a plain sampler and the library's decoder."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from lethe.llm import pieces, queries
from lethe.llm.frames import table
from lethe.llm.words import sliced
from tests.conftest import SMALL
from tests.llm.test_screening import documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")
V = pieces.load(MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
VOCABULARY = {t: i for i, t in enumerate(V.texts) if t and not (V.first_byte <= i < V.first_byte + 256)}


def units(text):
    text, out = " " + text if text else "", []
    for k, c in enumerate(text):
        if not out or c == "\n" or text[k - 1] == "\n" or (c == " " and text[k - 1] != " "):
            out.append("")
        out[-1] += c
    return out


def plain_unit(text, seed, number):
    data = text.encode()
    bounds = [len(text[:k].encode()) for k in range(len(text) + 1)]
    total, edges = {0: 0.0}, {}
    for j in bounds[1:]:
        into = []
        for i in reversed([b for b in bounds if b < j]):
            if data[i:j] in VOCABULARY:
                into.append((i, VOCABULARY[data[i:j]], V.weight[VOCABULARY[data[i:j]]]))
        i = bounds[bounds.index(j) - 1]
        if data[i:j] not in VOCABULARY:
            into.append((i, -1, V.weight[V.first_byte] * (j - i)))
        edges[j] = [(i, p, w + total[i]) for i, p, w in into]
        most = max(x for _, _, x in edges[j])
        total[j] = most + math.log(sum(math.exp(x - most) for _, _, x in edges[j]))
    ids, j, step = [], len(data), 0
    while j:
        u = float(pieces.uniform(np.array([seed], np.uint64), np.array([number]), step)[0])
        share = 0.0
        for i, p, x in edges[j]:
            share += math.exp(x - total[j])
            if u < share:
                break
        ids = ([p] if p >= 0 else [V.first_byte + b for b in data[i:j]]) + ids
        j, step = i, step + 1
    return ids


def plain_encode(text, key, seed=pieces.SEED):
    row = int(pieces.row_seeds(np.array([key], np.int64), seed)[0])
    return [i for n, u in enumerate(units(text)) for i in plain_unit(u, row, n)]


HARD = ["", " ", "\n", "  a  b\n\n c ", "▁ literal ▁▁", "é́ 😀😀 日本語 \x00 \t\r", "x" * 700, "  " * 40 + "\n \n", "a" * 3 + " " * 100 + "b"]


def test_pieces_equal_plain_sampling(spark):
    rows = [(i % 4 if i else None, t, "en", "s", 1) for i, t in enumerate(HARD)] + [(9, None, None, None, None)]
    rows += [(r["doc_id"], r["text"][:600], "en", "s", 1) for r in table(spark, SMALL, "documents").limit(20).collect()]
    rows += rows[:3]
    df = documents(spark, rows)
    keys = {r["doc_id"]: r["k"] for r in df.select("doc_id", F.xxhash64("doc_id").alias("k")).collect()}
    found = pieces.encode(df.repartition(3), MODEL).collect()
    assert all(r["lossless"] for r in found) and len(found) == len(rows)
    expected = [(r[0], len((r[1] or "").encode()), plain_encode(r[1] or "", keys[r[0]])) for r in rows]
    assert sorted(((r["doc_id"], r["n_bytes"], r["ids"]) for r in found), key=repr) == sorted(expected, key=repr)
    for (_, text, *_), (_, _, ids) in zip(rows, expected):
        assert LIBRARY.decode(ids) == (text or "")


def test_pieces_decode_to_the_texts(spark):
    df = documents(spark)
    back = pieces.encode(df, MODEL).select("doc_id", pieces.decode(F.col("ids"), MODEL).alias("text"))
    expected = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=repr)
    assert sorted(map(tuple, back.collect()), key=repr) == expected
    assert all(r["lossless"] for r in queries.op8_sentencepiece(spark, SMALL).collect())


def test_samples_follow_the_weights():
    word, n = " inthe", 20_000
    texts = pa.array([word[1:]] * n)
    (_, offsets, data), *_ = sliced(texts)
    at, ids = pieces.encode_slice(V, offsets, data, pieces.row_seeds(np.arange(n), 7))
    got = Counter(tuple(ids[a:b]) for a, b in zip(at, at[1:]))

    def ways(rest):
        if not rest:
            return {(): 0.0}
        return {
            (VOCABULARY[rest[:k]], *more): V.weight[VOCABULARY[rest[:k]]] + w
            for k in range(1, len(rest) + 1)
            if rest[:k] in VOCABULARY
            for more, w in ways(rest[k:]).items()
        }

    weights = {k: math.exp(w) for k, w in ways(word.encode()).items()}
    whole = sum(weights.values())
    for k, w in weights.items():
        p = w / whole
        assert abs(got[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_slices_do_not_change_the_samples(monkeypatch, spark):
    texts = pa.array([r["text"] for r in table(spark, SMALL, "documents").limit(50).collect()])
    seeds = pieces.row_seeds(np.arange(len(texts)), 1)

    def all_ids(most):
        out = []
        for row, offsets, data in sliced(texts, most):
            at, ids = pieces.encode_slice(V, offsets, data, seeds[row : row + len(offsets) - 1])
            out += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
        return out

    assert all_ids(1) == all_ids(5000) == all_ids(1 << 30)


def test_pieces_of_an_empty_table(spark):
    assert pieces.encode(documents(spark, []), MODEL).collect() == []
