"""Repeated byte strings against a plain search for equal windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lethe.llm import queries, repeats
from lethe.llm.frames import table
from tests.conftest import MEDIUM
from tests.llm.test_screening import documents


def plain_repeats(docs, length=200):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_equal_plain_search(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, MEDIUM, "documents").where("n_chars < 6000").collect()]
    rows = [(i, t, "en", "s", 1) for i, t in docs]
    found = repeats.remove_repeats(documents(spark, rows)).drop("copies").collect()
    expected = plain_repeats(docs)
    assert any(e[2] for e in expected)
    assert sorted(map(tuple, found)) == sorted(expected)


@pytest.mark.parametrize("most", [4096, 3])
def test_repeats_in_hard_cases(spark, most):
    rng = random.Random(most)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    common, long = prose(25)[:150], prose(60)[:260]
    texts = [f"{prose(40)}{common}{prose(40)}" for _ in range(12)]
    texts += [f"{prose(30)}{long}{prose(30)}" for _ in range(6)] + [long[:200], long[1:201], long[:199]]
    texts += ["a" * 450, "ab" * 150, None, "", "é" * 120, texts[0], f"{long}x{long}", prose(3000)]
    texts += [long[:100] + "!" + long[101:], long + long[::-1], "x" * 199]
    docs = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    rows = [(i, t, "en", "s", 1) for i, t in docs]
    found = repeats.remove_repeats(documents(spark, rows), most=most).drop("copies").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain_repeats(docs), key=repr)


@pytest.mark.parametrize("shard", [10, 700, 1 << 17])
def test_merged_transforms_find_equal_windows(shard):
    rng = np.random.default_rng(shard)
    base = rng.integers(97, 100, 900).astype(np.uint8)
    parts = [base[a : a + n].tobytes() for a, n in zip(rng.integers(0, 500, 30), rng.integers(200, 400, 30))]
    parts += [bytes(97 for _ in range(300)), rng.integers(97, 123, 350).astype(np.uint8).tobytes()]
    size = np.array([len(p) for p in parts])
    seg, at = repeats.merged_repeats(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size, 200, shard)
    seen = Counter(p[i : i + 200] for p in parts for i in range(len(p) - 199))
    expected = {(s, i) for s, p in enumerate(parts) for i in range(len(p) - 199) if seen[p[i : i + 200]] > 1}
    assert set(zip(seg.tolist(), at.tolist())) == expected


def test_grams_and_very_long_texts(monkeypatch):
    data = np.frombuffer(bytes(random.Random(1).choices(b"abc", k=3000)), np.uint8)
    for k in (1, 7, 32, 100, 200):
        grams = repeats.gram_hashes(data, k)
        names = [data[i : i + k].tobytes() for i in range(len(data) - k + 1)]
        assert len(grams) == len(names) and len(set(zip(grams.tolist(), names))) == len(set(names)) == len(set(grams.tolist()))
    whole = repeats.segments(np.array([0, 3000]), data, 32, 200)
    monkeypatch.setattr(repeats, "_PLACE_BITS", 9)
    cut = repeats.segments(np.array([0, 3000]), data, 32, 200)
    assert sum(whole[2]) == sum(cut[2]) == 2801


def test_repeats_of_an_empty_table(spark):
    assert repeats.remove_repeats(documents(spark, [])).collect() == []
    assert queries.op5_suffix_array_dedup
