"""Benchmark decontamination against plain BM25 over all passages."""

import math
import re

import pytest

from lethe.llm import contamination, queries
from lethe.llm.frames import table
from tests.conftest import MEDIUM
from tests.llm.test_screening import documents

SPLIT = re.compile(r"""[\s!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]+""", re.ASCII)
ITEM = "item_id long, text string"


def words(text):
    return [w for w in SPLIT.split("".join(c.lower() if c.isascii() else c for c in text or "")) if w]


def plain_leaks(docs, items, threshold=contamination.THRESHOLD):
    items = [(i, t or "", words(t)) for i, t in items if words(t)]
    n, mean = len(items), sum(len(w) for _, _, w in items) / len(items)
    holders = {}
    for _, _, w in items:
        for t in set(w):
            holders[t] = holders.get(t, 0) + 1
    idf = {t: math.log1p((n - h + 0.5) / (h + 0.5)) for t, h in holders.items()}
    longest = max(len(w) for _, _, w in items)

    def impact(t, w):
        c = w.count(t)
        return idf[t] * c * 2.2 / (c + 1.2 * (1 - 0.75 + 0.75 * len(w) / mean))

    weights = []
    for i, text, w in items:
        raw = {t: impact(t, w) for t in set(w)}
        whole = sum(raw.values())
        size = min(5, len(w))
        body = text.rstrip(" \t\r\n.!?")
        cut = max(body.rfind(". "), body.rfind("? "), body.rfind("! "), body.rfind("\n")) + 1
        parts = [words(text[:cut]), words(text[cut:])]
        shingles = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
        weights.append((i, {t: x / whole for t, x in raw.items()}, shingles, size, parts))
    found = {}
    for doc, text in docs:
        all_words = words(text)
        starts = range(0, max(1, len(all_words) - longest), longest)
        for s in starts:
            passage = all_words[s : s + 2 * longest]
            held = set(passage)
            for i, weight, shingles, size, parts in weights:
                score = sum(x for t, x in weight.items() if t in held)
                if score < threshold:
                    continue
                own = {tuple(passage[k : k + size]) for k in range(len(passage) - size + 1)}
                shared = len(shingles & own) / len(shingles)
                if shared < 0.8 or any(p and sum(t in held for t in p) / len(p) < 0.5 for p in parts):
                    continue
                found[doc, i] = max(score, found.get((doc, i), 0))
    return {k: round(v, 6) for k, v in found.items()}


def test_leaks_equal_plain_search(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, MEDIUM, "documents").collect()]
    items = [tuple(r) for r in table(spark, MEDIUM, "benchmark").select("item_id", "text").collect()]
    expected = plain_leaks(docs, items)
    found = queries.op7_benchmark_decontamination(spark, MEDIUM).collect()
    assert expected and {(r["doc_id"], r["item_id"]) for r in found} == set(expected)
    assert all(abs(r["score"] - expected[r["doc_id"], r["item_id"]]) < 1e-5 for r in found)


@pytest.mark.parametrize("items", [20_000, 3])
def test_leaks_in_hard_cases(spark, items):
    question = "What is the name of the river that runs through the old town of Exampleton? The Exe"
    bench = [(1, question), (2, "short one"), (3, None), (4, " ... "), (5, question), (6, "zeta eta theta iota kappa lambda mu nu")]
    filler = " ".join(f"word{i % 977}" for i in range(20_000))
    docs = [
        (100, f"{filler} {question.upper()} {filler}"),
        (101, question.replace("river", "stream")),
        (102, "The Exe runs"),
        (103, "a short\tone, b"),
        (104, None), (105, ""), (103, "a short one"),
        (None, "zeta eta theta iota kappa lambda mu nu"),
        (106, "nu mu lambda kappa iota theta eta zeta"),
    ]
    rows = [(i, t, "en", "s", 1) for i, t in docs]
    found = contamination.find_leaks(documents(spark, rows), spark.createDataFrame(bench, ITEM), items=items).collect()
    got = sorted(((r["doc_id"], r["item_id"]) for r in found), key=repr)
    assert got == sorted([(100, 1), (100, 5), (103, 2), (103, 2), (None, 6)], key=repr)
    flags = documents(spark, rows)
    kept = flags.where(~contamination.leaks(spark.createDataFrame(bench, ITEM), flags["text"], items=items)).collect()
    assert sorted(r["doc_id"] for r in kept) == [101, 102, 104, 105, 106]


def test_scores_do_not_depend_on_blocks(spark):
    bench = [(i, f"Which of the towns number{i} has a bridge over the river name{i % 3}? It is town{i} " + "of the north " * (i % 4)) for i in range(10)]
    bench += [(10, "alone and short"), (3, bench[3][1]), (11, None), (12, " . ")]
    docs = [(100 + i, f"intro {t} outro") for i, t in bench] + [(200, " and ".join(t or "" for _, t in bench))]
    docs += [(300 + i, (t or "").replace("bridge", "ford").replace("north", "south")) for i, t in bench]
    expected = plain_leaks(docs, bench)
    for items in (20_000, 3, 1):
        leaks = contamination.find_leaks(documents(spark, [(i, t, "en", "s", 1) for i, t in docs]), spark.createDataFrame(bench, ITEM), items=items)
        found = {(r["doc_id"], r["item_id"]): r["score"] for r in leaks.collect()}
        assert found.keys() == expected.keys()
        assert all(found[k] == pytest.approx(v, abs=1e-6) for k, v in expected.items())


def test_leaks_of_empty_tables(spark):
    none, some = spark.createDataFrame([], ITEM), spark.createDataFrame([(1, "a b c")], ITEM)
    assert contamination.find_leaks(documents(spark), none).collect() == []
    assert contamination.find_leaks(documents(spark, []), some).collect() == []
    assert documents(spark).where(~contamination.leaks(none, documents(spark)["text"])).count() == documents(spark).count()
