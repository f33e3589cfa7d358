"""Stupid-backoff scores against plain counts."""

import math
import re
from collections import Counter

import pytest

from lethe.llm import ngram_lm, queries
from lethe.llm.frames import table
from tests.conftest import MEDIUM
from tests.llm.test_screening import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_scores(docs, backoff=0.4, least=1):
    split = [WORD.findall(t or "") for _, t in docs]
    one, two = Counter(), Counter()
    for w in split:
        one.update(w)
        two.update(zip(w, w[1:]))
    total, out = sum(one.values()), []
    for (i, _), words in zip(docs, split):
        score = 0.0
        for k, v in enumerate(words):
            if k and two[words[k - 1], v] >= least:
                score += math.log(two[words[k - 1], v] / one[words[k - 1]])
            else:
                score += math.log(backoff * one[v] / total)
        out.append((i, len(words), score))
    return out


def same(found, expected):
    got = sorted(((r["doc_id"], r["n_words"], r["score"]) for r in found), key=repr)
    expected = sorted(expected, key=repr)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert all(g[2] == pytest.approx(e[2], abs=2e-3) for g, e in zip(got, expected))


def test_scores_equal_plain_counts(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, MEDIUM, "documents").collect()]
    same(queries.op10_lm_scoring(spark, MEDIUM).collect(), plain_scores(docs))


@pytest.mark.parametrize(
    "frequent,hot,bucket,least", [(1 << 20, 4_096, 1_000_000, 1), (50, 20, 100, 2), (4, 2, 1000, 1), (65_536, 30, 7, 2)]
)
def test_scores_in_hard_cases(spark, frequent, hot, bucket, least):
    texts = ["a b a b a b c", "", None, "  x ", "a b " * 500, "one", "one two one two", "é\x0bé é", "a b a b a b c"]
    rows = [(i % 8, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, "a b q", "en", "s", 1)] * 2
    rows.append((0, "a b a b a b c", "en", "s", 1))
    found = ngram_lm.score(documents(spark, rows), least=least, frequent=frequent, hot=hot, bucket=bucket).collect()
    same(found, plain_scores([r[:2] for r in rows], least=least))
    assert all((r["mean"] is None) == (r["n_words"] == 0) for r in found)


def test_scores_of_an_empty_table(spark):
    assert ngram_lm.score(documents(spark, [])).collect() == []
