"""Near-duplicates by SimHash, lines by edit distance, repeated byte strings, against plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lethe.llm import queries, simhash
from lethe.llm.frames import table
from tests.conftest import MEDIUM, SMALL
from tests.llm.test_screening import DOCS, ODD, documents

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    if words and not shingles:
        shingles = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, budget):
    values = sorted(values)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    a = np.array(values, dtype=np.uint64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= budget):
            x, y = sorted((find(v), find(values[i + 1 + int(j)])))
            root[y] = x
    return {v: find(v) for v in values}


@pytest.mark.parametrize("rows", ["medium", "odd"])
def test_simhash_equals_plain(spark, rows):
    if rows == "medium":
        df, docs = None, [(r["doc_id"], r["text"]) for r in table(spark, MEDIUM, "documents").collect()]
        found = queries.op4_simhash_near_dedup(spark, MEDIUM).collect()
    else:
        df = documents(spark)
        docs = [(r["doc_id"], r["text"]) for r in df.collect()]
        found = simhash.near_duplicates(df).select(
            "doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id"
        ).collect()
    prints = [(i, plain_fingerprint(t or "")) for i, t in docs]
    roots = plain_components({p for _, p in prints}, 3)
    least = {}
    for i, p in prints:
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    expected = [(i, f"{p:016x}", least.get(roots[p])) for i, p in prints]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("leaf,budget", [(2, 3), (1024, 3), (3, 2)])
def test_trie_finds_all_links(spark, leaf, budget):
    random.seed(leaf)
    centres = [random.getrandbits(64) for _ in range(20)]
    values = {0, 2**64 - 1, *centres}
    for c in centres[:8]:
        for _ in range(40):
            values.add(c ^ sum(1 << b for b in random.sample(range(64), random.randint(1, 3))))
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.trie_links(spark.createDataFrame(signed, "fingerprint long"), budget, leaf).collect()
    expected = {
        tuple(sorted((x[0], y[0])))
        for i, x in enumerate(signed)
        for y in signed[:i]
        if ((x[0] ^ y[0]) & (2**64 - 1)).bit_count() <= budget
    }
    assert len(links) == len(expected) and {tuple(r) for r in links} == expected


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    pairs = [(order[i], order[i + 1]) for i in range(299)] + [(1000, 1001), (1001, 1000)]
    got = {r["vertex"]: r["root"] for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(300), 0) | {1000: 1000, 1001: 1000}


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
