"""MinHash near-duplicates against all pairs of full sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from lethe.llm import minhash, queries
from lethe.llm.frames import table
from tests.conftest import MEDIUM, SMALL
from tests.llm.test_screening import documents

LOWER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, size=2):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_links(sets, percent=80):
    """Pairs of places in ``sets``, by counts of what they share."""
    holders, shared = defaultdict(list), defaultdict(int)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for held in holders.values():
        for k, i in enumerate(held):
            for j in held[:k]:
                shared[j, i] += 1
    return {(i, j) for (i, j), n in shared.items() if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)}


def plain_report(docs, percent=80):
    sets = [plain_set(t) for _, t in docs]
    unique = sorted({s for s in sets if s}, key=sorted)
    at = {s: k for k, s in enumerate(unique)}
    root = list(range(len(unique)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in plain_links(unique, percent):
        root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for (i, _), s in zip(docs, sets):
        if s and i is not None:
            least[find(at[s])] = min(i, least.get(find(at[s]), i))
    out = []
    for (i, _), s in zip(docs, sets):
        component = least.get(find(at[s])) if s else i
        out.append((i, len(s), component, i == component))
    return out


def same(found, docs, percent=80):
    assert sorted(map(tuple, found), key=repr) == sorted(plain_report(docs, percent), key=repr)


def test_near_duplicates_equal_plain(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, MEDIUM, "documents").collect()]
    same(queries.op13_minhash_near_dedup(spark, MEDIUM).collect(), docs)


def test_odd_documents(spark):
    df = documents(spark)
    clash = df.selectExpr("*", "1 as row", "2 as id", "3 as component", "4 as TEXT")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    same(minhash.near_duplicates(df).collect(), docs)
    same(minhash.near_duplicates(clash).collect(), docs)


def planted(seed, groups=12, copies=30):
    """Texts of some 100 words with copies that differ in 0 to 14 words, short ones, and a passage many share."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage, texts = rnd.choices(words, k=60), []
    for _ in range(groups):
        base = rnd.choices(words, k=rnd.randint(60, 140))
        for _ in range(rnd.randint(2, copies)):
            copy = list(base)
            for _ in range(rnd.choice((0, 1, 2, 4, 6, 9, 14))):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            texts.append(" ".join(copy))
    texts += [" ".join(rnd.choices(words, k=40) + passage) for _ in range(200)]
    texts += [" ".join(rnd.choices(words[:6], k=rnd.randint(0, 6))) for _ in range(120)]
    rnd.shuffle(texts)
    return [(i, t, "en", "s", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,partitions", [(1, 4), (2, 1), (3, 30)])
def test_planted_copies(spark, seed, partitions):
    rows = planted(seed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = minhash.near_duplicates(documents(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    same(found, [r[:2] for r in rows])


def test_recall_of_the_forest(spark):
    """Candidates of all orders hold at least 0.999 of all links, also just at the limit."""
    rnd = random.Random(8)
    rows, expected = [], 0
    for g in range(400):
        base = [f"g{g}x{i}" for i in range(100)]
        rows += [(2 * g, " ".join(base), "en", "s", 1), (2 * g + 1, " ".join(base[:80] + base[91:]), "en", "s", 1)]
    sets = minhash.shingle_sets(documents(spark, rows)).selectExpr("row id", "n_shingles n", "signature", "row component")
    pairs = minhash.forest_pairs(sets).count()
    expected = len(plain_links([plain_set(r[1]) for r in rows]))
    assert expected == 400 and pairs >= 0.999 * expected


def test_regions_wider_than_the_window(spark):
    """A group of copies, much larger than the window, that no pivot links at once."""
    rnd = random.Random(4)
    words, text, rows = [f"w{i}" for i in range(900)], rnd.choices(range(900), k=120), []
    for i in range(400):  # a slow drift: only near ones are similar
        text[rnd.randrange(120)] = rnd.randrange(900)
        rows.append((i, " ".join(words[w] for w in text), "en", "s", 1))
    rnd.shuffle(rows)
    same(minhash.near_duplicates(documents(spark, rows), window=8).collect(), [r[:2] for r in rows])


def test_no_rows_and_no_words(spark):
    assert minhash.near_duplicates(documents(spark, [])).collect() == []
    rows = [(3, None, "en", "s", 1), (4, "", "en", "s", 1), (None, " \n", "en", "s", 1), (5, "One", "en", "s", 1), (2, "one", "en", "s", 1)]
    same(minhash.near_duplicates(documents(spark, rows)).collect(), [r[:2] for r in rows])


def test_packed_hashes_keep_their_order():
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64))
    again = minhash._unpacked(minhash._packed(hashes).tobytes())
    assert (again.astype(np.uint64) == hashes >> np.uint64(16) << np.uint64(16)).all()
