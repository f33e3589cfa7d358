"""SimHash near-duplicates: fingerprints, a binary trie self-join, components.

*Fingerprint*: words of the text with A-Z in lower case, ``shingle`` words to a shingle, repeats
included; a bit is 1 if it is set in over half of the shingles' hashes (XXH64, seed 42).

*Trie self-join*: pairs of different fingerprints with at most ``budget`` differing bits. Among
``budget + 1`` blocks of bits at least one is equal in such a pair. For each block there is a binary
trie over the fingerprints turned so that this block comes first; there the walk starts with
the pairs (node, same node) below the block and no error spent. Pairs of nodes are walked together,
a few levels at a time: children are paired, their differing bits are added to the errors, and
pairs over the budget are pruned. A pair of nodes that both hold few fingerprints is settled by
comparing these; larger ones are walked further, at the end to single fingerprints. So no node,
however many fingerprints share it, is compared as a whole. A pair with several equal blocks is
reported by the first of them only.

*Components*: by alternating large-star and small-star steps over the links, each step written to
the shared folder. Copies share a fingerprint, so a group of copies is one vertex.

Defined cases: null and empty texts, and texts without words, have fingerprint zero and link like
any other; texts with fewer words than a shingle are one shingle; ``component_id`` is the least id in
reach, nulls aside (null if the component has null ids only); repeated rows are kept; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.llm.frames import SPACE, numbered, pick, row_key, ship, stored

SHINGLE, BUDGET = 3, 3
#: Fingerprints in a node that are compared directly.
LEAF = 1024
LEVELS = 4
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def shingle_hashes(words: str, size: int) -> Column:
    def hashed(i: Column) -> Column:
        return F.xxhash64(F.concat_ws(" ", *[F.get(words, i + k) for k in range(size)]))

    return (
        F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), hashed))
        .when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " "))))
        .otherwise(F.array().cast("array<long>"))
    )


def majority_bits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    block, weights = 1 << 15, np.uint64(1) << np.arange(64, dtype=np.uint64)
    for hashes in batches:
        out = np.zeros(len(hashes), dtype=np.uint64)
        for row, values in enumerate(hashes):
            values = np.ascontiguousarray(values, dtype=np.int64)
            counts = np.zeros(64, dtype=np.int64)
            for i in range(0, len(values), block):
                part = values[i : i + block].view(np.uint8).reshape(-1, 8)
                counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[row] = weights[2 * counts > len(values)].sum(dtype=np.uint64)
        yield pd.Series(out.view(np.int64))


def fingerprints(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fingerprint as a signed number) for each row of (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        pick(df, "doc_id", "text")
        .select("doc_id", F.xxhash64(text).alias("text_hash"), F.split(lower_ascii(text), SPACE).alias("__split"))
        .select("doc_id", "text_hash", F.filter("__split", lambda w: w != "").alias("__words"))
        .select("doc_id", "text_hash", shingle_hashes("__words", shingle).alias("__hashes"))
        .select("doc_id", "text_hash", F.pandas_udf(majority_bits, "long")("__hashes").alias("fingerprint"))
    )


# --- trie ------------------------------------------------------------------------------------


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit from the left, bits) of budget + 1 blocks."""
    cuts = [64 * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _prefix(turned: Column, depth: Column) -> Column:
    return F.call_function("shiftrightunsigned", turned, (F.lit(64) - depth).cast("int"))


def trie_links(fps: DataFrame, budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """(a, b) with a < b: pairs of the different values of ``fps.fingerprint`` within the budget."""
    blocks = _blocks(budget)
    turned = [
        F.struct(
            F.lit(i).alias("trie"),
            F.shiftleft("fingerprint", at).bitwiseOR(F.shiftrightunsigned("fingerprint", (64 - at) % 64)).alias("turned"),
            F.lit(size).alias("depth"),
        )
        for i, (at, size) in enumerate(blocks)
    ]
    members = fps.select("fingerprint", F.explode(F.array(*turned)).alias("t")).select(
        "fingerprint", "t.*", _prefix(F.col("t.turned"), F.col("t.depth")).alias("node")
    )
    sizes = members.groupBy("trie", "depth", "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    walk = stored(
        sizes.select("trie", "depth", F.col("node").alias("p"), F.col("node").alias("q"), F.lit(0).alias("errors"),
                     F.col("n").alias("np"), F.col("n").alias("nq")),
        "trie-pairs",
    )
    found = []
    while True:
        few = (F.col("np") <= leaf) & (F.col("nq") <= leaf) | (F.col("depth") >= 64)
        found.append(_settled(members, walk.where(few), blocks, budget))
        large = walk.where(~few)
        if large.isEmpty():
            break
        members, walk = _walked(members, large, budget)
    return reduce(DataFrame.unionByName, found)


def _settled(members: DataFrame, pairs: DataFrame, blocks: list[tuple[int, int]], budget: int) -> DataFrame:
    """Compares the fingerprints of paired small nodes."""
    at = ["trie", "depth"]
    left = members.select(*at, F.col("node").alias("p"), F.col("fingerprint").alias("x"))
    right = members.select(*at, F.col("node").alias("q"), F.col("fingerprint").alias("y"))
    differ = F.col("x").bitwiseXOR(F.col("y"))
    first = F.lit(True)  # all earlier blocks differ
    for i, (start, size) in enumerate(blocks):
        signed = ((1 << size) - 1) << (64 - start - size)
        mask = F.lit(signed - (1 << 64) if signed >= 1 << 63 else signed)
        first = first & ((F.col("trie") <= i) | (differ.bitwiseAND(mask) != 0))
    same = F.col("p") == F.col("q")
    return (
        pairs.select(*at, "p", "q")
        .join(left, [*at, "p"])
        .join(right, [*at, "q"])
        .where((~same | (F.col("x") < F.col("y"))) & (F.bit_count(differ) <= budget) & first)
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )


def _walked(members: DataFrame, large: DataFrame, budget: int) -> tuple[DataFrame, DataFrame]:
    """The next levels below large pairs: their members and the pairs of children in the budget."""
    at = ["trie", "depth"]
    open_nodes = large.select(*at, F.col("p").alias("node")).union(large.select(*at, F.col("q").alias("node")))
    deeper = F.least(F.col("depth") + LEVELS, F.lit(64))
    below = stored(
        members.join(open_nodes.distinct(), [*at, "node"], "left_semi")
        .withColumn("parent", F.col("node"))
        .withColumn("up", F.col("depth"))
        .withColumn("depth", deeper)
        .withColumn("node", _prefix(F.col("turned"), F.col("depth"))),
        "trie-members",
    )
    children = below.groupBy("trie", "up", "depth", "parent", "node").agg(F.count(F.lit(1)).alias("n"))

    def side(node: str, parent: str, count: str) -> DataFrame:
        return children.select(
            "trie", F.col("up").alias("__up"), F.col("depth").alias("__depth"),
            F.col("parent").alias(parent), F.col("node").alias(node), F.col("n").alias(count),
        )

    pairs = (
        large.select("trie", F.col("depth").alias("__up"), "p", "q", "errors")
        .join(side("a", "p", "np"), ["trie", "__up", "p"])
        .join(side("b", "q", "nq").drop("__depth"), ["trie", "__up", "q"])
        .where((F.col("p") != F.col("q")) | (F.col("a") <= F.col("b")))
    )
    # a prefix holds the whole way down, so its differing bits are the errors added up
    walk = stored(
        pairs.withColumn("errors", F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))
        .where(F.col("errors") <= budget)
        .where((F.col("a") != F.col("b")) | (F.col("np") > 1))
        .select("trie", F.col("__depth").alias("depth"), F.col("a").alias("p"), F.col("b").alias("q"), "errors", "np", "nq"),
        "trie-pairs",
    )
    return below.drop("parent", "up"), walk


# --- components ------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(vertex, root): the least vertex in reach, for every vertex of ``links`` (a, b)."""
    edges = stored(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("v > m").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.least(F.min("m"), F.col("v")).alias("r"))
        large = both.join(least, "v").where("m > v").select(F.col("m").alias("v"), F.col("r").alias("m")).distinct()
        least = large.groupBy("v").agg(F.min("m").alias("r"))
        small = large.join(least, "v")
        moved = small.where("m > r").select(F.col("m").alias("v"), F.col("r").alias("m"))
        edges = stored(moved.union(least.select("v", F.col("r").alias("m"))).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("v").alias("vertex"), F.col("m").alias("root"))
    return stars.union(edges.select(F.col("m").alias("vertex"), F.col("m").alias("root")).distinct())


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """(doc_id, text_hash, fingerprint, root, component_id) for each row of (doc_id, text)."""
    docs = stored(fingerprints(df, shingle), "fingerprints")
    fps = stored(docs.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "fingerprint-values")
    roots = stored(components(trie_links(fps, budget)), "roots")
    ids = (
        fps.join(roots.withColumnRenamed("vertex", "fingerprint"), "fingerprint")
        .groupBy("root")
        .agg(F.min("least_id").alias("component_id"))
    )
    linked = roots.join(ids, "root").withColumnRenamed("vertex", "fingerprint")
    named = stored(
        fps.join(linked.withColumn("__linked", F.lit(True)), "fingerprint", "left").select(
            "fingerprint",
            F.coalesce("root", "fingerprint").alias("root"),
            F.when(F.col("__linked"), F.col("component_id")).otherwise(F.col("least_id")).alias("component_id"),
        ),
        "fingerprint-components",
    )
    return docs.join(named, "fingerprint").select("doc_id", "text_hash", "fingerprint", "root", "component_id")


def keep_one_of_each(df: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """One row, with all columns, of each component: that with the least id (nulls last)."""
    found = near_duplicates(df, shingle, budget)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    first = found.groupBy("root").agg(least.alias("c"))
    key = F.concat_ws(":", F.coalesce(F.col("c.doc_id").cast("string"), F.lit("null")), F.col("c.text_hash"))
    rows, names = numbered(df)
    text = F.coalesce(F.col(names["text"]).cast("string"), F.lit(""))
    keyed = rows.withColumn("__key", row_key(F.col(names["doc_id"]), text))
    kept = keyed.join(first.select(key.alias("__key")), "__key", "left_semi").dropDuplicates(["__key"])
    return kept.select(*rows.columns).toDF(*df.columns)


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


ship(__name__)
