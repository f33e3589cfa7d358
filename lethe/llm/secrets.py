"""Secret scan: sure secrets by pattern, weak ones only where complementary parts meet.

Sure kinds are ``assign``, ``access`` and ``hex``. Weak kinds prove nothing alone: an
``identifier`` (user=..., client_id: ...), a ``bare`` secret (a long random-looking word) and an
``endpoint`` (an address with a scheme). Every part is an interval of its text. Two parts are in
one scope if at most ``reach`` code points lie between them. An interval join of the parts of a
text finds what meets in a scope; then

* an identifier is reported if a secret (bare, assign or hex) is in its scope,
* a bare secret is reported if an identifier (or access key) is in its scope,
* an endpoint is reported if both an identifier and a secret are in its scope.

Defined cases: a null text is empty; equal rows get equal results; a null id is an id like any
other; an empty table gives no rows. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.llm.frames import pick, ship, stored

SURE = ("assign", "access", "hex")
WEAK = ("identifier", "bare", "endpoint")
KINDS = SURE + WEAK
REACH = 256
PARTS = "array<struct<kind:string,start:long,end:long>>"

# The patterns of the contract.
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
# The parts that count only together.
IDENTIFIER = re.compile(
    r"""(?i:\b(?:client_?id|user_?name|user|login|account(?:_?id)?|access_?key_?id|tenant))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
    re.ASCII,
)
BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\s\"'<>]+")
_WORDS = ("passw", "secret", "token", "apikey", "api_key")
_NAMES = ("client", "user", "login", "account", "access", "tenant")


def _random_looking(word: str) -> bool:
    return (
        any(c.isdigit() for c in word) and any(c.isupper() for c in word) and any(c.islower() for c in word)
    )


def parts_of(text: str) -> list[tuple[str, int, int]]:
    """All parts of a text. The substring checks only spare texts that cannot match."""
    found: list[tuple[str, int, int]] = []
    assigned = ":" in text or "=" in text
    lower = text.lower() if assigned else ""
    if assigned and any(w in lower for w in _WORDS):
        found += [
            ("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED
        ]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if assigned and any(w in lower for w in _NAMES):
        found += [("identifier", *m.span()) for m in IDENTIFIER.finditer(text)]
    bare = [m.span() for m in BARE.finditer(text) if _random_looking(m[0])]
    if bare:
        starts, reached = _covered([(s, e) for k, s, e in found if k != "identifier"])
        found += [("bare", s, e) for s, e in bare if not _touches(starts, reached, s, e)]
    if "://" in text:
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    return found


def _covered(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts of the spans in order, and how far the spans up to each one reach."""
    spans = sorted(spans)
    return [s for s, _ in spans], list(accumulate((e for _, e in spans), max))


def _touches(starts: list[int], reached: list[int], start: int, end: int) -> bool:
    before = bisect_left(starts, end)
    return before > 0 and reached[before - 1] > start


def find_parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in parts_of(t)] for t in texts])


def linked(parts: DataFrame, keys: list[str], reach: int = REACH) -> DataFrame:
    """(keys, kind, start, end) of the weak parts with what they need in scope.

    The interval join goes by bins of ``reach`` code points, so it compares neighbours only. A
    bin holds a bounded number of parts, as no two parts of a kind overlap.
    """
    weak = parts.where(F.col("kind").isin(*WEAK))
    bins = F.sequence(F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach))
    left = weak.withColumn("__bin", F.explode(bins))
    right = parts.where(F.col("kind") != "endpoint").select(
        *[F.col(k).alias(f"__r{k}") for k in keys],
        F.col("kind").alias("__rkind"),
        F.col("start").alias("__rstart"),
        F.col("end").alias("__rend"),
        F.explode(F.sequence(F.floor(F.col("start") / reach), F.floor(F.col("end") / reach))).alias("__rbin"),
    )
    same = F.col("__bin") == F.col("__rbin")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__r{k}"))
    near = (F.col("__rstart") <= F.col("end") + reach) & (F.col("__rend") >= F.col("start") - reach)
    own = (F.col("__rkind") == F.col("kind")) & (F.col("__rstart") == F.col("start"))
    identifier = F.max(F.col("__rkind").isin("identifier", "access"))
    secret = F.max(F.col("__rkind").isin("bare", "assign", "hex"))
    wanted = (
        F.when(F.col("kind") == "identifier", F.col("__secret"))
        .when(F.col("kind") == "bare", F.col("__identifier"))
        .otherwise(F.col("__secret") & F.col("__identifier"))
    )
    return (
        left.join(right, same & near & ~own)
        .groupBy(*keys, "kind", "start", "end")
        .agg(identifier.alias("__identifier"), secret.alias("__secret"))
        .where(wanted)
        .select(*keys, "kind", "start", "end")
    )


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    order = F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair])
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("order"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_secrets(df: DataFrame, reach: int = REACH) -> DataFrame:
    """One row for each row of (doc_id, text): counts, ``base`` and ``spans`` as arrays and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = stored(
        pick(df, "doc_id", "text").select("doc_id", F.xxhash64(text).alias("__h"), F.pandas_udf(find_parts, PARTS)(text).alias("__parts")),
        "secret-parts",
    )
    keys = ["doc_id", "__h"]  # equal rows have equal parts, so this key needs no number
    parts = (
        found.where(F.exists("__parts", lambda p: p["kind"].isin(*WEAK)))
        .select(*keys, F.explode("__parts").alias("p"))
        .select(*keys, "p.kind", "p.start", "p.end")
        .distinct()
    )
    added = (
        linked(parts, keys, reach)
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("kind", "start", "end")).cast(PARTS).alias("__added"))
        .select(F.col("doc_id").alias("__doc"), F.col("__h").alias("__hash"), "__added")
    )
    joined = found.join(
        added, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__h") == F.col("__hash")), "left"
    )
    base = F.filter("__parts", lambda p: p["kind"].isin(*SURE))
    count = lambda kind: F.size(F.filter("__parts", lambda p: p["kind"] == kind)).cast("long")
    return joined.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in SURE],
        _listed(base).alias("base"),
        _listed(F.concat(base, F.coalesce("__added", F.array().cast(PARTS)))).alias("spans"),
    )


ship(__name__)
