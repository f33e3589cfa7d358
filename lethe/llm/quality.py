"""Quality rules: base counts, and the distance of a text's histograms to its language.

Two histograms are made of each text: of character classes, and of the language's common words
(one bin a word, one for all other words). The reference of a language is the mean histogram of
all its documents that pass the base rules and the length guards, counted in whole millionths so
that the order of summing does not matter. A document fails if the Jensen-Shannon distance
(logarithm base 2, so 0 to 1) of either histogram to the reference exceeds its limit. Below the
guards (``least_chars``, ``least_words_compared``), or without a reference for the language (fewer than
``least_documents``), the distance is null and rejects nothing.

Only DataFrame functions; one pass over the texts, whose small results are stored, and a
reference table of one row for each supported language.

Defined cases: a null text has no words and fails the base rule; a null or unlisted language has
no reference; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.llm.frames import SPACE, let, numbered, pick, row_key, stored

# Frequent words of each language.
COMMON_WORDS = {
    "de": "der die das und in den von zu ist mit nicht ein eine sich auf für im dem es an".split(),
    "en": "the of and to in a is that it for on was as with be by are this at from".split(),
    "es": "de la que el en y a los se del las un por con no una su para es lo".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au plus avec".split(),
}
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    least_words: int = 50
    repeat_percent: int = 50
    least_chars: int = 200  # guard of the character classes
    least_words_compared: int = 100  # guard of the common words: shorter texts are mostly noise
    least_documents: int = 20
    class_distance: float = 0.30
    word_distance: float = 0.275


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def repeated_words(words: str) -> Column:
    """Words in 3-word windows that occur twice or more, the first one included."""
    windows = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<long>"))

    def starts(ordered: Column) -> Column:
        def again(entry: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1), F.get(ordered, k + 1)
            return before["h"].eqNullSafe(entry["h"]) | after["h"].eqNullSafe(entry["h"])

        return F.array_sort(F.transform(F.filter(ordered, again), lambda e: e["i"]))

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
        return F.aggregate(
            positions,
            start,
            lambda acc, p: F.struct(
                (p + 3).alias("end"), (acc["total"] + p + 3 - F.greatest(p, acc["end"])).alias("total")
            ),
            lambda acc: acc["total"],
        )

    def counted(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            covered(let(pairs, starts))
        )

    return let(windows, counted)


def _common_counts(words: str, listed: list[str]) -> Column:
    """How often each listed word occurs, then all other words together."""

    def counts(ours: Column) -> Column:
        def count(word: str) -> Column:
            return F.size(F.filter(ours, lambda w: w == word))

        return F.array(*map(count, listed), F.size(words) - F.size(ours))

    return let(F.filter(words, lambda w: w.isin(listed)), counts)


def features(df: DataFrame) -> DataFrame:
    """Replaces ``text`` by counts and histograms; the other columns stay."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = (
        df.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
        .withColumn("__words", words_of(F.col("text")))
        .withColumn("__lines", lines)
        .withColumn("__dense", _without(F.col("text"), SPACE))
        .withColumn("__1", _without(F.col("__dense"), "[a-z]+"))
        .withColumn("__2", _without(F.col("__1"), "[.,;:!?'\"()-]+"))
        .withColumn("__3", _without(F.col("__2"), "[A-Z]+"))
        .withColumn("__4", _without(F.col("__3"), "[0-9]+"))
        .withColumn("__5", _without(F.col("__4"), r"\p{L}+"))
    )
    size = {c: F.length(c) for c in ("text", "__dense", "__1", "__2", "__3", "__4", "__5")}
    chain = ["text", "__dense", "__1", "__2", "__3", "__4", "__5"]
    classes = F.array(*[size[a] - size[b] for a, b in zip(chain, chain[1:])], size["__5"])
    common = F.lit(None).cast("array<int>")
    for lang, listed in COMMON_WORDS.items():
        common = F.when(F.col("lang") == lang, _common_counts("__words", listed)).otherwise(common)
    symbols = _without(F.col("__2"), f"[{SYMBOLS}]+")
    return step.select(
        *[c for c in df.columns if c != "text"],
        F.size("__words").cast("long").alias("n_words"),
        size["__dense"].cast("long").alias("word_chars"),
        (size["__2"] - F.length(symbols)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeated_words("__words").cast("long").alias("n_repeat_words"),
        size["text"].cast("long").alias("__chars"),
        classes.alias("__classes"),
        common.alias("__common"),
    )


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return let(total, lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0))))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares."""

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: term(a, b) + term(b, a))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _guards(rules: Rules) -> dict[str, Column]:
    return {
        "__classes": F.col("__chars") >= rules.least_chars,
        "__common": F.col("n_words") >= rules.least_words_compared,
    }


def references(found: DataFrame, rules: Rules) -> DataFrame:
    """A row for each language of ``COMMON_WORDS`` with enough documents: at most that many rows."""
    guards = _guards(rules)
    long_enough = guards["__classes"] & guards["__common"]
    good = found.where(F.col("lang").isin(*COMMON_WORDS) & ~F.col("base_failed") & long_enough)
    sums = [F.count(F.lit(1)).alias("__n")]
    sizes = {"__classes": 7, "__common": max(map(len, COMMON_WORDS.values())) + 1}
    for name, size in sizes.items():
        parts = F.transform(_shares(F.col(name)), lambda x: F.round(x * 1_000_000).cast("long"))
        good = good.withColumn(name, parts)
        sums.append(F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(size)]).alias(f"__r{name}"))
    sums = good.groupBy(F.col("lang").alias("__lang")).agg(*sums).where(F.col("__n") >= rules.least_documents)
    return sums.select(
        "__lang",
        *[_shares(F.filter(f"__r{name}", lambda x: x.isNotNull())).alias(f"__r{name}") for name in sizes],
    )


def judge(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``df`` (text, lang and others) with counts, distances and ``kept`` for the text."""
    found = features(df).withColumn(
        "base_failed",
        (F.col("n_words") < rules.least_words)
        | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words")),
    )
    found = stored(found, "quality-features")
    # one row for each language of COMMON_WORDS at most
    known = found.join(F.broadcast(references(found, rules)), F.col("lang") == F.col("__lang"), "left")

    def distance(name: str) -> Column:
        return F.when(
            _guards(rules)[name] & F.col(f"__r{name}").isNotNull(),
            js_distance(_shares(F.col(name)), F.col(f"__r{name}")),
        )

    known = known.withColumn("class_distance", distance("__classes")).withColumn(
        "word_distance", distance("__common")
    )
    far = (F.col("class_distance") > rules.class_distance) | (F.col("word_distance") > rules.word_distance)
    kept = ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))
    return known.withColumn("kept", kept).drop(
        "__chars", "__classes", "__common", "__lang", "__r__classes", "__r__common"
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge_documents(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row for each row of (doc_id, text, lang)."""
    return judge(pick(df, "doc_id", "text", "lang"), rules).select(
        "doc_id", *COUNTS, "base_failed", "kept", "class_distance", "word_distance"
    )


def keep_good(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``df`` (with all columns) that the rules keep."""
    ours = pick(df, "doc_id", "text", "lang")
    key = row_key(F.col("doc_id"), F.col("text"))
    judged = judge(ours.select(key.alias("__key"), "text", "lang"), rules)
    rejected = judged.where(~F.col("kept")).select("__key").distinct()
    rows, names = numbered(df)
    keyed = rows.withColumn("__key", row_key(F.col(names["doc_id"]), F.col(names["text"])))
    return keyed.join(rejected, "__key", "left_anti").select(*rows.columns).toDF(*df.columns)
