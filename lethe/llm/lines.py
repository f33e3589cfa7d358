"""Line dedup: an edit-distance self-join of all different lines, and the removal of near-copies.

*Segment-partition join.* A line is cut into ``errors + 1`` segments of even length. If two lines are
within ``errors`` edits, a segment of the shorter one stands in the longer one, at most a few characters off.
The index holds (length, segment number, segment) of each line; a line probes it, for each
length it may meet, with the substrings that the multi-match-aware selection leaves (12 in all for two
errors). Pairs that share an entry, and whose counts of ten letters allow it, are verified by edit distance.

*Verification.* Banded bit-parallel: a column of the edit matrix is held as two numbers of ``2 * errors + 1``
bits, the vertical differences around the diagonal, and is advanced with a few bit operations for each character.
What both lines begin and end with is cut off first, and a pair over the limit is not followed further.

*Frequent segments.* Index entries with more than ``hot`` lines are not paired. Their lines are joined again by the
rest of the line around the segment: the rests too are within ``errors`` edits, so the same join holds for them,
below the entry found. This goes on until entries are small or the rests too short to cut (lines that differ
in so little are near-copies anyway). So no pair is lost and no large group is paired as a whole.

*Removal.* The first place of a line is its least (doc_id, line number), null ids first. A line is original if
no line within ``errors`` edits has an earlier first place. Of all places of all lines, the first places of original
lines stay, all others go. Only lines of fewer than ``least_chars`` characters, by default empty ones, always stay.

*Short lines.* Exact copies go at any length. How many edits link two lines depends on the shorter one: one for each
``CHARS_AN_EDIT`` characters, ``errors`` at most; two lines of a few characters are never near-copies. Each number of
edits is a join of its own over the lines of those lengths.

Only DataFrame functions. Defined cases: a null text is empty, and stays as it is where the text is rebuilt; lines
end at ``\\n``; rows with equal id and text count as the same places, so they lose the same lines; an empty
table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.llm.frames import let, numbered, pick, stored

ERRORS = 2
LEAST_CHARS = 1
#: Characters of the shorter line for each edit that links it.
CHARS_AN_EDIT = 15
#: Lines under one index entry that are paired directly.
HOT = 512


# --- verification ----------------------------------------------------------------------------


def edit_distance(a: Column, b: Column, errors: int) -> Column:
    """Edit distance of two texts, ``errors + 1`` if it is more. Both are in code points."""
    width = 2 * errors + 1
    mask = (1 << width) - 1
    one, top = F.lit(1).cast("long"), F.lit(1 << (width - 1)).cast("long")

    def scan(long: Column, short: Column) -> Column:
        more = F.size(long) - F.size(short)
        # rows up to 0 rise by one with each column, so they count down; rows below count up
        low = (1 << (errors + 1)) - 1
        begin = F.struct(
            F.lit(mask ^ low).cast("long").alias("vp"),
            F.lit(low).cast("long").alias("vn"),
            more.alias("score"),
            F.lit(0).alias("j"),
        )

        def step(state: Column, c: Column) -> Column:
            def at(t: int) -> Column:
                same = F.get(long, state["j"] - errors + t).eqNullSafe(c)
                return F.when(same, F.lit(1 << t).cast("long")).otherwise(F.lit(0).cast("long"))

            def advance(v: Column) -> Column:
                sums = (v["x"].bitwiseAND(v["p"]) + v["p"]).bitwiseXOR(v["p"])
                d = sums.bitwiseOR(v["x"]).bitwiseOR(v["n"])
                return let(F.struct(v["p"].alias("p"), v["n"].alias("n"), d.alias("d")), columns)

            def columns(v: Column) -> Column:
                up = v["n"].bitwiseOR(F.bitwise_not(v["d"].bitwiseOR(v["p"])))
                hp = F.shiftleft(up, 1).bitwiseOR(one)
                hn = F.shiftleft(v["d"].bitwiseAND(v["p"]), 1)
                return let(F.struct(v["d"].alias("d"), hp.alias("hp"), hn.alias("hn")), moved)

            def moved(v: Column) -> Column:
                vp = v["hn"].bitwiseOR(F.bitwise_not(v["d"].bitwiseOR(v["hp"]))).bitwiseAND(F.lit(mask).cast("long"))
                vn = v["d"].bitwiseAND(v["hp"]).bitwiseAND(F.lit(mask).cast("long"))
                same = F.call_function("shiftrightunsigned", v["d"], (more + errors).cast("int")).bitwiseAND(one)
                return F.struct(
                    vp.alias("vp"),
                    vn.alias("vn"),
                    (state["score"] + 1 - same.cast("int")).alias("score"),
                    (state["j"] + 1).alias("j"),
                )

            x = reduce(lambda p, q: p + q, [at(t) for t in range(width)])
            vp = F.shiftrightunsigned(state["vp"], 1).bitwiseOR(top)
            vn = F.shiftrightunsigned(state["vn"], 1)
            # distances never fall along a diagonal, so beyond the limit nothing is left to find
            return F.when(state["score"] > errors, state).otherwise(
                let(F.struct(x.alias("x"), vp.alias("p"), vn.alias("n")), advance)
            )

        found = F.aggregate(short, begin, step, lambda s: s["score"])
        return F.when(more > errors, errors + 1).otherwise(F.least(found, F.lit(errors + 1)))

    def chars(text: Column) -> Column:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))

    def shared(long: Column, short: Column) -> Column:
        """Equal characters at the begin."""
        same = F.zip_with(short, F.slice(long, 1, F.size(short)), lambda x, y: x == y)
        return let(F.array_position(same, False), lambda p: F.when(p > 0, p - 1).otherwise(F.size(short)).cast("int"))

    def cut(t: Column) -> Column:
        """Without what both begin with; reversed, so that the next cut takes the ends."""
        return let(
            shared(t["long"], t["short"]),
            lambda p: F.struct(
                F.reverse(F.slice(t["long"], p + 1, F.size(t["long"]))).alias("long"),
                F.reverse(F.slice(t["short"], p + 1, F.size(t["short"]))).alias("short"),
            ),
        )

    first = F.length(a) >= F.length(b)
    ordered = F.struct(
        chars(F.when(first, a).otherwise(b)).alias("long"), chars(F.when(first, b).otherwise(a)).alias("short")
    )
    return let(ordered, lambda t: let(cut(t), lambda u: let(cut(u), lambda w: scan(w["long"], w["short"]))))


# --- candidates ------------------------------------------------------------------------------


def _segment(length: Column, i: int, errors: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``i`` of ``errors + 1`` even ones."""
    at = [F.call_function("div", length * k, F.lit(errors + 1)).cast("int") for k in (i, i + 1)]
    return at[0], at[1] - at[0]


def _offsets(errors: int, i: int, delta: int) -> range:
    """Where segment ``i`` of a line shorter by ``delta`` may stand in a longer one, from its own place."""
    left, right = i, errors - i
    return range(max(-left, delta - right), min(left, delta + right) + 1)


def _probes(errors: int) -> list[tuple[int, int, int]]:
    """(delta, segment, offset) of all substrings to try, without the line's own index entries."""
    own = [(0, i, 0) for i in range(errors + 1)]
    return [
        p
        for delta in range(errors + 1)
        for i in range(errors + 1)
        for p in ((delta, i, o) for o in _offsets(errors, i, delta))
        if p not in own
    ]


def _entries(rows: DataFrame, errors: int, places: list[tuple[int, int, int]], *kept: str) -> DataFrame:
    """(id, kept, key, number) of rows (id, below, text, ...): one key for each of ``places``."""
    n = F.col("__n")
    keys = []
    for delta, i, offset in places:
        start, size = _segment(n - delta, i, errors)
        part = F.substring(F.col("text"), start + (offset + 1), size)
        keys.append(F.xxhash64(F.col("below"), n - delta, F.lit(i), part))
    return rows.withColumn("__n", F.length("text")).select(
        "id", *kept, F.posexplode(F.array(*keys)).alias("number", "key")
    )


def _of_place(places: list[tuple[int, int, int]], k: int) -> Column:
    return F.get(F.array(*[F.lit(p[k]) for p in places]), F.col("number"))


def _rest(places: list[tuple[int, int, int]], errors: int) -> Column:
    """The text without the substring of its key."""
    n = F.length("text") - _of_place(places, 0)
    i = _of_place(places, 1)
    at = [F.call_function("div", n * (i + k), F.lit(errors + 1)).cast("int") for k in (0, 1)]
    start = F.greatest(at[0] + _of_place(places, 2), F.lit(0))
    whole = F.length("text")
    return F.concat(F.substring("text", F.lit(1), start), F.substring(F.col("text"), start + (at[1] - at[0]) + 1, whole))


#: Letters whose counts are compared first: an edit changes them by two in all at most.
LETTERS = "etanrisohd"


def letter_counts(text: Column) -> Column:
    """How often each of ``LETTERS`` occurs, modulo 64, in six bits each."""
    total = F.lit(0).cast("long")
    for k, letter in enumerate(LETTERS):
        n = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(letter), F.lit("")))).cast("long")
        total = total + F.shiftleft(n.bitwiseAND(F.lit(63).cast("long")), 6 * k)
    return total


def may_be_close(a: Column, b: Column, errors: int) -> Column:
    """What holds for the letter counts of any two lines within the errors."""
    apart = F.lit(0).cast("long")
    mask = F.lit(63).cast("long")
    for k in range(len(LETTERS)):
        x, y = (F.shiftright(c, 6 * k).bitwiseAND(mask) for c in (a, b))
        differ = F.abs(x - y)
        apart = apart + F.least(differ, 64 - differ)
    return apart <= 2 * errors


def candidates(lines: DataFrame, errors: int = ERRORS, hot: int = HOT) -> DataFrame:
    """(a, b), a being indexed and b probing: pairs of ``lines`` (id, text) that share an index entry.

    A column ``letters`` of ``lines`` is taken as the letter counts.
    """
    known = "letters" in lines.columns
    own, more = [(0, i, 0) for i in range(errors + 1)], _probes(errors)
    index = lines.select(
        "id",
        "text",
        F.lit(0).cast("long").alias("below"),
        F.lit(None).cast("int").alias("delta"),
        F.col("letters") if known else letter_counts(F.col("text")).alias("letters"),
    )
    close = may_be_close(F.col("la"), F.col("lb"), errors)
    probing, found, first = index, [], True
    while True:
        held = _entries(index, errors, own, "letters")
        if first:  # the same lines probe: their own entries are probes of delta 0
            held = stored(held, "line-index")
            tried = _entries(probing, errors, more, "letters")
            probes = [
                held.select("key", "id", "letters", F.lit(0).alias("d")),
                tried.select("key", "id", "letters", _of_place(more, 0).alias("d")),
            ]
        else:
            tried = _entries(probing, errors, own + more, "delta", "letters").where(_of_place(own + more, 0) == F.col("delta"))
            probes = [tried.select("key", "id", "letters", F.col("delta").alias("d"))]
        frequent = stored(
            held.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("key"), "frequent-segments"
        )
        some = not frequent.isEmpty()
        sides = [
            held.select("key", F.col("id").alias("a"), F.col("letters").alias("la")),
            reduce(DataFrame.union, probes).withColumnsRenamed({"id": "b", "letters": "lb"}),
        ]
        if some:
            sides = [side.join(frequent, "key", "left_anti") for side in sides]
        joined = sides[0].join(sides[1], "key")
        found.append(joined.where(((F.col("d") > 0) | (F.col("a") < F.col("b"))) & close).select("a", "b"))
        if not some:
            break

        def again(rows: DataFrame, places: list[tuple[int, int, int]], delta: Column, label: str) -> DataFrame:
            under = _entries(rows, errors, places, "text", "delta", "letters").withColumn("d", delta)
            under = under if first else under.where(F.col("d").eqNullSafe(F.col("delta")) | F.lit(places is own))
            return stored(
                under.join(frequent, "key", "left_semi").select(
                    "id",
                    _rest(places, errors).alias("text"),
                    F.col("key").alias("below"),
                    F.col("d").cast("int").alias("delta"),
                    "letters",
                ),
                label,
            )

        every = own + more
        probing = again(probing, every, _of_place(every, 0), "frequent-tried")
        index = again(index, own, F.lit(None).cast("int"), "frequent-held")
        first = False
        brief = F.length("text") <= errors  # no room for segments: what is left to differ is that short
        short = F.length("text") - F.col("delta") <= errors
        ends = [
            index.where(brief).select("below", F.col("id").alias("a"), F.col("letters").alias("la")),
            probing.where(short).select("below", F.col("id").alias("b"), "delta", F.col("letters").alias("lb")),
        ]
        last = ends[0].join(ends[1], "below").where(
            ((F.col("delta") > 0) | (F.col("a") < F.col("b"))) & close
        )
        found.append(last.select("a", "b"))
        index, probing = index.where(~brief), probing.where(~short)
    return reduce(DataFrame.union, found).distinct()


#: Identifiers sent to all tasks at most (some 32 bytes each); more are joined by shuffle.
BROADCAST_IDS = 500_000


def _of_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with these ids. Few ids are broadcast, so that the texts need not move."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def line_links(lines: DataFrame, errors: int = ERRORS, hot: int = HOT, under: int | None = None) -> DataFrame:
    """(a, b): pairs of different ``lines`` (id, text) within ``errors`` edits.

    With ``under`` only pairs whose shorter line has fewer characters than that.
    """
    pairs = stored(candidates(lines, errors, hot), "line-candidates")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = stored(_of_ids(lines.select("id", "text"), ids), "line-texts")
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("__a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("__b"))
    checked = pairs.join(a, "a").join(b, "b")
    if under is not None:
        checked = checked.where(F.least(F.length("__a"), F.length("__b")) < under)
    return checked.where(edit_distance(F.col("__a"), F.col("__b"), errors) <= errors).select("a", "b")


def near_links(lines: DataFrame, errors: int = ERRORS, hot: int = HOT) -> DataFrame:
    """(a, b): pairs of different ``lines`` within ``errors`` edits, and within one for each
    ``CHARS_AN_EDIT`` characters of the shorter line."""
    n, found = F.length("text"), []
    for k in range(1, errors + 1):
        some = lines.where(n >= k * CHARS_AN_EDIT)
        if k == errors:
            found.append(line_links(some, k, hot))
        else:  # the longer line may have k characters more
            under = (k + 1) * CHARS_AN_EDIT
            found.append(line_links(some.where(n < under + k), k, hot, under))
    return reduce(DataFrame.union, found)


# --- removal ---------------------------------------------------------------------------------


def _places(docs: DataFrame, least_chars: int) -> DataFrame:
    """(doc_id, text_hash, no, line, h1, h2) of the lines that are long enough."""
    split = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    return (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(split).alias("no", "line"))
        .where(F.length("line") >= least_chars)
        .withColumn("h1", F.xxhash64("line"))
        .withColumn("h2", F.hash("line"))
    )


def different_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(id, h1, h2, text, place, places, letters) of each different line; stored."""
    lines = (
        _places(docs, least_chars)
        .groupBy("h1", "h2")
        .agg(
            F.min(F.struct("doc_id", "no")).alias("place"),
            F.count(F.lit(1)).alias("places"),
            F.first("line").alias("text"),
        )
        .withColumn("id", F.monotonically_increasing_id())
        .withColumn("letters", letter_counts(F.col("text")))
    )
    return stored(lines, "lines")


def duplicate_lines(
    df: DataFrame, errors: int = ERRORS, least_chars: int = LEAST_CHARS, hot: int = HOT
) -> DataFrame:
    """(doc_id, text_hash, dropped, n_links) of the documents with lines to drop or with links.

    ``dropped`` holds line numbers; ``n_links`` counts, over the document's lines, the other
    lines of the corpus within ``errors`` edits. ``text_hash`` is ``xxhash64(text)``.
    """
    docs = pick(df, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    lines = different_lines(docs, least_chars)
    links = stored(near_links(lines.select("id", "text", "letters"), errors, hot), "line-links")
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("id"), F.col("a").alias("other"))
    )
    places = lines.select("id", "place")
    earlier = (
        ends.join(places.withColumnRenamed("place", "__own"), "id")
        .join(places.select(F.col("id").alias("other"), F.col("place").alias("__other")), "other")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("links"), F.max(F.col("__other") < F.col("__own")).alias("later"))
    )
    judged = stored(
        lines.select("id", "h1", "h2", "place", "places")
        .join(earlier, "id", "left")
        .where((F.col("places") > 1) | F.col("links").isNotNull())
        .select("h1", "h2", "place", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("later", F.lit(False)).alias("later")),
        "line-verdicts",
    )
    drop = F.col("later") | ~F.col("place").eqNullSafe(F.struct("doc_id", "no"))
    return (
        _places(docs, least_chars)
        .drop("line")
        .join(judged, ["h1", "h2"])
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set(F.when(drop, F.col("no")))).alias("dropped"), F.sum("links").alias("__sum"), F.count_distinct("no").alias("__n"), F.count(F.lit(1)).alias("__all"))
        # equal rows meet here: each counts once
        .select("doc_id", "text_hash", "dropped", (F.col("__sum") * F.col("__n") / F.col("__all")).cast("long").alias("n_links"))
    )


def without_lines(text: Column, dropped: Column) -> Column:
    """The text without these line numbers."""

    def rebuilt(parts: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), dropped)
        return F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")

    return F.when(F.coalesce(F.size(dropped), F.lit(0)) > 0, let(F.split(text, "\n", -1), rebuilt)).otherwise(text)


def drop_duplicate_lines(
    df: DataFrame, errors: int = ERRORS, least_chars: int = LEAST_CHARS, hot: int = HOT
) -> DataFrame:
    """All rows and columns of ``df`` with the near-copies of earlier lines taken out of ``text``."""
    found = duplicate_lines(df, errors, least_chars, hot)
    rows, names = numbered(df)
    doc, text = names["doc_id"], names["text"]
    found = found.where(F.size("dropped") > 0).select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "dropped"
    )
    same = F.col(doc).eqNullSafe(F.col("__doc")) & (F.xxhash64(F.col(text).cast("string")) == F.col("__hash"))
    joined = rows.join(found, same, "left").withColumn(text, without_lines(F.col(text), F.col("dropped")))
    return joined.select(*rows.columns).toDF(*df.columns)


def line_report(df: DataFrame, **rules: int) -> DataFrame:
    """(doc_id, n_lines, n_dropped, n_links, dropped) for each row of (doc_id, text)."""
    docs = pick(df, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    found = duplicate_lines(docs, **rules).select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "dropped", "n_links"
    )
    counted = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)).cast("long").alias("n_lines"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash"))
    return counted.join(found, same, "left").select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
