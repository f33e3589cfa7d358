"""Token counts of whole texts with a public tokenizer, huge texts by overlapping chunks.

A huge text is encoded chunk by chunk with offsets. Two neighbours overlap; they are joined at a
place inside the overlap where both have a token boundary and which is *proven stable*: the
character before it is plain white space and the one at it is not. The tokenizers meant here
(white space dropped before the merges, see ``is_stable``) treat what stands on the two sides of
white space independently, so the tokens left of the place in the left chunk and right of it in
the right chunk are those of the whole text. If an overlap has no such place, or the neighbours
disagree there, it is widened twofold, up to the rest of the text if need be.

Other texts are encoded as a whole; as white space separates them too, each different word is
encoded once and its count is kept (a bounded store). Texts with rare kinds of white space, on
which libraries may differ, take the library's result for the whole text.

Defined cases: a null text is empty and has no tokens; repeated rows are counted each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm.frames import pick, ship

LIMIT = 2048
CHUNK = 16_384
OVERLAP = 512
#: Different words whose counts a task keeps.
WORDS_KEPT = 400_000
_RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
_PLACE = re.compile(r"(?<=[ \t\n\r])[^ \t\n\r]")


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def drops_space(tokenizer) -> bool:
    """Whether white space separates texts for this tokenizer, tried on hard neighbours."""
    sides = ("it's", "don", "'t", "12", "a1", "é", "́x", "--", "<|endoftext|>", "Σ", "ab̧", "'")
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False))
    return size(" \n") == 0 and all(
        size(f"{a}{s}{b}") == size(a) + size(b) for a in sides for b in sides for s in (" ", "\n", " \t ")
    )


def spliced_count(
    text: str, encode: Callable[[str], list[tuple[int, int]]], chunk: int = CHUNK, overlap: int = OVERLAP
) -> int:
    """Tokens of ``text``. ``encode`` gives the tokens' offsets in code points."""
    total, begin, first = 0, 0, 0  # tokens that start at or after ``first`` are still to be counted
    end = min(chunk, len(text))
    left = encode(text[begin:end])
    while end < len(text):
        place, wide = None, overlap
        while place is None and end < len(text):
            start = max(begin, end - wide)
            if start == begin:  # the overlap would be the whole chunk: make the chunk longer
                end = min(len(text), begin + 2 * (end - begin))
                left = encode(text[begin:end])
                continue
            stop = min(len(text), max(start + chunk, end + overlap))
            right = encode(text[start:stop])
            place = _common(text, left, begin, right, start, max(first, start), end)
            wide *= 2
        if place is not None:
            total += sum(first <= a + begin < place for a, _ in left)
            left, begin, end, first = right, start, stop, place
    return total + sum(a + begin >= first for a, _ in left)


def _common(text, left, begin, right, start, low, high) -> int | None:
    """The last stable place of the overlap where both chunks begin a token and none crosses."""
    a = {x + begin for x, _ in left}
    b = {x + start for x, _ in right}
    crossed = [(x + begin, y + begin) for x, y in left if y + begin > low]
    best = None
    for m in _PLACE.finditer(text, low, high):
        p = m.start()
        if p > low and p in a and p in b:
            best = p
    if best is not None and any(x < best < y for x, y in crossed):
        return None
    return best


def token_counter(path: str, chunk: int, overlap: int) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = _load(path)
        separate = drops_space(tokenizer)
        kept: dict[str, int] = {}

        def whole(texts: list[str]) -> list[int]:
            return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def offsets(text: str) -> list[tuple[int, int]]:
            return tokenizer.encode(text, add_special_tokens=False).offsets

        def count(text: str) -> int:
            if not separate or _RARE_SPACE.search(text):
                return whole([text])[0]
            if len(text) > chunk:
                return spliced_count(text, offsets, chunk, overlap)
            words = text.split()
            if new := list(set(words).difference(kept)):
                if len(kept) + len(new) > WORDS_KEPT:
                    kept.clear()
                    new = list(set(words))
                kept.update(zip(new, whole(new)))
            return sum(map(kept.__getitem__, words))

        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    return counts


def count_tokens(
    df: DataFrame, tokenizer_path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of (doc_id, text)."""
    counted = F.pandas_udf(token_counter(tokenizer_path, chunk, overlap), "long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        pick(df, "doc_id", "text")
        .select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), counted(text).alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


ship(__name__)
