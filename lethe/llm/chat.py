"""Chat formatting: layouts are recognised by their field paths and become one template.

A *layout* is the set of nested field paths of a record, such as ``messages[].role``. Its SHA-256
over the sorted paths selects a mapping, which says by column expressions how to get canonical
turns (role, text). Paths that no mapping knows are left out before hashing, so further columns
do no harm.

Template: ``<|turn|>role NEWLINE text<|end|>`` for each turn. Control strings in roles and texts
are escaped, so markers occur only where the template put them, and unescaping is exact.

Defined cases: a null text or role is empty; rows of a conversation go by turn, then role, then
text, nulls first, and repeated rows are repeated turns; rows with a null conversation id form
one conversation; an empty table gives no rows; a record of an unknown layout gives null turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lethe.llm.frames import let, pick

TURN, END = "<|turn|>", "<|end|>"
#: Strings that must not occur inside an escaped text, each starting with ``<`` or ``[``.
CONTROL = (
    TURN, END, "<s>", "</s>", "<|im_start|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
TRAINED_ROLES = ("assistant",)
#: Names of roles in other layouts, and the canonical name.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURNS = "array<struct<role:string,text:string>>"


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in "|[]/<>\\" else c for c in text)


_STARTS = "|".join(
    f"{_quoted(first)}(?={'|'.join(_quoted(c[1:]) for c in CONTROL if c[0] == first)})" for first in "<["
)


def escape(text: Column) -> Column:
    """Backslash becomes ``\\b``; ``\\c`` goes after the first character of a control string."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.regexp_replace(doubled, F.lit(f"({_STARTS})"), F.lit(r"$1\\c"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\c"), F.lit("")), F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\l"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\l"), F.lit("\n")))


# --- layouts ---------------------------------------------------------------------------------


def field_paths(kind: T.DataType, path: str = "") -> list[str]:
    """Leaf paths of a type, ``[]`` for elements."""
    if isinstance(kind, T.StructType):
        return [
            p for f in kind.fields for p in field_paths(f.dataType, f"{path}.{f.name}" if path else f.name)
        ]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, path + "[]")
    return [path]


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


@dataclass(frozen=True)
class Mapping:
    """``turns`` gets a function from top-level name to column, and returns canonical turns."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[Callable[[str], Column]], Column] | None = None  # None: one row for a turn

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def _turn(role: Column | str, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.cast("string").alias("role"), text.cast("string").alias("text"))


def _canonical_role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(known[F.lower(role)], role)


def _message_list(column: str, role: str, text: str):
    def turns(col):
        return F.transform(col(column), lambda m: _turn(_canonical_role(m[role]), m[text]))

    return turns


def _with_input(col):
    more = F.coalesce(col("input"), F.lit(""))
    text = F.concat(
        F.coalesce(col("instruction"), F.lit("")), F.when(more == "", "").otherwise(F.concat(F.lit("\n"), more))
    )
    return F.array(_turn("user", text), _turn("assistant", col("output")))


MAPPINGS = (
    Mapping("turn rows", ("conv_id", "turn", "role", "text")),
    Mapping(
        "prompt and response",
        ("prompt", "response"),
        lambda col: F.array(_turn("user", col("prompt")), _turn("assistant", col("response"))),
    ),
    Mapping("instruction", ("instruction", "input", "output"), _with_input),
    Mapping(
        "instruction without input",
        ("instruction", "output"),
        lambda col: F.array(_turn("user", col("instruction")), _turn("assistant", col("output"))),
    ),
    Mapping("messages", ("messages[].role", "messages[].content"), _message_list("messages", "role", "content")),
    Mapping(
        "from and value",
        ("conversations[].from", "conversations[].value"),
        _message_list("conversations", "from", "value"),
    ),
)


def _by_print(mappings: Iterable[Mapping]) -> tuple[set[str], dict[str, Mapping]]:
    mappings = tuple(mappings)
    return {p for m in mappings for p in m.paths}, {m.fingerprint: m for m in mappings}


def canonical_turns(df: DataFrame, mappings: Iterable[Mapping] = MAPPINGS) -> DataFrame:
    """Rows with ``turns``; the mapping is chosen by the fingerprint of the table's schema.

    A table with one row for each turn becomes (conv_id, turns); any other keeps its rows and
    gets the column ``turns`` alone, beside ``conv_id`` where it has one.
    """
    known, by_print = _by_print(mappings)
    found = [p for p in field_paths(df.schema) if p in known and p != "conv_id"]
    chosen = by_print.get(fingerprint(found)) or by_print.get(fingerprint(["conv_id", *found]))
    if chosen is None:
        raise ValueError(f"no mapping for the fields {sorted(found)}")
    if chosen.turns is not None:
        tops = list(dict.fromkeys(p.split(".")[0].split("[")[0] for p in chosen.paths))
        kept = ["conv_id"] if "conv_id" in df.columns else []
        return pick(df, *kept, *tops).select(*kept, chosen.turns(F.col).cast(TURNS).alias("turns"))
    rows = pick(df, "conv_id", "turn", "role", "text")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: _turn(t["role"], t["text"])).alias("turns")
    )


def canonical_records(
    df: DataFrame, column: str, mappings: Iterable[Mapping] = MAPPINGS
) -> DataFrame:
    """Adds ``layout`` (fingerprint) and ``turns`` to rows that hold a JSON record each.

    Every row may have a layout of its own. Field paths are read two levels deep. Null, broken
    or unknown records get null turns.
    """
    known, by_print = _by_print(m for m in mappings if m.turns is not None)
    texts = F.from_json(F.col(column), "map<string,string>")

    def nested(key: Column, value: Column) -> Column:
        many = F.from_json(value, "array<map<string,string>>")
        one = F.from_json(value, "map<string,string>")
        return (
            F.when(
                value.startswith("["),
                F.array_distinct(
                    F.flatten(
                        F.transform(many, lambda m: F.transform(F.map_keys(m), lambda k: F.concat(key, F.lit("[]."), k)))
                    )
                ),
            )
            .when(value.startswith("{"), F.transform(F.map_keys(one), lambda k: F.concat(key, F.lit("."), k)))
            .otherwise(F.array(key))
        )

    paths = F.flatten(
        F.transform(F.map_entries(texts), lambda e: F.coalesce(nested(e["key"], e["value"]), F.array(e["key"])))
    )
    ours = F.array_sort(F.array_intersect(paths, F.array(*[F.lit(p) for p in sorted(known)])))
    layout = F.sha2(F.array_join(ours, "\n"), 256)

    def top(name: str) -> Column:
        if any(p.startswith(name + "[]") for p in known):
            return F.from_json(F.col("__top")[name], "array<map<string,string>>")
        return F.col("__top")[name]

    turns = F.lit(None).cast(TURNS)
    for code, mapping in by_print.items():
        turns = F.when(F.col("layout") == code, mapping.turns(top).cast(TURNS)).otherwise(turns)
    return (
        df.withColumn("__top", texts)
        .withColumn("layout", layout)
        .withColumn("turns", turns)
        .drop("__top")
    )


# --- template --------------------------------------------------------------------------------


def render(df: DataFrame, trained: Iterable[str] = TRAINED_ROLES) -> DataFrame:
    """Replaces ``turns`` by ``formatted`` and ``mask``.

    ``mask`` has an entry for each turn: code points before the text (``head``), of the escaped
    text (``body``), and whether the text counts for the loss.
    """
    trained = list(trained)

    def part(turn: Column) -> Column:
        role, text = (F.coalesce(turn[c], F.lit("")) for c in ("role", "text"))
        return F.struct(
            F.concat(F.lit(TURN), _escape_role(role), F.lit("\n")).alias("head"),
            escape(text).alias("body"),
            role.isin(trained).alias("loss"),
        )

    parts = F.col("__parts")
    return (
        df.withColumn("__parts", F.transform("turns", part))
        .drop("turns")
        .withColumn(
            "formatted",
            F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""),
        )
        .withColumn(
            "mask",
            F.transform(
                parts,
                lambda p: F.struct(
                    F.length(p["head"]).alias("head"), F.length(p["body"]).alias("body"), p["loss"].alias("loss")
                ),
            ),
        )
        .drop("__parts")
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text, unescaped."""

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, len(TURN) + 1, 2**31 - 1)
        return let(
            F.substring_index(inner, "\n", 1),
            lambda head: F.struct(
                _unescape_role(head).alias("role"),
                unescape(F.substring(inner, F.length(head) + 2, F.lit(2**31 - 1))).alias("text"),
            ),
        )

    return F.transform(_pieces(formatted), turn)


def _pieces(formatted: Column) -> Column:
    """What stands before each end marker; nothing can follow the last one."""
    return F.filter(F.split(formatted, _quoted(END), -1), lambda p: p != "")


def loss_text(formatted: Column, mask: Column) -> Column:
    """Text under the loss mask, unescaped, nothing between."""

    def under(piece: Column, entry: Column) -> Column:
        body = F.substring(piece, entry["head"] + 1, entry["body"])
        return F.when(entry["loss"], unescape(body)).otherwise("")

    return F.array_join(F.zip_with(_pieces(formatted), mask, under), "")
