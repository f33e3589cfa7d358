"""Sampled segmentations over a SentencePiece vocabulary, reproducible by row; lossless decoding.

The *lattice* of a text has an edge for every vocabulary piece at every place, and one of byte pieces
for a character that is no piece by itself (also for a literal U+2581, which would else read as a
space). As in the library a space goes before the text, and spaces are part of pieces.

*Forward filtering, backward sampling*: forward, the summed weight of all segmentations up to each
place; backward from the end, pieces drawn by their share of that sum. So a segmentation comes with
probability in proportion to the product of its pieces' weights. A merge vocabulary holds ranks
and no probabilities; the weights are ``(rank + 1) ** -power`` (Zipf's law at 1; larger powers come closer to
a single segmentation). The random numbers are a hash of the seed, the row key, the unit's number
in the text and the step, so neither batches nor partitions matter.

No piece has a space after another character, and none has a line feed, so texts fall into *units*
(spaces and what follows them; a line feed) whose lattices do not touch. A lattice is made once for
each different unit of a slice of the texts.

Defined cases: null texts are empty and have no pieces; rows with equal keys and texts get equal pieces; a
null key is a key; very long texts and units are handled like others, in slices of whole texts; an
empty table gives no rows. Ids that a model does not have cannot be decoded (an error).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm.frames import pick, ship
from lethe.llm.words import mix, sliced

POWER = 1.0
SEED = 42
_SLICE = 2 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.uint64(1 << 20)


@dataclass
class Vocabulary:
    """Pieces as bytes (space for the mark), and a trie in an open hash table."""

    texts: list  # bytes of each id
    first_byte: int  # id of byte piece 0
    weight: np.ndarray  # log weight of each id
    keys: np.ndarray
    targets: np.ndarray
    probes: int
    piece_at: np.ndarray  # id that ends in a trie state, or -1
    longest: int


def _slot(key: np.ndarray, mask: np.uint64) -> np.ndarray:
    return (mix(key.astype(np.uint64)) & mask).astype(np.int64)


def load(model_path: str, power: float = POWER) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = sp.get_piece_size()
    texts: list[bytes] = []
    first_byte = next(i for i in range(size) if sp.is_byte(i))
    rank = np.zeros(size)
    states: dict[tuple[int, int], int] = {}
    piece_at = [-1]
    for i in range(size):
        if sp.is_byte(i):
            texts.append(bytes([i - first_byte]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            texts.append(b"")
        else:
            text = sp.id_to_piece(i).replace("▁", " ").encode()
            texts.append(text)
            state = 0
            for byte in text:
                state = states.setdefault((state, byte), len(states) + 1)
                if state == len(piece_at):
                    piece_at.append(-1)
            piece_at[state] = i
        rank[i] = i
    rank[: first_byte + 256] = size  # bytes and controls come after all pieces
    bits = max(4, (4 * len(states)).bit_length())
    mask = np.uint64((1 << bits) - 1)
    keys, targets = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
    todo = np.array([s * 256 + b for s, b in states], np.int64)
    values = np.array(list(states.values()), np.int32)
    probes = 0
    while len(todo):
        slot = (_slot(todo, mask) + probes) & int(mask)
        free = np.flatnonzero(keys[slot] < 0)
        _, chosen = np.unique(slot[free], return_index=True)
        won = free[chosen]
        keys[slot[won]], targets[slot[won]] = todo[won], values[won]
        left = np.ones(len(todo), bool)
        left[won] = False
        todo, values, probes = todo[left], values[left], probes + 1
    return Vocabulary(
        texts, first_byte, -power * np.log(rank + 1), keys, targets, probes, np.array(piece_at), max(map(len, texts))
    )


def _step(v: Vocabulary, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Next trie states, -1 where there is none."""
    key = state * 256 + byte
    mask = np.uint64(len(v.keys) - 1)
    slot = _slot(key, mask)
    out = np.where(v.keys[slot] == key, v.targets[slot], -1)
    open_ = np.flatnonzero((out < 0) & (v.keys[slot] >= 0))
    for p in range(1, v.probes):
        if not len(open_):
            break
        s = (slot[open_] + p) & int(mask)
        out[open_] = np.where(v.keys[s] == key[open_], v.targets[s], -1)
        open_ = open_[(out[open_] < 0) & (v.keys[s] >= 0)]
    return out


@dataclass
class Lattice:
    """Edges by the place where they end, short ones first; ``share`` is cumulative for each place."""

    at: np.ndarray  # first edge of each end place, one more than places
    start: np.ndarray
    piece: np.ndarray  # -1: bytes
    share: np.ndarray


def lattice(v: Vocabulary, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Lattice:
    """Of all units ``begin[i]:end[i]``, which lie one after the other in ``data``. Places are bytes + 1."""
    n = len(data)
    unit_end = np.repeat(end, end - begin)
    unit_begin = np.repeat(begin, end - begin)
    char = (data & 0xC0) != 0x80
    starts, ends, pieces = [], [], []
    place = np.flatnonzero(char)
    state = np.zeros(len(place), np.int64)
    covered = np.zeros(n, bool)  # characters that are pieces by themselves
    char_end = np.append(np.flatnonzero(char)[1:], n)
    size_of = np.zeros(n, np.int64)
    size_of[place] = np.minimum(char_end, unit_end[place]) - place
    for length in range(1, v.longest + 1):
        state = _step(v, state, data[place + length - 1].astype(np.int64))
        alive = state >= 0
        place, state = place[alive], state[alive].astype(np.int64)
        piece = v.piece_at[state]
        done = np.flatnonzero(piece >= 0)
        starts.append(place[done])
        ends.append(place[done] + length)
        pieces.append(piece[done])
        covered[place[done][size_of[place[done]] == length]] = True
        room = place + length < unit_end[place]
        place, state = place[room], state[room]
        if not len(place):
            break
    lone = np.flatnonzero(char & ~covered)
    starts.append(lone)
    ends.append(lone + size_of[lone])
    pieces.append(np.full(len(lone), -1))
    start, stop, piece = (np.concatenate(x) for x in (starts, ends, pieces))
    order = np.argsort(stop, kind="stable")  # a few sorted runs, so this only merges them
    start, stop, piece = start[order], stop[order], piece[order]
    weight = v.weight[np.maximum(piece, 0)]
    weight[piece < 0] = (v.weight[v.first_byte] * (stop - start))[piece < 0]
    # forward: all units at once, by the distance of an edge's end from its unit's begin
    away = stop - unit_begin[start]
    far = int(away.max(initial=0))
    order = np.argsort(away.astype(np.uint16) if far < 1 << 16 else away, kind="stable")
    bounds = np.cumsum(np.bincount(away, minlength=far + 1))
    total = np.full(n + 1, -np.inf)  # by end place; a unit's begin counts as 0
    first = start == unit_begin[start]
    into = np.empty(len(start))
    for a, b in zip(bounds, bounds[1:]):
        if a == b:
            continue
        some = order[a:b]
        s, e = start[some], stop[some]
        value = weight[some] + np.where(first[some], 0.0, total[s])
        into[some] = value
        groups = np.flatnonzero(np.append(True, e[1:] != e[:-1]))
        most = np.maximum.reduceat(value, groups)
        sizes = np.diff(np.append(groups, b - a))
        total[e[groups]] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, sizes)), groups))
    share = np.exp(into - total[stop])
    at = np.searchsorted(stop, np.arange(n + 2))
    size = np.diff(at)
    more = np.flatnonzero(size > 1)
    k = 1
    while len(more):  # sums start anew for each place, so neighbours cannot change their last digits
        share[at[more] + k] += share[at[more] + k - 1]
        k += 1
        more = more[size[more] > k]
    return Lattice(at, start, piece, share)


def uniform(seeds: np.ndarray, unit: np.ndarray, step: int) -> np.ndarray:
    """A number from 0 to 1 for each (row seed, unit number, step)."""
    x = mix(seeds + _GOLDEN * (unit.astype(np.uint64) * _STEPS + np.uint64(step)))
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def row_seeds(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix(keys.view(np.uint64) ^ mix(np.array([seed], dtype=np.uint64)))


def _with_space(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text that is not empty gets a space before it."""
    size = np.diff(offsets)
    full = size > 0
    moved = np.append(0, np.cumsum(size + full))
    out = np.full(moved[-1], 32, np.uint8)
    inside = np.ones(moved[-1], bool)
    inside[moved[:-1][full]] = False
    out[inside] = data
    return moved, out


def _units(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin, and the number of the first unit of each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space, feed = data == 32, data == 10
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = space[1:] & ~space[:-1] | feed[1:] | feed[:-1]
    cut[offsets] = True
    begin = np.flatnonzero(cut[:-1])
    return begin, np.searchsorted(begin, offsets)


_rng = np.random.default_rng(8)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _distinct(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each different unit, and for every unit which one it equals."""
    size = np.diff(np.append(begin, len(data)))
    place = np.arange(len(data)) - np.repeat(begin, size)
    sums = np.add.reduceat(_BYTE[data] * _PLACE[place & 0xFFFF], begin)
    _, chosen, which = np.unique(mix(sums + size.astype(np.uint64)), return_index=True, return_inverse=True)
    return chosen, which


def encode_slice(v: Vocabulary, offsets: np.ndarray, data: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of the sampled pieces of the texts."""
    offsets, data = _with_space(offsets, data)
    begin, first = _units(offsets, data)
    if not len(begin):
        return np.zeros(len(offsets), np.int64), np.zeros(0, np.int32)
    chosen, which = _distinct(data, begin)
    size = np.diff(np.append(begin, len(data)))
    own_size = size[chosen]
    own_begin = np.cumsum(own_size) - own_size
    lat = lattice(
        v, data[np.arange(own_size.sum()) + np.repeat(begin[chosen] - own_begin, own_size)], own_begin, own_begin + own_size
    )
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    number = np.arange(len(begin)) - first[row]
    # all units are drawn at once, from their ends
    unit = np.arange(len(begin))
    here, low = (own_begin + own_size)[which], own_begin[which]
    drawn, step = [], 0
    counts = np.zeros(len(begin), np.int64)
    seed = seeds[row]
    while len(unit):
        u = uniform(seed, number, step)
        edge = lat.at[here]
        last = lat.at[here + 1] - 1
        more = np.flatnonzero((u >= lat.share[edge]) & (edge < last))
        while len(more):
            edge[more] += 1
            more = more[(u[more] >= lat.share[edge[more]]) & (edge[more] < last[more])]
        start, piece = lat.start[edge], lat.piece[edge]
        width = np.where(piece < 0, here - start, 1)
        drawn.append((unit, piece, here - low, width, counts[unit].copy()))
        counts[unit] += width
        going = np.flatnonzero(start > low)
        unit, here, low, seed, number = unit[going], start[going], low[going], seed[going], number[going]
        step += 1
    stop = np.cumsum(counts)
    ids = np.empty(int(stop[-1]), np.int32)
    for unit, piece, away, width, before in drawn:
        at = stop[unit] - before - width
        whole = piece >= 0
        ids[at[whole]] = piece[whole]
        lone = np.flatnonzero(~whole)
        for k in range(4):
            some = lone[width[lone] > k]
            ids[at[some] + k] = v.first_byte + data[begin[unit[some]] + away[some] - width[some] + k]
    return np.append(0, stop)[first], ids


def decode_slice(v: Vocabulary, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the texts; the space before each goes away."""
    size = np.array([len(t) for t in v.texts], np.int64)
    whole = np.frombuffer(b"".join(v.texts), np.uint8)
    place = np.cumsum(size) - size
    n = size[ids]
    stop = np.append(0, np.cumsum(n))
    out = whole[np.arange(stop[-1]) + np.repeat(place[ids] - stop[:-1], n)]
    bounds = stop[offsets]
    full = np.flatnonzero(np.diff(bounds) > 0)
    keep = np.ones(len(out), bool)
    keep[bounds[full]] = out[bounds[full]] != 32
    kept = np.append(0, np.cumsum(keep))
    return kept[bounds], out[keep]


SCHEMA = "doc_id long, n_bytes long, ids array<int>, lossless boolean"


def encoder(model_path: str, power: float, seed: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(model_path, power)
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for row, offsets, data in sliced(batch.column(2), _SLICE):
                n = len(offsets) - 1
                at, ids = encode_slice(v, offsets, data, row_seeds(keys[row : row + n], seed))
                back_at, back = decode_slice(v, at, ids)
                same = np.diff(back_at) == np.diff(offsets)
                if not (same.all() and np.array_equal(back, data)):
                    for i in np.flatnonzero(same):
                        same[i] = np.array_equal(back[back_at[i] : back_at[i + 1]], data[offsets[i] : offsets[i + 1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, n),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
                        pa.array(same),
                    ],
                    names=["doc_id", "n_bytes", "ids", "lossless"],
                )

    return encoded


def encode(df: DataFrame, model_path: str, power: float = POWER, seed: int = SEED) -> DataFrame:
    """(doc_id, n_bytes, ids, lossless) for each row of (doc_id, text); the row key is ``doc_id``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = pick(df, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id").alias("key"), text.alias("text")
    )
    return rows.mapInArrow(encoder(model_path, power, seed), SCHEMA)


def decoder(model_path: str):
    def decoded(batches):
        import pandas as pd

        v = load(model_path)
        for lists in batches:
            lists = [np.asarray(x if x is not None else [], np.int64) for x in lists]
            at = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int64)
            bounds, out = decode_slice(v, at, np.concatenate(lists) if lists else np.zeros(0, np.int64))
            data = out.tobytes()
            yield pd.Series([data[a:b].decode() for a, b in zip(bounds, bounds[1:])])

    return decoded


def decode(ids, model_path: str):
    """The texts of a column of ids."""
    from collections.abc import Iterator as It

    import pandas as pd

    made = decoder(model_path)
    made.__annotations__ = {"batches": It[pd.Series], "return": It[pd.Series]}
    return F.pandas_udf(made, "string")(ids)


ship(__name__)
