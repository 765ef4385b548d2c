"""Benchmark decontamination by q-gram lemma filtering.

Texts are lower-cased and their white space becomes single spaces.  A benchmark
item is cut into overlapping patterns of ``PATTERN`` characters (every
``STRIDE``, and one at the end), so each passage of 150 characters holds a whole
pattern; a shorter item is one pattern.  A document is contaminated where a
region is within k = ``RATE`` x length edits of a pattern.  An item under
``SHORTEST`` characters leaves the lemma no q-grams to count: it is found where
its words stand exactly, one after the other.  Equal patterns are searched for
once, whatever the number of items that hold them.

Such a region shares at least m - Q + 1 - kQ character q-grams with a pattern of
length m, on diagonals (place in the document less place in the pattern) that
lie within k of one another.  So shared q-grams are counted in diagonal bands
of width 2(k + 1) that overlap by half, each k + 1 neighbouring diagonals
being whole in one of them.  Bands that reach the bound are verified by banded
alignment (edit distance, the region free in its band).  A text is gone through
from left to right, at most ``PLACES`` places of shared q-grams at a time; a
band whose last place is passed is judged and forgotten, so a q-gram that all
items share, or a text of one repeated word, fills no memory.

Documents are read in one pass, without a shuffle; the benchmark is handed out
in blocks of about ``BLOCK`` characters, one pass each.  A block's results are
stored and its broadcast is dropped before the next one is collected, so
neither driver nor tasks hold more than one.

Cases: null texts are empty and match nothing.  Repeated documents get a row
each, repeated items too, whatever their ids.  An empty benchmark contaminates
nothing, an item without words is found nowhere.  A null doc_id or item_id is
returned as null.  ``keep_clean`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, field, materialize, packed, unpacked

Q = 8
PATTERN = 100
STRIDE = 50
SHORTEST = 40
RATE = 0.1
BLOCK = 4_000_000
#: Places of shared q-grams that are expanded at a time.
PLACES = 1 << 20
#: Slots of the first test of a q-gram hash, and characters per vector.
SLOTS = 1 << 22
CHUNK = 1 << 20

MATCH = "item_id long, first int, last int, n_patterns int, edits int"


class Patterns(NamedTuple):
    """One block of the benchmark, ready to be searched for."""
    ids: list  # item_id of each item
    items: list[list[int]]  # of each pattern, the items that hold it, as often as they do
    short: tuple[tuple[str, int], ...]  # items that are found by their words, and their numbers
    item: list  # of each pattern, the item_id of the first of them
    codes: list[np.ndarray]  # its characters
    length: np.ndarray
    budget: np.ndarray
    least: np.ndarray  # q-grams that a region within the budget shares
    slots: np.ndarray  # whether any q-gram hash falls in a slot
    hashes: np.ndarray  # distinct, sorted
    starts: np.ndarray  # of a hash's places
    pattern: np.ndarray  # by place
    offset: np.ndarray


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each q-gram (Q = 8, by doubling)."""
    h = codes.astype(np.uint64)
    for width, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9)):
        h = h[:-width] * np.uint64(factor) + h[width:]
        h ^= h >> np.uint64(29)
    return h


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(42)).astype(np.int64)


def index_items(items: list[tuple]) -> Patterns:
    """(item_id, text) pairs -> the patterns and their q-gram index."""
    holders: dict[bytes, list[int]] = {}
    short = []
    for number, (_, text) in enumerate(items):
        plain = normal(text)
        c = _codes(plain)
        if len(c) < SHORTEST:
            short += [(plain, number)] * bool(plain)
            continue
        last = max(0, len(c) - PATTERN)
        for at in sorted({*range(0, last, STRIDE), last}):
            holders.setdefault(c[at:at + PATTERN].tobytes(), []).append(number)
    ids, codes = [item_id for item_id, _ in items], [np.frombuffer(x, np.uint32) for x in holders]
    budget = np.array([int(RATE * len(c)) for c in codes], np.int64)
    least = np.array([len(c) - Q + 1 - b * Q for c, b in zip(codes, budget)], np.int64)
    grams = [_hashes(c) for c in codes] or [np.zeros(0, np.uint64)]
    every = np.concatenate(grams)
    pattern = np.repeat(np.arange(len(codes)), [len(g) for g in grams[:len(codes)]])
    offset = np.concatenate([np.arange(len(g)) for g in grams])
    order = np.argsort(every, kind="stable")
    hashes, starts = np.unique(every[order], return_index=True)
    slots = np.zeros(SLOTS, bool)
    slots[_slot(hashes)] = True
    return Patterns(ids, list(holders.values()), tuple(short), [ids[of[0]] for of in holders.values()], codes, np.array([len(c) for c in codes], np.int64), budget, least, slots, hashes, np.append(starts, len(every)),
                    pattern[order].astype(np.int64), offset[order].astype(np.int64))


def _shared(codes: np.ndarray, p: Patterns) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(pattern, diagonal) of the q-grams that the text shares with patterns,
    from left to right, and the place up to which they are complete."""
    for at in range(0, max(0, len(codes) - Q + 1), CHUNK):
        h = _hashes(codes[at:at + CHUNK + Q - 1])
        place = np.flatnonzero(p.slots[_slot(h)])
        found = np.minimum(np.searchsorted(p.hashes, h[place]), len(p.hashes) - 1)
        real = p.hashes[found] == h[place]
        place, found = place[real], found[real]
        n = p.starts[found + 1] - p.starts[found]
        upto = np.cumsum(n)
        begin = 0
        while begin < len(place):       # some places at a time, one at least
            end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PLACES, side="right")))
            m = n[begin:end]
            k = np.repeat(p.starts[found[begin:end]], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            yield p.pattern[k], np.repeat(place[begin:end] + at, m) - p.offset[k], at + (int(place[end]) if end < len(place) else CHUNK)
            begin = end


def _bands(codes: np.ndarray, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, first diagonal) of the bands that reach the bound."""
    base = PATTERN  # diagonals begin at -PATTERN
    none = np.zeros(0, np.int64)
    held, counts, hits = none, none, [none]

    def judged(key: np.ndarray, n: np.ndarray) -> np.ndarray:
        # a band is two neighbouring half bands, so every half counts in two
        follows = np.minimum(np.searchsorted(key, key + 1), max(len(key) - 1, 0))
        both = n + np.where(key[follows] == key + 1, n[follows], 0)
        # a half band without one before it also ends the band that begins empty; its count is no larger than its own band's
        return both >= p.least[key >> 40]

    for pattern, diagonal, done in _shared(codes, p):
        cell = diagonal // (p.budget[pattern] + 1)  # floor, also below zero
        key, n = np.unique(pattern << 40 | (cell + base), return_counts=True)
        both = np.concatenate([held, key])
        held, at = np.unique(both, return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, n]), len(held)).astype(np.int64)
        # a half band stays until all places of the band that it begins are passed (the half after it stays longer)
        width = p.budget[held >> 40] + 1
        begin = ((held & ((1 << 40) - 1)) - base) * width
        over = begin + 2 * width + p.length[held >> 40] <= done
        hits.append(held[judged(held, counts) & over])
        held, counts = held[~over], counts[~over]
    hits.append(held[judged(held, counts)] if len(held) else none)
    hit = np.unique(np.concatenate(hits))
    pattern, cell = hit >> 40, (hit & ((1 << 40) - 1)) - base
    return pattern, cell * (p.budget[pattern] + 1)


def align(text: np.ndarray, patterns: np.ndarray, first: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits of each of ``patterns`` (rows of one length) against a region
    of the text whose diagonals lie in the band from ``first`` (width
    2(budget + 1), and ``budget`` more on either side): edits, starts, ends."""
    n, m = patterns.shape
    width = 2 * (budget + 1) + 2 * budget
    low = (first - budget)[:, None]
    j = np.arange(width, dtype=np.int32)
    place = low + np.arange(width + m)  # before row r the cell j stands at place j + r of the text
    within = (place >= 0) & (place < len(text))
    near = np.where(within, text[np.clip(place, 0, len(text) - 1)], np.uint32(0xFFFFFFFF))
    stands = (place >= 0) & (place <= len(text))
    far = np.int32(1 << 20)
    cost = np.where(stands[:, :width], np.int32(0), far)
    start = np.broadcast_to(j, cost.shape)  # where the region begins: the cell of row 0
    edge = np.full((n, 1), far)
    for r in range(m):
        step = cost + (near[:, r:r + width] != patterns[:, r:r + 1])  # along the diagonal
        up = np.concatenate([cost[:, 1:], edge], axis=1) + 1  # the pattern's character is not in the text
        better = up < step
        step = np.where(better, up, step)
        origin = np.where(better, np.concatenate([start[:, 1:], start[:, -1:]], axis=1), start)
        # characters of the text that the pattern lacks: the best cell to the left plus the way from there
        best = np.minimum.accumulate(step - j, axis=1)
        came = np.maximum.accumulate(np.where(step - j == best, j, 0), axis=1)
        cost = np.where(stands[:, r + 1:r + 1 + width], best + j, far)
        start = np.take_along_axis(origin, came, axis=1)
    at = cost.argmin(axis=1)
    rows = np.arange(n)
    return cost[rows, at], low[:, 0] + start[rows, at], low[:, 0] + at + m


def _verified(codes: np.ndarray, p: Patterns) -> Iterator[tuple[int, int, int, int]]:
    """(pattern, edits, start, end) of the bands that hold a region within the budget."""
    pattern, first = _bands(codes, p)
    for m in np.unique(p.length[pattern]):
        mine = np.flatnonzero(p.length[pattern] == m)
        for at in range(0, len(mine), 2048):
            k = mine[at:at + 2048]
            budget = int(RATE * m)
            edits, start, end = align(codes, np.stack([p.codes[i] for i in pattern[k]]), first[k], budget)
            good = edits <= budget
            yield from zip(pattern[k][good].tolist(), edits[good].tolist(), start[good].tolist(), end[good].tolist())


def _batches(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts side by side in batches of about CHUNK characters."""
    which, codes, size = [], [], 0
    for k, t in enumerate(texts):
        c = _codes(normal(t))
        if len(c) < Q:
            continue
        which.append(k)
        codes.append(c)
        size += len(c)
        if size >= CHUNK:
            yield which, codes
            which, codes, size = [], [], 0
    if which:
        yield which, codes


def matches(texts: list[str | None], p: Patterns) -> list[list[dict]]:
    """For each text, per benchmark item found in it: where, by how many
    patterns, and the fewest edits of one.  Places count characters of the
    normal form.  Texts are searched side by side, with more characters that
    match nothing in between than any budget."""
    out: list[list[dict]] = [[] for _ in texts]
    for k, number, at, end in _exact(texts, p.short):
        out[k].append({"item_id": p.ids[number], "first": at, "last": end, "n_patterns": 1, "edits": 0})
    if not p.codes:
        return out
    gap = np.full(int(RATE * PATTERN) + Q, 0x110000, np.uint32)
    for which, codes in _batches(texts):
        starts = np.cumsum([0] + [len(c) + len(gap) for c in codes[:-1]])
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for pattern, *hit in _verified(np.concatenate([x for c in codes for x in (c, gap)]), p):
            k = int(np.searchsorted(starts, (hit[1] + hit[2]) // 2, side="right")) - 1
            hit = (hit[0], max(0, hit[1] - int(starts[k])), min(len(codes[k]), hit[2] - int(starts[k])))
            if (k, pattern) not in found or hit < found[k, pattern]:
                found[k, pattern] = hit
        items: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for (k, pattern), hit in found.items():
            for number in p.items[pattern]:
                items.setdefault((which[k], number), []).append(hit)
        for (k, number), hits in items.items():
            out[k].append({"item_id": p.ids[number], "first": min(h[1] for h in hits), "last": max(h[2] for h in hits),
                           "n_patterns": len(hits), "edits": min(h[0] for h in hits)})
    return out


@lru_cache(2)
def _words_of(short: tuple[tuple[str, int], ...]):
    """Finds the short items' words, with spaces around them."""
    numbers: dict[str, list[int]] = {}
    for text, number in short:
        numbers.setdefault(f" {text} ", []).append(number)
    machine = ahocorasick.Automaton()
    for key, of in numbers.items():
        machine.add_word(key, (len(key) - 2, of))
    machine.make_automaton()
    return machine


def _exact(texts: list[str | None], short: tuple[tuple[str, int], ...]) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, start, end) of the first place of each short item in each text."""
    if not short:
        return
    machine = _words_of(short)
    for k, text in enumerate(texts):
        seen = set()
        for end, (size, of) in machine.iter(f" {normal(text)} "):
            for number in of:
                if number not in seen:
                    seen.add(number)
                    yield k, number, end - 1 - size, end - 1


def blocks(benchmark: DataFrame) -> Iterator[Patterns]:
    """The benchmark in blocks of about BLOCK characters."""
    size = F.length(F.coalesce("text", F.lit("")))
    items = benchmark.select("item_id", "text")
    total = items.agg(F.sum(size)).first()[0] or 0
    n = -(-total // BLOCK) or 1
    for k in range(n):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield index_items([(r["item_id"], r["text"]) for r in mine.collect()])


def _matcher(shared) -> Callable:
    @F.pandas_udf(f"array<struct<{MATCH.replace(' long', ':long').replace(' int', ':int')}>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series(matches(list(texts), shared.value), dtype="object")

    return found


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and each benchmark item found in it."""
    out = None
    for p in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(p)
        part = materialize(docs.select("doc_id", "text").mapInArrow(_finder(shared), f"doc_id long, {MATCH}"), "found")
        shared.destroy()
        out = part if out is None else out.unionAll(part)
    return out


def _finder(shared) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
                        ("n_patterns", pa.int32()), ("edits", pa.int32())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = matches(batch.column(1).to_pylist(), shared.value)
            rows = [{"doc_id": doc_id, **m} for doc_id, ms in zip(batch.column(0).to_pylist(), found) for m in ms]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return search


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark passage, with their columns."""
    rows, before = packed(docs), None
    for p in blocks(benchmark):
        if before is not None:      # what an earlier block leaves is stored, so that the block can go
            rows = materialize(rows, "clean")
            before.destroy()
        before = docs.sparkSession.sparkContext.broadcast(p)
        rows = rows.where(F.size(_matcher(before)(field("text"))) == 0).select(ROW)
    return unpacked(rows)
