"""SimHash near-duplicates by anchor-point covering.

The fingerprint of a text has bit b set when more than half of its 3-word
shingles' XXH64 values have it set.  Two fingerprints are linked when they
differ in at most ``THRESHOLD`` bits; linked documents form components.

Finding the links.  The anchors are the words of a covering code over the low
46 bits: two (23, 12) Golay codes side by side.  A Golay code is perfect with
covering radius 3, so each fingerprint has exactly one nearest anchor, its
home, at a distance of at most ``RADIUS`` = 6.  If x and y differ in at most 2
bits, y lies within ``RADIUS`` + 2 = 8 of the home of x.  So each distinct
fingerprint is replicated to every anchor within 8 (78 on average) and joined
there with the fingerprints at home; the pair is checked over all 64 bits.  A
pair x < y is met at the home of y alone, so links come out once.

Only distinct fingerprints take part: copies of a text meet in one row before
the search.  The join is Spark's, on the anchor, and can be split where an
anchor is crowded.  Components come from repeated minimum labels with pointer
jumping, each round a written table.

Cases: a null text is like an empty one, with fingerprint zero, linked like
any other.  A text of one or two words is one shingle.  component_id is the
smallest doc_id of the component, nulls aside (null if all are null).
``keep_one`` keeps, of each component, the row with that doc_id (of several
such rows the one with the smallest fingerprint, then with the smallest hash of
the text; of rows alike in all that, the first as they were read).  Other
columns pass through it unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, field, materialize, packed, unpacked

SHINGLE = 3
THRESHOLD = 2
SEED = 42
#: Generator polynomial of the (23, 12) Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011
BITS = 23
RADIUS = 6


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text as a signed 64-bit number."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and ASCII spaces only
    if not w:
        return 0
    n = max(1, len(w) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # bounded memory for very long texts
        hashes = [digest(b" ".join(w[i:i + SHINGLE]), SEED) for i in range(at, min(n, at + 65536))]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(">i8")[0])


def fingerprint_column(text: Column) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return of(text)


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Leader of each syndrome, and by leader (in ``leaders``' order) the code
    words within RADIUS + THRESHOLD of it, ordered by distance:
    starts[leader, distance] and, per code word, its value."""
    def syndrome(x: np.ndarray) -> np.ndarray:
        x = x.copy()
        for b in range(BITS - 1, 10, -1):
            x ^= np.where(x >> b & 1, GOLAY << (b - 11), 0)
        return x

    everything = np.arange(1 << BITS, dtype=np.int64)
    code = everything[syndrome(everything) == 0]
    weight = np.bitwise_count(everything.astype(np.uint32))
    light = everything[weight <= 3]
    leader = np.zeros(1 << 11, np.int64)
    leader[syndrome(light)] = light  # perfect: each syndrome has exactly one
    reach = RADIUS + THRESHOLD
    starts, near = np.zeros((1 << 11, reach + 2), np.int64), []
    total = 0
    for s in range(1 << 11):
        d = np.bitwise_count((code ^ leader[s]).astype(np.uint32))
        order = np.argsort(d, kind="stable")
        starts[s] = total + np.searchsorted(d[order], np.arange(reach + 2))
        near.append(code[order][:starts[s, -1] - total])
        total = starts[s, -1]
    # syndromes of 2^k are enough to compute any: the map is linear
    basis = syndrome(1 << np.arange(BITS, dtype=np.int64))
    return leader, starts, np.concatenate(near), basis


def _syndromes(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    s = np.zeros_like(x)
    for b in range(BITS):
        s ^= np.where(x >> b & 1, basis[b], 0)
    return s


def home_anchor(fps: np.ndarray) -> np.ndarray:
    """The one nearest anchor of each fingerprint (signed 64-bit)."""
    leader, _, _, basis = _golay()
    mask = (1 << BITS) - 1
    low, high = fps & mask, fps >> BITS & mask
    low, high = low ^ leader[_syndromes(low, basis)], high ^ leader[_syndromes(high, basis)]
    return high << BITS | low


def anchors_in_reach(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in ``fps`` and anchors, for all anchors within RADIUS + THRESHOLD."""
    leader, starts, near, basis = _golay()
    mask = (1 << BITS) - 1
    halves = []
    for half in (fps & mask, fps >> BITS & mask):
        s = _syndromes(half, basis)
        halves.append((half ^ leader[s], s))
    (low, s1), (high, s2) = halves
    reach = RADIUS + THRESHOLD
    for d in range(reach + 1):  # distance d in the low half, at most reach - d in the high one
        n1 = starts[s1, d + 1] - starts[s1, d]
        n2 = starts[s2, reach - d + 1] - starts[s2, 0]
        n = n1 * n2
        at = np.repeat(np.arange(len(fps)), n)
        if not len(at):
            continue
        k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        a = low[at] ^ near[starts[s1[at], d] + k // n2[at]]
        b = high[at] ^ near[starts[s2[at], 0] + k % n2[at]]
        yield at, b << BITS | a


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for i in range(0, len(every), 2000):
            fps = every[i:i + 2000]
            for at, anchors in anchors_in_reach(fps):
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(fps[at])], ["anchor", "fp"])


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(home_anchor(fps)), pa.array(fps)], ["anchor", "fp"])


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints ``fp`` -> all pairs a < b that differ in at most THRESHOLD bits."""
    visits = fps.mapInArrow(_visits, "anchor long, fp long")
    homes = fps.mapInArrow(_homes, "anchor long, fp long").withColumnRenamed("fp", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= THRESHOLD
    return (visits.withColumnRenamed("fp", "a").join(homes, "anchor")
            .where((F.col("a") < F.col("b")) & close).select("a", "b"))


def components(pairs: DataFrame) -> DataFrame:
    """Pairs a, b -> node, root: the smallest node that each one reaches.

    A round gives each node the smallest root among its neighbours', then the
    root of that root; paths of roots at least halve, and each round is stored."""
    both = materialize(pairs.union(pairs.select("b", "a")), "links")
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    while True:
        near = (both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("r")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r")))
        lower = roots.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "r").alias("root"))
        lower = materialize(lower, "lower")
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("r"))
        after = materialize(lower.join(jump, "root").select("node", "was", F.least("root", "r").alias("root")), "roots")
        roots = after.select("node", "root")
        if after.where("root <> was").isEmpty():
            return roots


def _grouped(rows: DataFrame, *ties: str) -> DataFrame:
    """Rows with _id and _fp -> per fingerprint: the first document of its
    component, by doc_id, nulls last, then by fingerprint, then by ``ties``."""
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_fp").alias("fp"), *ties))
    fps = materialize(rows.groupBy("_fp").agg(first.alias("first")), "fingerprints")
    roots = components(links(fps.select("_fp")))
    rooted = (fps.join(roots.withColumnRenamed("node", "_fp"), "_fp", "left")
              .select("_fp", "first", F.coalesce("root", "_fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("_first"))
    return rooted.join(least, "root").select(F.col("_fp").alias("_of"), "_first")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    rows = materialize(docs.select(F.col("doc_id").alias("_id"), fingerprint_column(F.col("text")).alias("_fp")), "simhash")
    grouped = _grouped(rows)
    return (rows.join(grouped, F.col("_fp") == F.col("_of"))
            .select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
                    F.col("_first.id").alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with its columns.  The rows are stored
    once with their fingerprints and numbers; which numbers stay is decided
    without the texts, and one join takes the rows."""
    text = field("text")
    rows = materialize(packed(docs).withColumns({"_n": F.monotonically_increasing_id(), "_id": field("doc_id"),
                                                 "_t": F.xxhash64(text), "_fp": fingerprint_column(text)}), "simhash_rows")
    firsts = _grouped(rows.select("_id", "_fp", "_t", "_n"), "_t", "_n").select(F.col("_first._n").alias("_n")).distinct()
    return unpacked(rows.join(firsts, "_n", "left_semi"))
