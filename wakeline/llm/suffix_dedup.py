"""Suffix-array dedup: repeated passages by column-wise multi-document construction.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier
(smaller doc_id, or same document and earlier start) is removed.

Pieces.  Among the ``GRAM``-byte grams of a string of ``LENGTH`` bytes the one
with the smallest hash, the leftmost of equals, is its anchor.  Equal strings
have equal anchors at equal distances, so strings need comparing only where
their anchors' hashes are equal, and there only at the same distance.  Strings
one after the other that share an anchor occurrence form a piece, some 140
bytes long; a text is cut into pieces that overlap.

Columns.  The pieces of one anchor are a collection, aligned at the anchor.  It
is built from the right, column by column: each round inserts one symbol per
piece before what it has so far, sorts the collection by (new symbol, order so
far), which is a stable sort, and takes the common prefix with the neighbour
from the round before (one more than the least between the two where the
symbols agree, else none).  The symbols before the sorted ones are that
column's part of the collection's Burrows-Wheeler transform.  Where the common
prefix reaches ``LENGTH``, neighbours start with equal strings; all but the
earliest of such a run are removed.  All collections of a task go through the
rounds together.  The external files are the sorted shuffle of the pieces,
read once in order; a task holds ``TOGETHER`` pieces or one collection.

Sides.  A string that begins at least ``HALF`` bytes before its anchor holds the
``HALF`` bytes before the anchor and the anchor, any other string the anchor and
the bytes up to ``LENGTH - HALF + 1`` from it on.  A piece has a hash of either
side that its strings need.  Only the strings of sides that another piece of
the anchor has too are asked for their bytes: short common phrases, of which
there are more the larger the table is, take no part in what follows.

Groups of any size.  Equal pieces of an Arrow batch are put together before
the shuffle, so a passage that a third of the documents share is one row per
batch; of equal pieces in different batches the earliest alone is ordered.  An
anchor with more than ``CROWDED`` different pieces left (the edge of a common
passage, with other text after it in every document) is no collection of its
own: each of its sides is one.  Sides that have more still are cut into their
single strings, each a collection under the string's hash, put together per
batch as above.

Cases: a null text is empty.  Among rows with one doc_id the order is that of
the texts' hashes; of rows alike in doc_id and text the first counts as
earlier, so the others lose every byte that is part of ``LENGTH`` bytes.  A
null doc_id is the last.  Texts are cut into overlapping slices, so very long
ones are nothing special.  An empty table gives no rows.  Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Fixed value: the least length of a repeat in bytes.
LENGTH = 100
GRAM = 16
WINDOW = LENGTH - GRAM + 1
HALF = WINDOW // 2
#: Bytes that are cut up at a time, as a power of two.
SLICE_BITS = 20
CROWDED = 2048
TOGETHER = 50_000
ODD1, ODD2, ODD3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: A place: doc_id, hash of the text, the first start, and how far the anchor and the last start are behind it.
PLACE = "t long, lo long, anchor int, starts int"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(29)
    x = x * ODD2
    x = x ^ x >> np.uint64(32)
    return x * ODD3


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on."""
    x = data.astype(np.uint64)
    for width in (1, 2, 4):
        x = x[:-width] | x[width:] << np.uint64(8 * width)
    return _mixed(x[:-8] * ODD1 ^ _mixed(x[8:]))


class _Powers:
    """Powers of an odd number and of its inverse, mod 2**64."""

    def __init__(self):
        n = (1 << SLICE_BITS) + LENGTH
        inverse = np.array([pow(int(ODD1), -1, 1 << 64)], np.uint64)
        self.up = np.cumprod(np.r_[np.uint64(1), np.repeat(ODD1, n)])
        self.down = np.cumprod(np.r_[np.uint64(1), np.repeat(inverse, n)])


def least_in_window(keys: np.ndarray, window: int) -> np.ndarray:
    """The least of each ``window`` keys in a row, by doubling."""
    width, least = 1, keys
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        n = len(keys) - window + 1
        least = np.minimum(least[:n], least[window - width:window - width + n])
    return least


def _sums(h: np.ndarray, powers: _Powers) -> np.ndarray:
    return np.r_[np.uint64(0), np.cumsum(h * powers.up[:len(h)])]


def sides(data: np.ndarray, first: np.ndarray, last: np.ndarray, anchor: np.ndarray, powers: _Powers) -> tuple[np.ndarray, ...]:
    """32 bits of a hash of the bytes that all strings share which begin ``HALF``
    bytes or more before the anchor, whether the piece has such strings, and both
    again for its other strings."""
    sums = _sums(gram_hashes(data), powers)
    far, near = anchor - first >= HALF, anchor - last < HALF

    def hashed(begin: np.ndarray, there: np.ndarray, grams: int) -> np.ndarray:
        begin = np.where(there, begin, 0)
        end = np.where(there, begin + grams, 0)
        return (_mixed((sums[end] - sums[begin]) * powers.down[begin]) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    return hashed(anchor - HALF, far, HALF + 1), far, hashed(anchor, near, WINDOW - HALF + 1), near


def cut(data: np.ndarray, begin: np.ndarray, size: np.ndarray, powers: _Powers) -> tuple[np.ndarray, ...]:
    """The pieces of slices that lie one after the other in ``data``: (slice,
    first start, last start, anchor, the anchor's hash, the content's hash)."""
    h = gram_hashes(data)
    low = np.uint64((1 << SLICE_BITS) - 1)
    anchor = (least_in_window(h & ~low | np.arange(len(h), dtype=np.uint64), WINDOW) & low).astype(np.int64)
    n = np.maximum(size - LENGTH + 1, 0)                # starts in each slice
    of = np.repeat(np.arange(len(size)), n)
    start = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    anchor = anchor[start]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])]) if len(of) else np.empty(0, np.int64)
    last = start[np.r_[new[1:], len(start)] - 1] if len(of) else new
    of, lo, anchor = of[new], start[new], anchor[new]
    sums = _sums(h, powers)
    content = _mixed((sums[last + WINDOW] - sums[lo]) * powers.down[lo] ^ _mixed(((anchor - lo) << 32 | last - lo).astype(np.uint64)))
    return of, lo, last, anchor, h[anchor], content


def _sliced(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, begin, size, text number, offset in the text) of slices, a bounded number of bytes at a time."""
    most = 1 << SLICE_BITS
    held, total = [], 0

    def packed():
        size = np.array([len(s) for s, _, _ in held])
        return (np.frombuffer(b"".join(s for s, _, _ in held), np.uint8), np.cumsum(size) - size, size,
                np.array([i for _, i, _ in held]), np.array([o for _, _, o in held]))

    for i, text in enumerate(texts):
        for o in range(0, len(text) - LENGTH + 1, most - LENGTH + 1):
            s = text[o:o + most]
            if held and total + len(s) > most:
                yield packed()
                held, total = [], 0
            held.append((s, i, o))
            total += len(s)
    if held:
        yield packed()


def _first_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers sorted by the keys, and whether all but the last two keys
    (the row's place) differ from the row before."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for k in keys[:-2]:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
    return order, new


def _ranks(ids: list, hashes: list) -> np.ndarray:
    """The documents' order: by doc_id, null last, then by hash; equal ones alike."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, hashes[i]))
    ranks, rank = np.zeros(len(ids), np.int64), 0
    for before, i in zip([None, *order], order):
        rank += before is not None and (ids[before], hashes[before]) != (ids[i], hashes[i])
        ranks[i] = rank
    return ranks


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _put_together(group: np.ndarray, content: np.ndarray, rank: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of rows alike in group and content the earliest, how many there are, and
    the rows that repeat it at another place."""
    order, new = _first_of(group, content, rank, lo)
    number = np.cumsum(new) - 1
    first = order[new]
    n = np.bincount(number, minlength=len(first))
    again = ~new & ((rank[order] != rank[first][number]) | (lo[order] != lo[first][number]))
    return first, n, order[again]


def _cutter(doc_type: pa.DataType):
    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            ids, hashes, texts = (batch.column(k) for k in range(3))
            found = []
            for data, begin, size, number, offset in _sliced(texts.to_pylist()):
                of, lo, last, anchor, h, c = cut(data, begin, size, powers)
                found.append((number[of], lo - begin[of] + offset[of], last - lo, anchor - lo, _signed(h), _signed(c),
                              *sides(data, lo, last, anchor, powers)))
            if not found:
                continue
            doc, lo, starts, anchor, h, c, left, far, right, near = (np.concatenate(x) for x in zip(*found))
            rank = _ranks(ids.to_pylist(), hashes.to_pylist())[doc]
            first, n, again = _put_together(h, c, rank, lo)
            # what repeats is dealt by itself: nothing else is asked of it
            rows, dealt = np.r_[first, again], np.r_[h[first], h[again] ^ _signed(_mixed((rank[again] << 24 ^ lo[again]).astype(np.uint64)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(dealt), pa.array(np.r_[c[first], c[again]]), pa.array(np.r_[n, np.zeros(len(again), np.int64)]), ids.take(pa.array(doc[rows])).cast(doc_type),
                 hashes.take(pa.array(doc[rows])), pa.array(lo[rows]), pa.array(anchor[rows].astype(np.int32)), pa.array(starts[rows].astype(np.int32)),
                 pa.array(left[rows], mask=~far[rows]), pa.array(right[rows], mask=~near[rows])],
                ["h", "c", "n", "d", "t", "lo", "anchor", "starts", "before", "after"])

    return cut_up


def _piecer(doc_type: pa.DataType):
    """The bytes of the pieces; crowded ones string by string.  Rows without
    bytes are starts already known to repeat."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            whole, single = [], []
            for i, (text, of) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                for p in of:
                    lo, end = p["lo"], p["lo"] + p["starts"]
                    if not p["crowded"]:
                        whole.append((p["h"], i, lo, p["anchor"], p["starts"], text[lo:end + LENGTH]))
                        continue
                    for s in range(lo, end + 1):
                        string = text[s:s + LENGTH]
                        key = int.from_bytes(hashlib.blake2b(string, digest_size=8, key=(lo + p["anchor"] - s).to_bytes(2)).digest(), "big", signed=True)
                        single.append((key, i, s, 0, 0, string))
            if single:
                keys, doc, lo = (np.array([s[k] for s in single], np.int64) for k in range(3))
                first, _, again = _put_together(keys, np.zeros(len(keys), np.int64), _ranks(ids, hashes)[doc], lo)
                whole += [single[i] for i in first.tolist()]
                whole += [(*single[i][:5], None) for i in again.tolist()]
            if whole:
                h, i, lo, anchor, starts, data = zip(*whole)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array([ids[k] for k in i], doc_type), pa.array([hashes[k] for k in i], pa.int64()), pa.array(lo, pa.int64()),
                     pa.array(anchor, pa.int32()), pa.array(starts, pa.int32()), pa.array(data, pa.binary())],
                    ["h", "d", "t", "lo", "anchor", "starts", "piece"])

    return pieces


def _least_between(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """min(values[begin:end]) for each pair, begin < end."""
    if not len(begin):
        return np.empty(0, values.dtype)
    bounds = np.empty(2 * len(begin), np.int64)
    bounds[::2], bounds[1::2] = begin, end
    return np.minimum.reduceat(np.append(values, 0), bounds)[::2]


def repeated_starts(pieces: list[bytes], groups: np.ndarray, anchors: np.ndarray, ages: np.ndarray) -> np.ndarray:
    """[piece, k] is True if the string at ``anchor - k`` bytes before the
    anchor starts an earlier piece of the group too (a smaller age).

    ``groups`` are in ascending order.  Round by round, from the right."""
    n, sizes = len(pieces), np.array([len(p) for p in pieces])
    right = sizes - anchors                                   # bytes from the anchor on
    most_left, most_right = int(anchors.max()), int(right.max())
    width = most_left + most_right
    symbols = np.zeros((n, width), np.uint16)                 # 0: no symbol
    column = np.arange(width)
    begin = most_left - anchors
    inside = (column >= begin[:, None]) & (column < (begin + sizes)[:, None])
    symbols[inside] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 1
    symbols = np.ascontiguousarray(symbols.T)
    order, common = np.arange(n), np.zeros(n, np.int64)       # common: with the one before in order
    place = groups[order].astype(np.int64) << 9
    removed = np.zeros((n, most_left + 1), bool)
    for t in range(width - 1, -1, -1):
        symbol = symbols[t][order].astype(np.int64)
        moved = np.argsort(place | symbol, kind="stable")     # old places in the new order
        key = (place | symbol)[moved]
        same = np.flatnonzero((key[1:] == key[:-1]) & (key[1:] & 511 > 0)) + 1
        fresh = np.zeros(n, np.int64)
        fresh[same] = 1 + _least_between(common, moved[same - 1] + 1, moved[same] + 1)
        order, common = order[moved], fresh
        if t <= most_left:
            run = np.flatnonzero(common < LENGTH)              # runs of equal strings begin here
            if len(run) < n:
                age = ages[order]
                oldest = np.repeat(np.minimum.reduceat(age, run), np.diff(np.r_[run, n]))
                removed[order, most_left - t] = age > oldest
    return removed


def _collator(doc_type: pa.DataType):
    names = ["h", "d", "t", "lo", "anchor", "starts", "piece"]

    def ordered(rows: list[tuple]) -> list[tuple]:
        """(d, t, first start, last start) of repeated strings in whole collections."""
        rows.sort(key=lambda r: (r[0], r[1] is None, r[1] if r[1] is not None else 0, r[2], r[3] + r[4]))
        h = np.array([r[0] for r in rows], np.int64)
        groups = np.cumsum(np.r_[0, h[1:] != h[:-1]])
        place = [(r[0], r[1], r[2], r[3] + r[4]) for r in rows]
        ages = np.cumsum([0, *(x != y for x, y in zip(place, place[1:]))])   # a row that came twice is one place
        anchors = np.array([r[4] for r in rows])
        removed = repeated_starts([r[6] for r in rows], groups, anchors, ages)
        # in column k the piece's start is anchor - k
        edge = np.diff(np.pad(removed, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        who, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        return [(rows[i][1], rows[i][2], rows[i][3] + int(anchors[i]) - e + 1, rows[i][3] + int(anchors[i]) - b)
                for i, b, e in zip(who.tolist(), begin.tolist(), end.tolist())]

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (doc_type, pa.int64(), pa.int64(), pa.int64()))], ["d", "t", "a", "b"])

    def collate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = [], []
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in names)))
            known += [(r[1], r[2], r[3], r[3] + r[5]) for r in rows if r[6] is None]
            held += [r for r in rows if r[6] is not None]
            if len(held) >= TOGETHER and held[0][0] != held[-1][0]:
                whole = next(i for i in range(len(held) - 1, 0, -1) if held[i - 1][0] != held[-1][0])
                known += ordered(held[:whole])
                held = held[whole:]
            if known:
                yield table(known)
                known = []
        if held and (known := ordered(held)):
            yield table(known)

    return collate


def _covered(starts: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under strings that start in the ranges (last included)."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(starts):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b + LENGTH))
        else:
            out.append((a, b + LENGTH))
    return out


def _kept(doc_type: pa.DataType):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, copy, found in zip(*(batch.column(k).to_pylist() for k in ("d", "text", "copy", "found"))):
                text = text or b""
                starts = [(p["a"], p["b"]) for p in found or ()] if copy == 1 else [(0, len(text) - LENGTH)] * (len(text) >= LENGTH)
                spans = _covered(starts, len(text))
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                out.append((doc, len(text), sum(b - a for a, b in spans), len(spans), digest.hexdigest(),
                            [{"begin": a, "end": b} for a, b in spans]))
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            kinds = [doc_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), span]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return kept


def repeats(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans
    (begin, end exclusive) of the bytes that are removed."""
    from pyspark.sql.pandas.types import to_arrow_type
    # the text goes by as bytes; t is its hash, k and t are the document's key from here on
    texts = docs.select(F.col(doc_col).alias("d"), F.xxhash64(doc_col).alias("k"), F.xxhash64(text_col).alias("t"), F.col(text_col).cast("binary").alias("text"))
    kind = texts.schema["d"].dataType
    arrow, d = to_arrow_type(kind), f"d {kind.simpleString()}"
    places = (texts.where(F.octet_length("text") >= LENGTH).select("d", "t", "text")
              .mapInArrow(_cutter(arrow), f"h long, c long, n long, {d}, {PLACE}, before int, after int").repartition("h"))

    def alike(*by: str):
        return F.sum((~F.col("again")).cast("int")).over(Window.partitionBy(*by))

    # one shuffle: all windows find the rows of an anchor together
    place = F.struct(F.col("d").isNull().alias("null"), "d", "t", "lo")
    seen = (places.withColumn("first", F.min(F.when(F.col("n") > 0, place)).over(Window.partitionBy("h", "c")))
            .withColumn("again", (F.col("n") == 0) | (place != F.col("first")))
            .withColumn("pieces", alike("h")).where("again OR pieces > 1")
            .withColumn("left", alike("h", "before")).withColumn("right", alike("h", "after"))
            .withColumn("far", F.expr("before IS NOT NULL AND left > 1")).withColumn("near", F.expr("after IS NOT NULL AND right > 1"))
            .where("again OR far OR near").withColumn("pieces", alike("h")))
    crowded = F.col("pieces") > CROWDED
    skipped = F.greatest(F.col("anchor") - (HALF - 1), F.lit(0))      # starts before the near ones

    def part(h, lo, anchor, starts, crowded):
        return F.struct(h.alias("h"), lo.alias("lo"), anchor.cast("int").alias("anchor"), starts.cast("int").alias("starts"), crowded.alias("crowded"))

    whole = part(F.col("h"), F.col("lo"), F.col("anchor"), F.col("starts"), F.lit(False))
    far = part(F.when(crowded, F.xxhash64("h", "before", F.lit(0))).otherwise(F.col("h")), F.col("lo"), F.col("anchor"),
               F.least("starts", F.col("anchor") - HALF), crowded & (F.col("left") > CROWDED))
    near = part(F.when(crowded, F.xxhash64("h", "after", F.lit(1))).otherwise(F.col("h")), F.col("lo") + skipped, F.col("anchor") - skipped,
                F.col("starts") - skipped, crowded & (F.col("right") > CROWDED))
    together = F.col("again") | (F.col("far") & F.col("near") & ~crowded)
    parts = F.array_compact(F.array(F.when(together, whole), F.when(~together & F.col("far"), far), F.when(~together & F.col("near"), near)))
    seen = materialize(seen.select("d", "t", "again", F.explode(parts).alias("part")).select("d", "t", "again", "part.*"),
                       "places", keep_shuffles=False)
    key = [F.xxhash64("d").alias("k"), "t"]
    wanted = (seen.where(~F.col("again")).groupBy(*key)
              .agg(F.collect_set(F.struct("h", "lo", "anchor", "starts", "crowded")).alias("of")))
    pieces = (texts.join(wanted, ["k", "t"]).select("d", "t", "text", "of")
              .mapInArrow(_piecer(arrow), f"h long, {d}, {PLACE}, piece binary"))
    ordered = (pieces.repartition("h").sortWithinPartitions("h")
               .mapInArrow(_collator(arrow), f"{d}, t long, a long, b long"))
    known = seen.where("again").select("d", "t", F.col("lo").alias("a"), (F.col("lo") + F.col("starts")).alias("b"))
    found = ordered.unionByName(known).groupBy(*key).agg(F.collect_list(F.struct("a", "b")).alias("found"))
    # of rows alike in doc_id and text one is the earlier
    copies = Window.partitionBy("k", "t").orderBy(F.lit(1))
    return (texts.join(found, ["k", "t"], "left").withColumn("copy", F.row_number().over(copies))
            .select("d", "text", "copy", "found")
            .mapInArrow(_kept(arrow), f"doc_id {kind.simpleString()}, n_bytes long, n_removed long, n_spans long, "
                                      "kept_sha256 string, spans array<struct<begin:long,end:long>>"))
