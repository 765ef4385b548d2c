"""Cross-tokenizer alignment with external spill counting.

Each text is cut by two tokenizers, A (byte-level pieces, a space before the
text) and B (sentence pieces, which add that space).  Byte offsets where tokens
of both end cut the text into groups; every A token of a group is linked with
every B token of it.  A pair's count is the number of documents that hold it
linked, and a link is a best one if no pair of its A id has a larger count.

Counting.  A task gathers the (pair, document) records of about ``RUN_BYTES``
of text, sorts them side-major (by A, then B, then document) and writes them as
zstd runs, one per radix of the A id: the pairs with their document counts, and
apart from them the documents.  A frequent pair is one entry of a run, however
many documents hold it, so no radix is filled by it.  Per radix a k-way heap
merge over the runs' pairs adds up the counts (in levels of at most ``FAN_IN``
runs) and, as the order is side-major, knows each A id's maximum when the next
one begins.  Then the counts stream back: each run's documents get their sums
over the run's radixes, again for at most ``FAN_IN`` runs in a task.  The runs
are rows of a table in the shared folder, so lost executors cost no counts.

Cases: null and empty texts, and texts whose tokens do not spell out a space
and the text, have no tokens: zeros and an empty digest.  Repeated rows count
as documents of their own.  A group of many tokens on both sides is counted by
its distinct ids, not link by link.  A very long text is a run of its own.  An
empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Text of a run, and of one call of the tokenizers.
RUN_BYTES = 8 << 20
CALL_BYTES = 1 << 20
DOC_BITS = 20
RADIXES = 64
FAN_IN = 256
#: Links of one group that are written out one by one.
SMALL_GROUP = 4096

#: Fixed value: how byte-level tokenizers cut a text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts that the rank encoder takes: its classes of these letters are the tokenizer's own.
RANKED, RANKED_LENGTH = re.compile("[^\0-\u024F]"), 1 << 16

DIGEST = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
RUN = "run long, local int, radix int, pairs binary, counts binary, docs binary, links binary"


def byte_level() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable bytes stand for
    themselves, the others for the code points from 256 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """One tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, encode, token_bytes: list[bytes]):
        self.encode, self.bytes = encode, token_bytes
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)

    def spells(self, ids: list[int], whole: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == whole


def ranked(path: str, token_bytes: list[bytes]):
    """The same tokenizer by its merges' ranks, which is four times as fast; None
    if the file has other rules or a merge whose id is not its rank."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    if rules["normalizer"] or rules["model"]["type"] != "BPE" or rules["pre_tokenizer"] != {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
        return None
    vocabulary = rules["model"]["vocab"]
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in rules["model"]["merges"]]
    if [vocabulary.get(m) for m in merges] != list(range(256, 256 + len(merges))):
        return None
    ranks = {token_bytes[i]: i for i in vocabulary.values()}
    return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@cache
def side_a(path: str) -> Side:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"   # the task's core is the only one
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    to_byte = byte_level()
    names = {i: n for n, i in t.get_vocab(with_added_tokens=True).items()}
    token_bytes = [bytes(to_byte[c] for c in names.get(i, "") if c in to_byte) for i in range(max(names) + 1)]
    quick = ranked(path, token_bytes)

    def encode(texts: list[str]) -> list[list[int]]:
        out = [quick(" " + x) if quick and len(x) < RANKED_LENGTH and not RANKED.search(x) else None for x in texts]
        others = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(others, t.encode_batch_fast([" " + texts[i] for i in others], add_special_tokens=False)):
            out[i] = e.ids
        return out

    return Side(encode, token_bytes)


@cache
def side_b(path: str) -> Side:
    import sentencepiece
    s = sentencepiece.SentencePieceProcessor(model_file=path)

    def spelled(i: int) -> bytes:
        piece = s.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if s.is_byte(i) else piece.replace("▁", " ").encode()

    return Side(lambda texts: s.encode(texts, num_threads=1), [spelled(i) for i in range(s.get_piece_size())])


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. for each of ``counts``, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Groups:
    """The groups of texts that lie one after the other, each with its doc number."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
        self.a, self.b = a, b
        at = np.searchsorted(ends_b, ends_a)
        shared = ends_b[at] == ends_a                     # the last ends are equal
        self.ends = ends_a[shared]                        # where groups end
        self.of_a = np.cumsum(shared) - shared
        self.of_b = np.searchsorted(self.ends, ends_b)
        self.n_a = np.bincount(self.of_a, minlength=len(self.ends))
        self.n_b = np.bincount(self.of_b, minlength=len(self.ends))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(group, a, b, links) of all pairs; pairs may come up several times."""
        first_a, first_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        size = self.n_a * self.n_b
        times = np.where(size <= SMALL_GROUP, self.n_b, 0)[self.of_a]
        b_at = np.repeat(first_b[self.of_a], times) + _within(times)
        out = [(np.repeat(self.of_a, times), np.repeat(self.a, times), self.b[b_at], np.ones(len(b_at), np.int64))]
        for g in np.flatnonzero(size > SMALL_GROUP).tolist():
            x, m = np.unique(self.a[first_a[g]:first_a[g] + self.n_a[g]], return_counts=True)
            y, n = np.unique(self.b[first_b[g]:first_b[g] + self.n_b[g]], return_counts=True)
            out.append((np.full(len(x) * len(y), g), np.repeat(x, len(y)), np.tile(y, len(x)), np.outer(m, n).ravel()))
        return tuple(np.concatenate(c) for c in zip(*out))

    def written(self, names: list[bytes], width: int) -> tuple[list[bytes], np.ndarray]:
        """The parts that spell ``;a1,a2|b1`` for each group, and the number of parts up to the end of each."""
        order = np.empty(len(self.a) + len(self.b), np.int64)
        upto_a, upto_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        first = np.r_[True, self.of_a[1:] != self.of_a[:-1]]
        order[np.arange(len(self.a)) + (upto_b - self.n_b)[self.of_a]] = self.a + np.where(first, width, 0)
        first = np.r_[True, self.of_b[1:] != self.of_b[:-1]]
        order[np.arange(len(self.b)) + upto_a[self.of_b]] = self.b + np.where(first, 2 * width, 0)
        return [names[i] for i in order.tolist()], upto_a + upto_b


class Runs:
    """Collects the records of texts and gives the rows of the runs."""

    def __init__(self, a_path: str, b_path: str, radixes: int):
        self.a, self.b = side_a(a_path), side_b(b_path)
        self.radixes, self.step = radixes, -(-len(self.a.bytes) // radixes)
        self.width = max(len(self.a.bytes), len(self.b.bytes))
        self.names = [b"%s%d" % (mark, i) for mark in (b",", b";", b"|") for i in range(self.width)]
        self.records: list[tuple[np.ndarray, np.ndarray]] = []

    def digest(self, texts: list[str], first: int) -> list[tuple]:
        """The DIGEST columns of the texts, which are documents ``first``, .. of the run."""
        out: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        kept, ids_a, ids_b = [], [], []
        for i, (x, y) in enumerate(zip(self.a.encode(texts), self.b.encode(texts))):
            whole = b" " + texts[i].encode()
            if self.a.spells(x, whole) and self.b.spells(y, whole):
                kept.append(i)
                ids_a.append(x)
                ids_b.append(y)
        if not kept:
            return out
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids))) for ids in (ids_a, ids_b))
        g = Groups(a, b, np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b]))
        last = np.cumsum([len(x) for x in ids_a])                      # A tokens up to each document's end
        upto = g.of_a[last - 1] + 1                                    # groups up to there
        doc = np.repeat(np.arange(len(kept)), np.diff(upto, prepend=0))
        links = np.bincount(doc, g.n_a * g.n_b, len(kept)).astype(np.int64)
        parts, ends = g.written(self.names, self.width)
        begin = 0
        for k, i in enumerate(kept):
            end = int(ends[upto[k] - 1])
            text = b"".join(parts[begin:end])[1:]
            begin = end
            out[i] = (len(ids_a[k]), len(ids_b[k]), int(upto[k] - (upto[k - 1] if k else 0)), int(links[k]),
                      hashlib.sha256(text).hexdigest())
        of, x, y, m = g.links()
        side = x % self.radixes * self.step + x // self.radixes         # the radix leads, then the id
        local = np.array(kept)[doc[of]] + first
        self.records.append(_summed((side * self.width + y << DOC_BITS) | local, m))
        return out

    def rows(self) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """(radix, pairs, counts, docs, links) of what was collected."""
        if self.records:
            keys, m = _summed(*(np.concatenate(c) for c in zip(*self.records)))
            pair = keys >> DOC_BITS
            radix = pair // (self.width * self.step)
            cuts = np.searchsorted(radix, np.arange(self.radixes + 1))
            for r in range(self.radixes):
                p = pair[cuts[r]:cuts[r + 1]]
                if len(p):
                    new = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
                    yield (r, pack(np.diff(p[new], prepend=0)), pack(np.diff(np.r_[new, len(p)])),
                           pack(keys[cuts[r]:cuts[r + 1]] & (1 << DOC_BITS) - 1), pack(m[cuts[r]:cuts[r + 1]]))
        self.records = []


def _summed(keys: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of m."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[new], np.add.reduceat(m[order], new)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers of 0 or more, in as few bytes each as hold them all, zstd over that."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if int(values.max(initial=0)) <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + zstandard.compress(values.astype(kind).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data[1:]), f"u{data[0]}").astype(np.int64)


def _encoder(a_path: str, b_path: str, radixes: int, key: pa.DataType):
    runs_of = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
    kinds = [key, *[pa.int64()] * 4, pa.string(), *runs_of]
    names = ["doc_id", *[c.split()[0] for c in f"{DIGEST}, {RUN}".split(", ")]]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(a_path, b_path, radixes)
        run, local, held = TaskContext.get().partitionId() << 32, 0, 0

        def written() -> pa.RecordBatch:
            return table([(None, 0, 0, 0, 0, "", run, -1, *r) for r in runs.rows()])

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                size, end = 0, at
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= CALL_BYTES):
                    size += len(texts[end] or "")
                    end += 1
                given = [t or "" for t in texts[at:end]]
                full = [i for i, t in enumerate(given) if t]
                told = dict(zip(full, _renumbered(runs, [given[i] for i in full], full, local)))
                yield table([(keys[at + i], *told.get(i, (0, 0, 0, 0, "")), run, local + i, None, None, None, None, None) for i in range(end - at)])
                local, held, at = local + end - at, held + size, end
                if held >= RUN_BYTES or local + len(texts) >= 1 << DOC_BITS:
                    if runs.records:
                        yield written()
                    run, local, held = run + 1, 0, 0
        if runs.records:
            yield written()

    return encode


def _renumbered(runs: Runs, texts: list[str], places: list[int], local: int) -> list[tuple]:
    """``digest`` of the texts that are not empty, under their places among all."""
    if not texts:
        return []
    before = len(runs.records)
    out = runs.digest(texts, 0)
    if len(runs.records) > before:
        keys, m = runs.records[-1]
        low = (1 << DOC_BITS) - 1
        runs.records[-1] = ((keys & ~low) | (np.array(places)[keys & low] + local), m)
    return out


def merged(streams: list[Iterator[tuple[int, int]]]) -> Iterator[tuple[int, int]]:
    """K-way heap merge of (pair, count) streams in order; counts of a pair add up."""
    for pair, same in groupby(heapq.merge(*streams), key=itemgetter(0)):
        yield pair, sum(count for _, count in same)


def _streams(pairs: list[bytes], counts: list[bytes]) -> list[Iterator[tuple[int, int]]]:
    return [zip(np.cumsum(unpack(p)).tolist(), unpack(c).tolist()) for p, c in zip(pairs, counts)]


def _merge_level(t: pa.Table) -> pa.Table:
    found = np.array(list(merged(_streams(t["pairs"].to_pylist(), t["counts"].to_pylist()))), np.int64).reshape(-1, 2)
    return pa.table({"radix": pa.array([t["radix"][0].as_py()], pa.int32()), "part": pa.array([t["part"][0].as_py()], pa.int64()),
                     "pairs": [pack(np.diff(found[:, 0], prepend=0))], "counts": [pack(found[:, 1])]})


def _contributions(width: int):
    """Per run the sums of its documents over one radix."""

    def contribute(runs: pa.Table, counted: pa.Table) -> pa.Table:
        pairs, counts = np.cumsum(unpack(counted["pairs"][0].as_py())), unpack(counted["counts"][0].as_py())
        side = np.flatnonzero(np.r_[True, pairs[1:] // width != pairs[:-1] // width])
        best = counts == np.repeat(np.maximum.reduceat(counts, side), np.diff(np.r_[side, len(pairs)]))
        out = []
        for run, *cols in zip(*(runs[c].to_pylist() for c in ("run", "pairs", "counts", "docs", "links"))):
            own, times, docs, links = map(unpack, cols)
            at = np.repeat(np.searchsorted(pairs, np.cumsum(own)), times)
            out.append((run, pack(_by_doc(docs, links * counts[at])), pack(_by_doc(docs, links * best[at]))))
        return pa.table({k: pa.array(v, kind) for k, v, kind in zip(("run", "sums", "best"), zip(*out), (pa.int64(), pa.binary(), pa.binary()))})

    return contribute


def _by_doc(docs: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums per document; in two halves, as bincount adds up as doubles."""
    low, high = values & (1 << 26) - 1, values >> 26
    return np.bincount(docs, low).astype(np.int64) + (np.bincount(docs, high).astype(np.int64) << 26)


def _totals(t: pa.Table) -> pa.Table:
    """The sums of one run's documents over all radixes."""
    cols = []
    for name in ("sums", "best"):
        parts = [unpack(x) for x in t[name].to_pylist()]
        total = np.zeros(max(map(len, parts)), np.int64)
        for p in parts:
            total[:len(p)] += p
        cols.append(total)
    n = len(cols[0])
    return pa.table({"run": pa.array([t["run"][0].as_py()] * n, pa.int64()), "local": pa.array(range(n), pa.int32()),
                     "count_sum": cols[0], "n_best": cols[1]})


def align(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", a_path: str = TOKENIZER_A,
          b_path: str = TOKENIZER_B, radixes: int = RADIXES) -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    from pyspark.sql.pandas.types import to_arrow_type
    given = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    key = given.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", key), *T.StructType.fromDDL(f"{DIGEST}, {RUN}").fields])
    written = materialize(given.mapInArrow(_encoder(a_path, b_path, radixes, to_arrow_type(key)), schema), "token_runs")
    texts, runs = written.where("local >= 0"), written.where("local < 0")
    n_runs = runs.select("run").distinct().count()
    parts = max(1, -(-n_runs // FAN_IN))
    runs = runs.withColumn("part", F.pmod(F.xxhash64("run"), F.lit(parts)))
    merge = "radix int, part long, pairs binary, counts binary"
    counted, level = runs.select("radix", "part", "pairs", "counts"), parts
    while True:
        counted = counted.groupBy("radix", "part").applyInArrow(_merge_level, merge)
        if level == 1:
            break
        level = -(-level // FAN_IN)
        counted = counted.withColumn("part", F.pmod(F.col("part"), F.lit(level)))
    counted = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    width = max(len(side_a(a_path).bytes), len(side_b(b_path).bytes))
    sums = (runs.groupBy("radix", "part").cogroup(counted.groupBy("radix", "part"))
            .applyInArrow(_contributions(width), "run long, sums binary, best binary")
            .groupBy("run").applyInArrow(_totals, "run long, local int, count_sum long, n_best long"))
    zero = F.lit(0).cast("long")
    return (texts.select("run", "local", "doc_id", *[c.split()[0] for c in DIGEST.split(", ")])
            .join(sums, ["run", "local"], "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"))
