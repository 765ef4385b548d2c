"""Spelling variant grouping by dense prefix-suffix tiling.

Words are the letter runs of all texts, counted over the corpus.  Two words are
near if they differ by exactly one inserted, deleted or replaced code point,
that is, if their common prefix and common suffix together reach the longer
length minus one.  A word's form is its near word of largest count, if that is
at least ``RATIO`` times the word's own; its root is where the forms lead.

Tiles.  Let L be the longer length of a near pair.  As prefix and suffix add up
to L - 1 or more, one of them has L // 2 code points at least.  So a pair needs
looking for among words alike in their first L // 2 code points, or in their
last, and words are dealt by (L, side, hash of that half) into buckets of about
``BLOCK`` words.  A bucket of more than twice that (a crowded half) is cut into
blocks, and each pair of its blocks is a tile.  A tile holds its words as
padded code-point matrices, left- and right-aligned, and compares all of one
side with all of the other, column by column.  A pair is counted on the prefix
side if the common prefix reaches L // 2, else on the suffix side: once.

All counts are Spark's (partial sums before the shuffle), a task holds one tile,
and the roots come from pointer doubling over written tables: counts grow by
``RATIO`` with each step, so few rounds reach every root.

Cases: a null text has no words, a null doc_id counts as ''.  Repeated rows all
count.  Words of any length take part; long ones make blocks of fewer words.
An empty table, or one without words that occur often enough, gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: The letters, and the share of runs that lose a code point.
NOT_LETTERS = "[^A-Za-zÀ-ÿ]+"
DEALT = 199
LEAST = 6
OFTEN = 5
RATIO = 5
#: Words of a block, and the code points that its matrix may hold.
BLOCK = 512
CELLS = 1 << 22
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(run: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does that where all is ASCII."""
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def occurrences(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per letter run: the word it stands for, dealt deletions made."""
    runs = docs.select(F.coalesce(F.col(doc_col).cast("string"), F.lit("")).alias("d"),
                       F.explode(F.split(text_col, NOT_LETTERS)).alias("r")).where("r <> ''")
    runs = runs.select("d", lowered(F.col("r")).alias("r"))
    dealt = runs.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "r").cast("binary")))
    cut = F.expr("concat(substring(r, 1, cast(h % length(r) as int)), substring(r, cast(h % length(r) as int) + 2))")
    return dealt.select(F.when(F.col("h") % DEALT == 0, cut).otherwise(F.col("r")).alias("word"))


def word_counts(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of words long and frequent enough."""
    return (occurrences(docs, doc_col, text_col).where(F.length("word") >= LEAST)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= OFTEN))


def _dealt(words: DataFrame) -> DataFrame:
    """Each word in every tile where a near word of it may be met."""
    own = F.length("word")
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(CELLS) / F.col("longer"))))
    sides = (words.select("word", "n", F.explode(F.array(own, own + 1)).alias("longer"))
             .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
             .withColumn("half", F.expr("xxhash64(if(side = 0, left(word, longer div 2), right(word, longer div 2)))")))
    sizes = sides.groupBy("longer", "side").agg(F.ceil(F.count(F.lit(1)) / F.first(block)).alias("buckets"))
    members = (sides.join(sizes, ["longer", "side"])
               .withColumn("bucket", F.expr("pmod(half, buckets)")).drop("half", "buckets"))
    cuts = (members.groupBy("longer", "side", "bucket")
            .agg(F.ceil(F.count(F.lit(1)) / (2 * F.first(block))).alias("parts")))
    return (members.join(cuts, ["longer", "side", "bucket"])
            .withColumn("part", F.expr("pmod(xxhash64(word), parts)"))
            .withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
            .select("longer", "side", "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                    "part", "word", "n"))


def _codes(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points, a row per word; the padding is 0."""
    padded = [w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).reshape(len(words), width)
    return np.ascontiguousarray((codes.astype(np.uint8) if codes.max(initial=0) < 256 else codes).T)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of each column of a with each of b."""
    alive = np.ones((a.shape[1], b.shape[1]), bool)
    length = np.zeros(alive.shape, np.int32)
    for x, y in zip(a, b):
        alive &= x[:, None] == y[None, :]
        if not alive.any():
            break
        length += alive
    return length


def compare_tile(longer: int, side: int, words: list[str], parts: np.ndarray) -> np.ndarray:
    """near[x, y] for words x of length ``longer`` (rows of the others are
    empty) and all words y, of length ``longer`` or one less."""
    lengths = np.array([len(w) for w in words])
    rows = np.flatnonzero(lengths == longer)
    left, right = _codes(words, longer, False), _codes(words, longer, True)
    prefix = _common(left[:, rows], left)
    pairs = prefix >= longer // 2 if side == 0 else prefix < longer // 2
    pairs &= prefix + _common(right[::-1][:, rows], right[::-1]) >= longer - 1
    pairs &= rows[:, None] != np.arange(len(words))
    if parts.min() < parts.max():
        pairs &= parts[rows][:, None] != parts[None, :]
    near = np.zeros((len(words), len(words)), bool)
    near[rows] = pairs
    return near | near.T


def _tile(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["n", "word"], ascending=[False, True])
    near = compare_tile(int(pdf["longer"].iloc[0]), int(pdf["side"].iloc[0]), pdf["word"].tolist(), pdf["part"].to_numpy())
    links, best = near.sum(1), near.argmax(1)       # sorted, so the first near word is the best
    out = pd.DataFrame({"word": pdf["word"].to_numpy(), "links": links, "best": pdf["word"].to_numpy()[best],
                        "best_n": pdf["n"].to_numpy()[best]})
    return out[out["links"] > 0]


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root): forms followed to the last, by pointer doubling."""
    steps = max(1, math.ceil(math.log(max(most, RATIO), RATIO)))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        to = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        forms = materialize(forms.join(to, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return forms


def variants(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n and root of every word."""
    words = materialize(word_counts(docs, doc_col, text_col), "words")
    met = (_dealt(words).groupBy("longer", "side", "bucket", "i", "j")
           .applyInPandas(_tile, "word string, links long, best string, best_n long"))
    near = (met.groupBy("word").agg(F.sum("links").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("top")))
    is_form = -F.col("top.m") >= RATIO * F.col("n")
    grouped = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("top.best")).alias("form"), F.when(is_form, -F.col("top.m")).alias("form_n")), "near_words")
    most = grouped.agg(F.max("n")).first()[0] or 1
    roots = _roots(grouped.where("form IS NOT NULL").select("word", F.col("form").alias("root")), most)
    return (grouped.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
