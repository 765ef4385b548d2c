"""Quality rules: counts over words and lines, and a hashed n-gram likelihood ratio.

Every word and every pair of neighbouring words is hashed into one of
``BUCKETS`` features.  Two multinomials over the features are counted: one on
all documents, one on all trusted ones, which are labelled ``quality`` 1 and
``toxic`` 0.  The score of a document is the mean, over its n-grams, of

    log((trusted + 1) / (all trusted + B)) - log((raw + 1) / (all raw + B))

and a document passes when its score is at least a threshold taken from the
trusted documents' own scores (counted in steps of ``STEP``): the value that
all but ``LOSS`` of them reach, less ``MARGIN`` times its distance from their
median.  No random draw is involved.

The trusted documents are found by a sort-merge join by id, which can spill and
is the same at any size (no number of labels is broadcast), and stored once for
the counts and the threshold.

Only DataFrame functions are used.  Applying the rules is one pass over the
rows without a shuffle: the log ratios are ``BUCKETS`` numbers, a fixed count.

Cases: a null text has no words and fails (n_words < 50).  Repeated rows are
judged alike.  Without trusted documents (labels empty, or none match) the
base rules alone decide.  Further input columns, whatever their names, pass
through ``keep_good`` unchanged.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, field, materialize, packed, unpacked, words

BUCKETS = 10_000
LOSS = 0.001
STEP = 0.001
MARGIN = 0.5
MIN_WORDS = 50


class QualityModel(NamedTuple):
    ratios: list[float] | None
    threshold: float


def _feature(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def _feature_rows(texts: DataFrame) -> DataFrame:
    """A row for the feature of each word and of each pair of neighbours.  Words become
    rows before they are hashed: this runs as generated code, a lambda over the array would not."""
    word, at = F.col("_x"), F.col("_i")
    pair = F.when(at > 0, _feature(F.get(F.col("_w"), at - 1), word))
    # the words in a step of their own: written into the features, they would be cut anew for each
    return (texts.select(words(F.col("text")).alias("_w")).select("_w", F.posexplode("_w").alias("_i", "_x"))
            .select(F.explode(F.array(_feature(word), pair)).alias("feature")).where("feature is not null"))


def _score(w: Column, ratios: list[float]) -> Column:
    """Mean log ratio over words and pairs; null without words."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")

    def add(total: Column, i: Column) -> Column:
        one = F.get(table, _feature(F.get(w, i)))
        two = F.when(i > 0, F.get(table, _feature(F.get(w, i - 1), F.get(w, i)))).otherwise(0.0)
        return total + one + two

    n = F.size(w)
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), add) / (2 * n - 1))


def _quantile(steps: list[tuple[int, int]], part: float) -> float:
    """The first of the counted values that more than ``part`` of all reach down to."""
    allowed, seen = part * sum(n for _, n in steps), 0
    for step, n in steps:
        seen += n
        if seen > allowed:
            return step
    return -math.inf


def _counts(texts: DataFrame) -> list[int]:
    out = [0] * BUCKETS
    rows = _feature_rows(texts).groupBy("feature").agg(F.count("*").alias("n"))
    for x in rows.collect():  # one row per feature, BUCKETS at most
        out[x["feature"]] = x["n"]
    return out


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Count both multinomials over all documents and set the threshold."""
    labelled = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id")
    texts = docs.select("doc_id", "text")
    good = materialize(texts.join(labelled.hint("merge"), "doc_id", "left_semi").select("text"), "trusted")
    raw, trusted = _counts(texts), _counts(good)
    t, r = sum(trusted), sum(raw)
    if not t:
        return QualityModel(None, 0.0)
    ratios = [round(math.log((a + 1) / (t + BUCKETS)) - math.log((b + 1) / (r + BUCKETS)), 5) for a, b in zip(trusted, raw)]
    scored = (good.select(words(F.col("text")).alias("_w")).where(F.size("_w") >= MIN_WORDS)
              .select(F.floor(_score(F.col("_w"), ratios) / STEP).alias("step")))
    # scores lie between the least and the largest ratio: the steps in between are few, whatever the number of texts
    steps = sorted((x["step"], x["n"]) for x in scored.groupBy("step").agg(F.count("*").alias("n")).collect())
    low, middle = _quantile(steps, LOSS), _quantile(steps, 0.5)
    return QualityModel(ratios, (low - MARGIN * (middle - low)) * STEP)


def quality_columns(rows: DataFrame, text: Column, model: QualityModel) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score and kept to ``rows`` (whose columns must differ)."""
    before = rows.columns
    text = F.coalesce(text, F.lit(""))
    symbols = F.regexp_replace(text, "[^#*$%&|<>]+", "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w, g, s = F.col("_w"), F.col("_grams"), F.col("_sorted")
    grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    # windows found twice stand side by side once sorted; only texts that have some are sorted
    ordered = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.filter(F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda k: F.when(
        (F.get(s, k)["h"] == F.get(s, k - 1)["h"]) | (F.get(s, k)["h"] == F.get(s, k + 1)["h"]), F.get(s, k)["i"])),
        F.isnotnull)
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2))))
    found = (rows.select(*before, words(text).alias("_w"), F.length(symbols).cast("long").alias("n_symbols"), lines.alias("_lines"))
             .select(*before, "_w", F.size(w).cast("long").alias("n_words"),
                     F.length(F.array_join(w, "")).cast("long").alias("word_chars"), "n_symbols",
                     (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                     F.when(F.size(w) >= 4, grams).alias("_grams")))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    found = (found.select(*before, "_w", *counts,
                          F.when(F.size(F.array_distinct(g)) < F.size(g), ordered).alias("_sorted"))
             .select(*before, "_w", *counts,
                     F.when(s.isNotNull(), F.size(covered)).otherwise(0).cast("long").alias("n_repeat_words")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    score = F.lit(None).cast("double") if model.ratios is None else _score(w, model.ratios)
    passes = F.lit(True) if model.ratios is None else F.coalesce(F.col("score") >= model.threshold, F.lit(False))
    return (found.select(*before, *counts, "n_repeat_words", failed.alias("base_failed"), score.alias("score"))
            .withColumn("kept", ~F.col("base_failed") & passes))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id with the counts, base_failed, kept and score of every document."""
    rows = docs.select(F.col("doc_id"), F.col("text").alias("_text"))
    judged = quality_columns(rows, F.col("_text"), fit_quality(docs, labels))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "score")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their columns."""
    judged = quality_columns(packed(docs), field("text"), fit_quality(docs, labels))
    # a row number keeps the optimizer from writing the filter out in terms of the text,
    # where each count would be repeated in every count that builds on it
    numbered = judged.withColumn("_number", F.monotonically_increasing_id())
    return unpacked(numbered.where("kept and _number >= 0").select(ROW))
