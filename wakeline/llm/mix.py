"""Mixing sources to target weights.

Each source has a size (its words) and a target.  The sources share
``SHARE`` times all words by weight; a source stops at ``MOST`` times its own
size and what it leaves is shared again by weight until none is above.  Inside
a source the documents are put into a random order (an MD5 of the id), sums of
the words before each document are taken, and the source is cut where its
budget, the whole words of the target, ends: whole epochs first, then the
documents of one more epoch up to the budget.  The document on the cut gives
the words that are missing, so a source's taken words equal its budget.

Only DataFrame functions are used.  The order and the sums are distributed
(``range_sorted``, ``prefix_sum``), so a source may hold any share of the rows.
The targets come from two totals per round over the table of sources.

Cases: a null text has size 0; documents without words take 0.  A null source
is a source of its own, the last one.  Rows with the same id, null or not, are
rows of their own; the order among equal rows cannot be told from the result.
An empty table gives an empty result.  Other columns do not matter: ``mix``
returns those asked for, or all, packed in one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, field, materialize, packed, prefix_sum, range_sorted, words

#: Weights by position among the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix as a multiple of all words, and the most that a source or document gives as a multiple of its own.
SHARE = 1.5
MOST = 2


def _order(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size -> source, source_size, target."""
    keyed = sizes.withColumn("_last", F.col("source").isNull())
    ranged = range_sorted(keyed.withColumn("_one", F.lit("")), ["_one"], ["_last", "source"], "sources")
    placed = prefix_sum(ranged, ["_one"], ["_last", "source"], F.lit(1), "_place")
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod("_place", F.lit(len(WEIGHTS))).cast("int"))
    weighed = materialize(placed.select("source", "source_size", weight.alias("_weight"),
                                        (MOST * F.col("source_size")).alias("_most")), "weighed")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # a source that is full at one level stays full at the next, so the level only rises
        full = F.col("_most") <= F.lit(level) * F.col("_weight")
        taken, open_weight = weighed.agg(F.coalesce(F.sum(F.when(full, F.col("_most"))), F.lit(0)),
                                         F.sum(F.when(~full, F.col("_weight")))).first()
        higher = (SHARE * total - taken) / open_weight if open_weight else level
        if higher <= level:
            break
        level = higher
    target = F.least(F.col("_most").cast("double"), F.lit(level) * F.col("_weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (its ``columns``, packed in ``_row``) with size,
    source_size, target and taken."""
    rows = packed(docs).withColumns({"_n": F.monotonically_increasing_id(), "_source": field("source"), "_key": _order(field("doc_id")),
                                     "_id": field("doc_id"), "size": F.size(words(field("text"))).cast("long")})
    order = ["_key", "_id", "size"]
    if columns:
        rows = rows.withColumn(ROW, F.struct(*[field(c).alias(c) for c in columns]))
    rows = materialize(rows, "mix_rows")       # words are cut once, and the texts stay out of the ordering
    ranged = range_sorted(rows.drop(ROW), ["_source"], order, "mix")
    sizes = ranged.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes).select(F.col("source").alias("_target_of"), "source_size", "target")
    summed = prefix_sum(ranged, ["_source"], order, F.col("size"), "_before")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    extra = F.greatest(F.lit(0), F.least(rest - F.col("_before"), F.col("size")))
    taken = (summed.join(targets, F.col("_source").eqNullSafe(F.col("_target_of")))
             .select("_n", "source_size", "target", (epochs * F.col("size") + extra).cast("long").alias("taken")))
    return rows.select("_n", ROW, "size").join(taken, "_n").drop("_n").select(ROW, "size", "source_size", "target", "taken")


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
sized AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT source, source_size, 2 * source_size AS most,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized),
-- sources fill up in the order of most / weight: the level if exactly those before one are full
levels AS (
  SELECT most, weight,
         (1.5 * (SELECT sum(source_size) FROM weighed)
          - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
reached AS (SELECT max(CAST(level AS DOUBLE)) AS level FROM levels WHERE level * weight <= most),
targets AS (
  SELECT source, source_size, least(CAST(most AS DOUBLE), level * weight) AS target FROM weighed, reached),
summed AS (
  SELECT doc_id, size, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CAST(floor(t.target) AS BIGINT) AS budget
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
            + greatest(0, least(budget - CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * source_size - before, size))
            AS BIGINT) AS taken
FROM summed
"""
