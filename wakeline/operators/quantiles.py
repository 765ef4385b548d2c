"""Exact grouped quantiles without collecting a group into one buffer.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, and ``array_agg`` + sort keeps every row.  Both break when a
single group (one class, one feature) holds a large share of the data.  Two
strategies are offered here:

``by_counts``
    Pre-aggregate ``(group, value) -> count`` (partial aggregation, so duplicates
    collapse map-side), then a running count per group picks the value at the
    wanted rank.  Work per group is bounded by its *distinct* values.  Used when
    a group has a physical bound, e.g. one vessel-week of speed readings.

``exact_quantiles``
    For unbounded groups.  Ranges of values are narrowed level by level: each
    level builds an equal-width histogram per open range (a small table), a
    running sum over the histogram finds the bucket holding each wanted rank,
    and only that bucket's values go to the next level.  When a range is down to
    ``exact_limit`` rows (or a single value) the counts method finishes it.  Every
    level is one scan plus a small aggregation; the control tables hold one row
    per (group, wanted rank) and are broadcast only under a checked row count.

Interpolation rules: ``linear`` (numpy / DuckDB ``quantile_cont``) and
``nearest`` (rank round((n-1)q), half up).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

EXACT_LIMIT = 2_000_000      # rows a range may hold before it is finished exactly
N_BUCKETS = 4096             # histogram width per refinement level
MAX_LEVELS = 8
BROADCAST_ROWS = 200_000     # control-table rows below which it is broadcast


def _rank_targets(n: F.Column, q: float, method: str) -> list[tuple[str, F.Column]]:
    """0-based ranks needed for quantile q of n values."""
    if method == "nearest":
        return [("r", F.floor((n - 1) * F.lit(q) + F.lit(0.5)).cast("long"))]
    pos = (n - 1) * F.lit(q)
    lo = F.floor(pos).cast("long")
    return [("lo", lo), ("hi", F.least(lo + 1, n - 1))]


def _assemble(picked: DataFrame, keys: Sequence[str], probs: Mapping[str, float],
              method: str, value_col: str = "_qv") -> DataFrame:
    """picked: (keys, _qname, _which, _qv) plus _n → one row per group."""
    aggs = [F.max("_n").alias("_n")]
    for name in probs:
        for which in (["r"] if method == "nearest" else ["lo", "hi"]):
            aggs.append(F.max(F.when((F.col("_qname") == name) & (F.col("_which") == which),
                                     F.col(value_col))).alias(f"{name}__{which}"))
    wide = picked.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col("_n").alias("n")]
    for name, q in probs.items():
        if method == "nearest":
            cols.append(F.col(f"{name}__r").alias(name))
        else:
            a, b = F.col(f"{name}__lo"), F.col(f"{name}__hi")
            pos = (F.col("_n") - 1) * F.lit(q)
            frac = pos - F.floor(pos)
            cols.append((a + (b - a) * frac).alias(name))
    return wide.select(*cols)


def by_counts(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
              method: str = "nearest") -> DataFrame:
    """Exact quantiles when each group's distinct values are bounded.

    Returns one row per group with at least one non-null value:
    ``keys..., n, <prob names>``.
    """
    keys = list(keys)
    counts = (df.select(*keys, F.col(value).alias("_v"))
              .where(F.col("_v").isNotNull())
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(*keys).orderBy("_v")
    run = counts.select(
        *keys, "_v",
        F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_cum"),
        F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"),
    )
    aggs = [F.max("_n").alias("_n")]
    n = F.col("_n")
    for name, q in probs.items():
        for which, r in _rank_targets(n, q, method):
            # the first value whose running count passes rank r
            aggs.append(F.min(F.when(F.col("_cum") > r, F.col("_v"))).alias(f"{name}__{which}"))
    wide = run.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col("_n").alias("n")]
    for name, q in probs.items():
        if method == "nearest":
            cols.append(F.col(f"{name}__r").alias(name))
        else:
            a, b = F.col(f"{name}__lo"), F.col(f"{name}__hi")
            pos = (F.col("_n") - 1) * F.lit(q)
            cols.append((a + (b - a) * (pos - F.floor(pos))).alias(name))
    return wide.select(*cols)


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
                    method: str = "linear", exact_limit: int = EXACT_LIMIT,
                    n_buckets: int = N_BUCKETS, max_levels: int = MAX_LEVELS,
                    info: dict | None = None) -> DataFrame:
    """Exact grouped quantiles for groups of any size (see module docstring).

    Returns ``keys..., n, <prob names>`` for groups with a non-null value.
    ``info``, when given, receives ``groups`` (the number of output rows, known
    from the level-0 control query) and ``largest`` (rows in the biggest group).
    """
    keys = list(keys)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    vals = (df.select(*keys, F.col(value).cast("double").alias("_v"))
            .where(F.col("_v").isNotNull() & ~F.isnan("_v")))

    # level 0: one open range per group; first only its size is needed
    stats = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"),
                                    F.max("_v").alias("_hi"))
    ctl = stats.agg(F.count(F.lit(1)).alias("rows"), F.max("_c").alias("maxc")).first()
    n_ranges, max_c = int(ctl["rows"] or 0), int(ctl["maxc"] or 0)
    if info is not None:
        info.update(groups=n_ranges, largest=max_c)
    if n_ranges == 0:
        return _assemble(spark.createDataFrame([], vals.schema).select(
            *keys, F.lit("").alias("_qname"), F.lit("").alias("_which"),
            F.lit(0.0).alias("_qv"), F.lit(0).cast("long").alias("_n")), keys, probs, method)

    if max_c <= exact_limit:
        # every group is small enough: no join needed, counts method directly
        return by_counts(df.select(*keys, F.col(value).cast("double").alias(value))
                         .where(~F.isnan(value)), keys, value, probs, method)

    ranges = stats.withColumn("_rid", F.lit("r")).transform(materialize)  # range id: a path, unique across levels

    # wanted ranks per group: (keys, _qname, _which, _r relative to range _rid, _n)
    tgt_cols = []
    for name, q in probs.items():
        for which, r in _rank_targets(F.col("_c"), q, method):
            tgt_cols.append(F.struct(F.lit(name).alias("_qname"), F.lit(which).alias("_which"),
                                     r.alias("_r")))
    targets = (ranges.select(*keys, "_rid", F.col("_c").alias("_n"),
                             F.explode(F.array(*tgt_cols)).alias("_t"))
               .select(*keys, "_rid", "_n", "_t._qname", "_t._which", "_t._r")
               .transform(materialize))

    for _ in range(max_levels):
        open_ranges = ranges.where((F.col("_c") > exact_limit) & (F.col("_lo") < F.col("_hi")))
        n_open = open_ranges.count()
        if n_open == 0:
            break
        # ranges in a group are disjoint, so each row lands in at most one range
        rows = vals.join(_maybe_broadcast(open_ranges.select(*keys, "_rid", "_lo", "_hi"), n_open), keys) \
                   .where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        half_span = F.col("_hi") / 2 - F.col("_lo") / 2
        bucket = F.least(F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / half_span * n_buckets),
                         F.lit(n_buckets - 1)).cast("long")
        hist = (rows.groupBy(*keys, "_rid", bucket.alias("_b"))
                .agg(F.count(F.lit(1)).alias("_bc"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi")))
        wb = Window.partitionBy(*keys, "_rid").orderBy("_b")
        hist = hist.withColumn("_before", F.coalesce(
            F.sum("_bc").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        open_t = targets.join(open_ranges.select(*keys, "_rid"), keys + ["_rid"], "left_semi")
        moved = (open_t.join(hist, keys + ["_rid"])
                 .where((F.col("_r") >= F.col("_before")) & (F.col("_r") < F.col("_before") + F.col("_bc")))
                 .select(*keys, F.concat_ws("/", "_rid", F.col("_b").cast("string")).alias("_nrid"), "_n", "_qname",
                         "_which", (F.col("_r") - F.col("_before")).alias("_r"),
                         F.col("_bc").alias("_c"), F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi")))
        kept_t = targets.join(open_ranges.select(*keys, "_rid"), keys + ["_rid"], "left_anti")
        kept_r = ranges.join(open_ranges.select(*keys, "_rid"), keys + ["_rid"], "left_anti")
        targets = kept_t.unionByName(
            moved.select(*keys, F.col("_nrid").alias("_rid"), "_n", "_qname", "_which", "_r")).transform(materialize)
        ranges = kept_r.unionByName(
            moved.select(*keys, "_c", "_lo", "_hi", F.col("_nrid").alias("_rid")).distinct()).transform(materialize)

    # finish: single-valued ranges are answered directly, the rest by counts
    n_ranges = ranges.count()
    point = ranges.where(F.col("_lo") == F.col("_hi"))
    answered = targets.join(point.select(*keys, "_rid", F.col("_lo").alias("_qv")), keys + ["_rid"])
    rest = ranges.where(F.col("_lo") < F.col("_hi")).select(*keys, "_rid", "_lo", "_hi")
    rows = vals.join(_maybe_broadcast(rest, n_ranges), keys) \
               .where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    counts = rows.groupBy(*keys, "_rid", "_v").agg(F.count(F.lit(1)).alias("_vc"))
    w = Window.partitionBy(*keys, "_rid").orderBy("_v")
    counts = counts.withColumn("_cum", F.sum("_vc").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    exact = (targets.join(counts, keys + ["_rid"])
             .where(F.col("_cum") > F.col("_r"))
             .groupBy(*keys, "_rid", "_qname", "_which", "_n").agg(F.min("_v").alias("_qv")))
    picked = answered.select(*keys, "_qname", "_which", "_n", "_qv").unionByName(
        exact.select(*keys, "_qname", "_which", "_n", "_qv"))
    return _assemble(picked, keys, probs, method)
