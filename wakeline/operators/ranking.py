"""Exact per-group "first k rows in hash order" without a per-group window.

``row_number() OVER (PARTITION BY class ORDER BY h)`` sends a whole class to one
task; a class can hold a third of all rows.  Here the order key is a hex md5
string, so its prefixes are natural, order-preserving buckets:

1. count rows per (group, 3-hex-digit prefix of h) - a table of at most 4096
   rows per group - and find, by a running sum over that small table, the
   boundary bucket that holds the k-th row;
2. while the boundary bucket is still larger than ``window_limit`` rows,
   repeat one level deeper (3 more hex digits) inside it;
3. rows whose prefix sorts before the deepest boundary are in, rows after it
   are out, and only the rows inside the boundary bucket (bounded) get an exact
   ``row_number``.

Every level is one scan plus a small aggregation; the per-group decision table
is joined back (broadcast only under a checked row count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

DIGITS_PER_LEVEL = 3
WINDOW_LIMIT = 2_000_000
BROADCAST_ROWS = 200_000
MAX_LEVELS = 10  # 30 of 32 hex digits


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def rank_below(df: DataFrame, groups: Sequence[str], hash_col: str, tiebreak: Sequence[str],
               cutoffs: DataFrame, window_limit: int = WINDOW_LIMIT) -> DataFrame:
    """Flag rows whose 0-based rank inside their group is below each cutoff.

    ``cutoffs``: ``(groups..., name, k)``, one row per group and cutoff name.
    Rank order is ``hash_col`` (hex string) then ``tiebreak`` columns.
    Returns ``df`` plus one boolean column ``below_<name>`` per cutoff name.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # one key that is never null, so that a null group is a group in joins and windows alike
    columns, key = df.columns, F.to_json(F.struct(*groups))
    df, cutoffs, groups = df.withColumn("__g", key), cutoffs.withColumn("__g", key), ["__g"]
    names = [r["name"] for r in cutoffs.select("name").distinct().collect()]  # a few literal names
    cut = cutoffs.where(F.col("k") > 0).select(*groups, F.col("name").alias("__name"),
                                                F.col("k").cast("long").alias("__k"))
    # decision state per (group, name): boundary prefix b (length L) and rank r left inside it
    state = cut.select(*groups, "__name", F.lit("").alias("__b"), F.col("__k").alias("__r")).transform(materialize)
    counts_at = df.select(*groups, F.col(hash_col).alias("_h"))
    depth, done = 0, []
    for level in range(1, MAX_LEVELS + 1):
        depth = level * DIGITS_PER_LEVEL
        n_state = state.count()
        if n_state == 0:
            break
        prev = (level - 1) * DIGITS_PER_LEVEL
        rows = counts_at.join(_maybe_broadcast(state.select(*groups, "__b").distinct(), n_state), groups) \
                        .where(F.substring("_h", 1, prev) == F.col("__b"))
        hist = rows.groupBy(*groups, "__b", F.substring("_h", 1, depth).alias("__p")) \
                   .agg(F.count(F.lit(1)).alias("__c"))
        w = Window.partitionBy(*groups, "__b").orderBy("__p")
        hist = hist.withColumn("__before", F.coalesce(
            F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        nxt = (state.join(hist, groups + ["__b"])
               .where((F.col("__r") > F.col("__before")) & (F.col("__r") <= F.col("__before") + F.col("__c")))
               .select(*groups, "__name", F.col("__p").alias("__b"), (F.col("__r") - F.col("__before")).alias("__r"),
                       F.col("__c").alias("__bc")))
        # a cutoff past the group's size keeps the whole group: boundary above every prefix
        over = (state.join(hist.groupBy(*groups, "__b").agg(F.sum("__c").alias("__tot")), groups + ["__b"])
                .where(F.col("__r") > F.col("__tot"))
                .select(*groups, "__name", F.concat("__b", F.lit("~")).alias("__b"), F.lit(0).cast("long").alias("__r"),
                        F.lit(0).cast("long").alias("__bc")))
        nxt = nxt.unionByName(over).transform(materialize)
        # a settled cutoff (small bucket, or past the group's end) leaves; only open ones are refined
        done.append(nxt.where(F.col("__bc") <= window_limit).select(*groups, "__name", "__b", "__r"))
        state = nxt.where(F.col("__bc") > window_limit).select(*groups, "__name", "__b", "__r")

    # final decision: compare the row's prefix with the boundary; rank inside it
    final = state
    for settled in done:
        final = final.unionByName(settled)
    final = final.transform(materialize)
    n_final = final.count()
    out = df.withColumn("_h", F.col(hash_col))
    for name in names:
        st = final.where(F.col("__name") == name).select(*groups, F.col("__b").alias(f"_b_{name}"),
                                                        F.col("__r").alias(f"_r_{name}"))
        out = out.join(_maybe_broadcast(st, n_final), groups, "left")
    in_bucket = [F.coalesce(F.substring("_h", 1, F.length(F.col(f"_b_{n}"))) == F.col(f"_b_{n}"),
                            F.lit(False)) for n in names]
    any_bucket = in_bucket[0]
    for c in in_bucket[1:]:
        any_bucket = any_bucket | c
    # exact ranks only for rows inside a boundary bucket (bounded by window_limit
    # per group and cutoff); rows elsewhere are decided by the prefix comparison
    small = out.where(any_bucket)
    for c, name in zip(in_bucket, names):
        w = Window.partitionBy(*groups, F.when(c, F.lit("")).otherwise(F.col("_h"))).orderBy("_h", *tiebreak)
        small = small.withColumn(f"_rk_{name}", F.when(c, F.row_number().over(w)))
    rest = out.where(~any_bucket)
    for name in names:
        rest = rest.withColumn(f"_rk_{name}", F.lit(None).cast("int"))
    out = small.unionByName(rest)
    for c, name in zip(in_bucket, names):
        b = F.col(f"_b_{name}")
        pref = F.substring("_h", 1, F.length(b))
        flag = (F.when(b.isNull(), F.lit(False))
                .when(pref < b, F.lit(True))
                .when(c, F.col(f"_rk_{name}") <= F.col(f"_r_{name}"))
                .otherwise(F.lit(False)))
        out = out.withColumn(f"below_{name}", flag)
    return out.select(*columns, *[f"below_{n}" for n in names])  # input order kept
