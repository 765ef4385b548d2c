"""Weekly behaviour roll-up (D0-D41, B6): one feature row per vessel per week.

One ``groupBy(imo, week_start)`` over all vessels replaces a per-vessel loop.

The roll-up goes through partials that can be merged, in two tables:

* numeric partials: counts, extremes and exact power sums (``moments``) per
  group.  Only declarative aggregates, so they run as a code-generated
  ``HashAggregate``;
* value counts: ``(group, column, value) -> n`` for the columns that need a
  value distribution - the modes (ship type, length, width), the distinct
  statuses and the speed quantiles.  Their size is the number of distinct
  values per group, bounded by what one vessel reports in it.

``weekly_features`` makes both per week and reads the features off.  The stored
form (``plans.jobs.update_weeks``) makes them per day and merges the days of a
week; the streaming form keeps them as its state.  Partials of any grouping and
any order of merging give bit-identical features.

Typed-imperative aggregates (``mode``, ``collect_set``, ``percentile``) would
force an ``ObjectHashAggregate`` that falls back to sorting every partition once
a task holds more than a few hundred vessel-weeks.  Both tables are
hash-partitioned on the same keys, so the join adds no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CARGO_RATIOS, MIN_PINGS_PER_WEEK, NAV_STATUS_RATIOS
from ..functions import circular_abs_diff, safe_div, week_start
from .moments import deviation, mean, power_sums

GROUPS = ["identity", "dimensions", "speed", "course", "status", "spatial", "cargo", "temporal"]

SPEED_QUANTILES = {"sog_p10": 0.10, "sog_median": 0.50, "sog_p90": 0.90}


def _count_if(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def partial_columns(groups, ts: str = "ts") -> dict[str, tuple[str, Column]]:
    """Name -> (how partials merge, what a ping adds)."""
    sog, lat, lon = F.col("sog"), F.col("latitude"), F.col("longitude")
    sums, ends = {"n_pings": _count_if(F.col(ts).isNotNull())}, {"ts": F.col(ts)}
    if "dimensions" in groups:
        ends["draught"] = F.col("draught")
    if "speed" in groups:
        ends["sog"] = sog
        sums |= power_sums("moving", F.when(sog > 0.5, sog), squares=False) | power_sums("sog", sog)
        sums |= {"n_slow": _count_if(sog < 1.0), "n_fast": _count_if(sog > 10.0)}
    if "course" in groups:
        sums |= power_sums("cog", F.col("cog")) | power_sums("turn", F.abs("rot"))
        sums |= power_sums("off", circular_abs_diff("heading", "cog"), squares=False)
    if "status" in groups:
        sums |= {f"n_{k}": _count_if(F.col("nav_status") == v) for k, v in NAV_STATUS_RATIOS.items()}
    if "spatial" in groups:
        ends |= {"lat": lat, "lon": lon}
        sums |= power_sums("lat", lat) | power_sums("lon", lon)
    if "cargo" in groups:
        sums |= {f"n_{k}": _count_if(F.col("cargo_type") == v) for k, v in CARGO_RATIOS.items()}
    return ({k: ("sum", c) for k, c in sums.items()} | {f"{k}_min": ("min", c) for k, c in ends.items()}
            | {f"{k}_max": ("max", c) for k, c in ends.items()})


MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def numeric_partials(pings: DataFrame, keys: list[str], groups=GROUPS, ts: str = "ts") -> DataFrame:
    return pings.groupBy(*keys).agg(*[MERGE[how](c).alias(k) for k, (how, c) in partial_columns(groups, ts).items()])


def merge_partials(partials: DataFrame, keys: list[str], groups=GROUPS) -> DataFrame:
    """Partials of finer groups (or several of one group) into one per ``keys``."""
    return partials.groupBy(*keys).agg(*[MERGE[how](k).alias(k) for k, (how, _) in partial_columns(groups).items()])


def numeric_features(partials: DataFrame, keys: list[str], groups=GROUPS) -> DataFrame:
    """The features that come from numeric partials."""
    c, n = F.col, F.col("n_pings")
    out = []
    if "dimensions" in groups:
        out += [c("draught_max").alias("max_draught"), c("draught_min").alias("min_draught"),
                (c("draught_max") - c("draught_min")).alias("draught_variability")]
    if "speed" in groups:
        # denominators count every row, speed NULL included
        out += [mean("moving").alias("mean_moving_speed"), c("sog_max").alias("max_speed"), deviation("sog").alias("std_speed"),
                (c("n_slow") / n).alias("frac_time_slow"), (c("n_fast") / n).alias("frac_time_fast")]
    if "course" in groups:
        out += [deviation("cog").alias("cog_variability"), mean("turn").alias("rot_mean_abs"), deviation("turn").alias("rot_std"),
                mean("off").alias("heading_cog_diff_mean")]
    if "status" in groups:
        out += [(c(f"n_{k}") / n).alias(k) for k in NAV_STATUS_RATIOS]
    if "spatial" in groups:
        out += [deviation("lat").alias("lat_std"), deviation("lon").alias("lon_std"), mean("lat").alias("lat_mean"), mean("lon").alias("lon_mean"),
                ((c("lat_max") - c("lat_min")) * (c("lon_max") - c("lon_min"))).alias("bbox_area")]
    if "cargo" in groups:
        out += [(c(f"n_{k}") / n).alias(k) for k in CARGO_RATIOS]
    return partials.select(*keys, *out, "n_pings", F.timestamp_diff("SECOND", c("ts_min"), c("ts_max")).alias("time_span_seconds"))


ORDER = [
    "ship_type", "length", "width", "max_draught", "min_draught", "draught_variability",
    "mean_moving_speed", "max_speed", "std_speed", "sog_p10", "sog_median", "sog_p90",
    "frac_time_slow", "frac_time_fast", "cog_variability", "rot_mean_abs", "rot_std",
    "heading_cog_diff_mean", "n_nav_statuses", *NAV_STATUS_RATIOS, "lat_std", "lon_std",
    "lat_mean", "lon_mean", "bbox_area", *CARGO_RATIOS, "n_pings", "time_span_seconds",
    "length_beam_ratio", "draught_length_ratio", "sog_bimodality", "mean_ping_interval_seconds",
]


def derived_columns(df: DataFrame, groups) -> DataFrame:
    """Ratios computed after the aggregate."""
    if "speed" in groups:
        df = df.withColumn("sog_bimodality",
                           safe_div(F.col("sog_p90") - F.col("sog_p10"), F.col("std_speed") + 1e-6))
    if "dimensions" in groups:
        df = (df.withColumn("length_beam_ratio", safe_div("length", F.col("width") + 1e-6))
              .withColumn("draught_length_ratio", safe_div("max_draught", F.col("length") + 1e-6)))
    return df.withColumn("mean_ping_interval_seconds",
                         F.col("time_span_seconds") / F.greatest(F.col("n_pings") - 1, F.lit(1)))


#: The columns that ``value_items`` of all groups come from.
VALUE_COLUMNS = ("ship_type", "length", "width", "nav_status", "sog")


def value_items(groups) -> list[Column]:
    """The (column, text, number) of a ping whose distributions are needed."""
    def item(name, s=None, d=None):
        return F.struct(F.lit(name).alias("_col"),
                        (F.col(s).cast("string") if s else F.lit(None).cast("string")).alias("_s"),
                        (F.col(d).cast("double") if d else F.lit(None).cast("double")).alias("_d"))
    items = []
    if "identity" in groups:
        items.append(item("ship_type", s="ship_type"))
    if "dimensions" in groups:
        items += [item("length", d="length"), item("width", d="width")]
    if "status" in groups:
        items.append(item("nav_status", s="nav_status"))
    if "speed" in groups:
        items.append(item("sog", d="sog"))
    return items


def value_counts(pings: DataFrame, keys: list[str], groups=GROUPS, n: Column | None = None) -> DataFrame | None:
    """How often each value occurs; ``n``: how many pings a row stands for, one if not given."""
    items = value_items(groups)
    if not items:
        return None
    counted = F.count(F.lit(1)) if n is None else F.sum("_n")
    return (pings.select(*keys, *([] if n is None else [n.alias("_n")]), F.explode(F.array(*items)).alias("_i")).select("*", "_i.*")
            .groupBy(*keys, "_col", "_s", "_d").agg(counted.alias("_n")))


def merge_value_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.groupBy(*keys, "_col", "_s", "_d").agg(F.sum("_n").alias("_n"))


def value_features(vc: DataFrame, keys: list[str], groups=GROUPS) -> DataFrame:
    """Modes, distinct statuses and nearest speed quantiles from value counts."""
    is_null = F.col("_s").isNull() & F.col("_d").isNull()
    # speed: running count of non-null readings in value order (the sog block is
    # contiguous when ordered by column name first)
    sog_n = F.when((F.col("_col") == "sog") & F.col("_d").isNotNull(), F.col("_n"))
    w_run = Window.partitionBy(*keys).orderBy("_col", "_d")
    # modes: the first row of each column block when ordered by count desc, value asc
    w_mode = Window.partitionBy(*keys).orderBy("_col", is_null, F.desc("_n"), "_s", "_d")
    vc = (vc.withColumn("_cum", F.sum(sog_n).over(w_run.rowsBetween(Window.unboundedPreceding,
                                                                    Window.currentRow)))
            .withColumn("_tot", F.sum(sog_n).over(Window.partitionBy(*keys)))
            .withColumn("_first", F.coalesce(F.lag("_col").over(w_mode) != F.col("_col"), F.lit(True))))
    first_non_null = F.col("_first") & ~is_null
    aggs = []
    if "identity" in groups:
        aggs.append(F.max(F.when((F.col("_col") == "ship_type") & first_non_null, F.col("_s")))
                    .alias("ship_type"))
    if "dimensions" in groups:
        aggs += [F.max(F.when((F.col("_col") == c) & first_non_null, F.col("_d"))).alias(c)
                 for c in ("length", "width")]
    if "status" in groups:
        # distinct statuses, NULL counting as one value
        aggs.append(F.count(F.when(F.col("_col") == "nav_status", 1)).alias("n_nav_statuses"))
    if "speed" in groups:
        for name, q in SPEED_QUANTILES.items():
            r = F.floor((F.col("_tot") - 1) * F.lit(q) + F.lit(0.5))
            aggs.append(F.min(F.when((F.col("_col") == "sog") & F.col("_d").isNotNull() & (F.col("_cum") > r),
                                     F.col("_d"))).alias(name))
    return vc.groupBy(*keys).agg(*aggs)


def weekly_features(pings: DataFrame, *, min_pings: int = MIN_PINGS_PER_WEEK, groups=None,
                    key: str = "imo", ts: str = "ts") -> DataFrame:
    """Roll pings up into ``(imo, week_start)`` feature rows.

    ``groups`` picks column groups (default all); ``n_pings`` and
    ``time_span_seconds`` are always present.  Rows under ``min_pings`` pings
    are dropped (HAVING) before the value pass is joined.
    """
    groups = set(groups or GROUPS)
    base = pings.where(F.col(ts).isNotNull()).withColumn("week_start", week_start(ts))
    keys = [key, "week_start"]
    return features_of(numeric_partials(base, keys, groups, ts), value_counts(base, keys, groups), keys, groups, min_pings)


def features_of(partials: DataFrame, counts: DataFrame | None, keys: list[str], groups=GROUPS,
                min_pings: int = MIN_PINGS_PER_WEEK) -> DataFrame:
    """Feature rows from the partials and value counts of ``keys``."""
    main = numeric_features(partials.where(F.col("n_pings") >= min_pings), keys, groups)
    if counts is not None:
        main = main.join(value_features(counts, keys, groups), keys, "left")
    main = derived_columns(main, groups)
    return main.select(*keys, *[c for c in ORDER if c in main.columns])
