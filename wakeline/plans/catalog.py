"""Registered queries: name -> (spark callable, oracle SQL or None).

Every query reads the driver tables under ``sf_dir`` (or what Spark derives
from them) over the whole tables.  Output DOUBLE columns are rounded to 6
places so two engines can be compared value by value; the library operators
themselves return full precision.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ANALYSIS_FEATURES, MODEL_FEATURES, PSI_MODERATE
from ..functions import month_start, round_doubles, week_start
from ..operators import drift as D
from ..operators import evaluation as EV
from ..operators import model as M
from ..operators import splits as S
from ..operators import stats as ST
from ..operators.pings import between_dates, keep_ship_types
from ..operators.weekly import weekly_features
from ..session import materialize, scratch_path
from ..sources import logs as L
from ..sources import raw as R
from ..sources import sinks as K
from ..sources.adapters import pings, pings_from_events
from ..sources.tables import table
from ..streaming.jobs import read_weeks, run_weekly_stream
from . import jobs as J
from . import oracle_drift as OD
from . import oracle_weekly as OW
from .oracle_drift import long_sql
from .sqltext import PINGS_CTE, VESSEL_PINGS_CTE, rounded, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Weekly groups in the events-derived pings have a median of ~14 rows, so the
# activity threshold used on the driver tables is 10 (100 would keep nothing).
ADAPTER_MIN_PINGS = 10


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: round_doubles(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def vessel_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_ship_types(pings(spark, sf_dir))


def weekly(spark: SparkSession, sf_dir: str, groups=None, min_pings: int = ADAPTER_MIN_PINGS,
           stored: bool = False) -> DataFrame:
    """The weekly feature table from the driver's events.  ``stored=True`` writes
    it once (``materialize``) for queries that read it in several passes, as a
    production job reads the stored feature table."""
    w = weekly_features(vessel_pings(spark, sf_dir), min_pings=min_pings, groups=groups)
    return w.transform(materialize) if stored else w


# ---------------------------------------------------------------- weekly roll-up
_W = OW.weekly_ctes(ADAPTER_MIN_PINGS)
_TAIL = ["n_pings", "time_span_seconds", "mean_ping_interval_seconds"]
_WEEKLY_SUBSETS = {
    "weekly_speed_profile": (["speed"], ["mean_moving_speed", "max_speed", "std_speed", "sog_p10",
                                         "sog_median", "sog_p90", "frac_time_slow", "frac_time_fast"]
                             + _TAIL + ["sog_bimodality"]),
    "weekly_course": (["course"], ["cog_variability", "rot_mean_abs", "rot_std",
                                   "heading_cog_diff_mean"] + _TAIL),
    "weekly_status_ratios": (["status"], ["n_nav_statuses", "fishing_ratio", "anchor_ratio",
                                          "underway_engine_ratio", "moored_ratio"] + _TAIL),
    "weekly_spatial": (["spatial"], ["lat_std", "lon_std", "lat_mean", "lon_mean", "bbox_area"] + _TAIL),
    "weekly_cargo_ratios": (["cargo"], ["CargoX_ratio", "CargoY_ratio", "CargoZ_ratio",
                                        "CargoOS_ratio", "CargoReserved_ratio"] + _TAIL),
    "weekly_dimensions": (["identity", "dimensions"], ["ship_type", "length", "width", "max_draught",
                                                      "min_draught", "draught_variability"] + _TAIL
                          + ["length_beam_ratio", "draught_length_ratio"]),
}


def _weekly_sql(cols: list[str] | None) -> str:
    sel = "*" if cols is None else ", ".join(["imo", "week_start"] + cols)
    dbl = [c for c in OW.WEEKLY_DOUBLES if cols is None or c in cols]
    return rounded(with_ctes(_W, f"SELECT {sel} FROM weekly"), dbl)


@register("weekly_features", _weekly_sql(None))
def q_weekly_features(spark, sf_dir):
    return weekly(spark, sf_dir)


def _subset(groups, cols):
    def fn(spark, sf_dir):
        return weekly(spark, sf_dir, groups=groups).select("imo", "week_start", *cols)
    return fn


for _name, (_groups, _cols) in _WEEKLY_SUBSETS.items():
    register(_name, _weekly_sql(_cols))(_subset(_groups, _cols))


@register("active_vessel_weeks", rounded(with_ctes(_W, """SELECT imo, count(*) AS n_weeks,
  CAST(sum(n_pings) AS BIGINT) AS n_pings, min(week_start) AS first_week, max(week_start) AS last_week
FROM weekly GROUP BY imo"""), []))
def q_active_vessel_weeks(spark, sf_dir):
    w = weekly(spark, sf_dir, groups=["temporal"])
    return w.groupBy("imo").agg(F.count(F.lit(1)).alias("n_weeks"), F.sum("n_pings").alias("n_pings"),
                                F.min("week_start").alias("first_week"),
                                F.max("week_start").alias("last_week"))


# ---------------------------------------------------------------- drift

WEEKLY_BASELINE_DAYS = 14  # the first two weeks of the weekly table are the baseline
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DOMAIN = ["Cargo", "Tanker", "Fishing", "Passenger", "Sailing"]  # one absent class, one unlisted
TS_FEATURE = "sog_median"


def weekly_with_baseline(spark, sf_dir):
    """Weekly table and its baseline slice (first weeks, found by a scalar subquery)."""
    w = weekly(spark, sf_dir, stored=True)  # reused by the baseline and every period: cut lineage once
    first = w.select(F.min("week_start")).scalar()
    base = w.where(F.col("week_start") < F.date_add(first, WEEKLY_BASELINE_DAYS))
    return w, base


def lineitem_monthly(spark, sf_dir):
    """lineitem by ship month; the baseline is the first calendar year, written as
    a literal date range so it prunes row groups at the scan."""
    li = table(spark, sf_dir, "lineitem")
    first = li.agg(F.min("l_shipdate")).first()[0]  # one scalar
    y0 = F.lit(f"{first.year}-01-01 00:00:00").cast("timestamp_ntz")   # zone-free literals
    y1 = F.lit(f"{first.year + 1}-01-01 00:00:00").cast("timestamp_ntz")
    li = li.select(*LI_FEATURES, "l_returnflag", "l_linestatus", "l_shipdate",
                   month_start("l_shipdate").alias("period"))
    base = li.where((F.col("l_shipdate") >= y0) & (F.col("l_shipdate") < y1))
    return li, base


def drifted_events(spark, sf_dir):
    """events.value scaled by (1 + 0.3 * weeks since the first week): known drift."""
    ev = table(spark, sf_dir, "events")
    first_ts = ev.agg(F.min("ts")).first()[0]  # one scalar
    first = (first_ts - dt.timedelta(days=first_ts.weekday())).date()  # Monday of the first week
    ev = ev.select("event_type", "value", week_start("ts").alias("period"))
    idx = F.floor(F.datediff("period", F.lit(first)) / 7)
    ev = ev.withColumn("value", F.col("value") * (1 + 0.3 * idx))
    return ev, ev.where(F.col("period") == F.lit(first))


def psi_by_class_df(spark, sf_dir, measure="psi", features=MODEL_FEATURES):
    return psi_of_weekly(*weekly_with_baseline(spark, sf_dir), measure=measure, features=features)


def psi_of_weekly(w, base, measure="psi", features=MODEL_FEATURES):
    bins, _ = D.build_baselines(base, features, class_col="ship_type")
    return D.monitor_numeric(w, bins, features, "week_start", class_col="ship_type", measure=measure)


# oracle building blocks
_WSRC = ("wsrc", "SELECT ship_type AS class, week_start AS period, * FROM weekly")
_WBASE = ("wbase", f"SELECT * FROM wsrc WHERE period < (SELECT min(period) FROM wsrc) + {WEEKLY_BASELINE_DAYS}")
_WSRC_P = ("wsrc", "SELECT '__all__' AS class, week_start AS period, * FROM weekly")
_LI = ("lsrc", "SELECT l_returnflag AS class, l_linestatus AS pred, "
               "CAST(date_trunc('month', l_shipdate) AS DATE) AS period, year(l_shipdate) AS _y, "
               + ", ".join(LI_FEATURES) + " FROM lineitem")
_LIBASE = ("lbase", "SELECT * FROM lsrc WHERE _y = (SELECT min(_y) FROM lsrc)")
_EV = ("esrc", """SELECT event_type AS class, period,
  value * (1 + 3e-1 * floor(date_diff('day', (SELECT min(CAST(date_trunc('week', ts) AS DATE)) FROM events), period) / 7))
    AS value
FROM (SELECT *, CAST(date_trunc('week', ts) AS DATE) AS period FROM events) t""")
_EVBASE = ("ebase", "SELECT * FROM esrc WHERE period = (SELECT min(period) FROM esrc)")


def _pooled_ctes():
    return _W + [_WSRC_P, _WBASE] + OD.baseline_ctes("wbase", MODEL_FEATURES)


def _by_class_ctes(kind="psi"):
    return (_W + [_WSRC, _WBASE] + OD.baseline_ctes("wbase", MODEL_FEATURES)
            + OD.monitor_ctes("wsrc", MODEL_FEATURES, kind))


@register("reference_bins", rounded(with_ctes(_pooled_ctes(), "SELECT * FROM bins"),
                                    ["lo", "hi", "ref_prop"]))
def q_reference_bins(spark, sf_dir):
    _, base = weekly_with_baseline(spark, sf_dir)
    bins, _ = D.build_baselines(base, MODEL_FEATURES)
    return bins


@register("bin_proportions", rounded(with_ctes(
    _pooled_ctes() + OD.monitor_ctes("wsrc", MODEL_FEATURES),
    "SELECT period, feature, bin, n, CASE WHEN total > 0 THEN n / total END AS proportion FROM dense"),
    ["proportion"]))
def q_bin_proportions(spark, sf_dir):
    w, base = weekly_with_baseline(spark, sf_dir)
    bins, _ = D.build_baselines(base, MODEL_FEATURES)
    dense = D.comparison(D.cell_counts(w, bins, MODEL_FEATURES, "week_start"), bins)
    return dense.select("period", "feature", "bin", "n", F.col("comp_prop").alias("proportion"))


@register("class_proportions", rounded(with_ctes(_W, f"""SELECT p.week_start, d.class,
  coalesce(c.n, 0) AS n,
  coalesce(coalesce(c.n, 0) / nullif(sum(coalesce(c.n, 0)) OVER (PARTITION BY p.week_start), 0), 0) AS proportion
FROM (SELECT DISTINCT week_start FROM weekly) p
CROSS JOIN (VALUES {', '.join(f"('{c}')" for c in DOMAIN)}) d(class)
LEFT JOIN (SELECT week_start, ship_type AS class, count(*) AS n FROM weekly GROUP BY ALL) c
  ON c.week_start = p.week_start AND c.class = d.class"""), ["proportion"]))
def q_class_proportions(spark, sf_dir):
    w = weekly(spark, sf_dir)
    return D.class_shares(w, "ship_type", DOMAIN, "week_start").select(
        "week_start", "class", "n", F.col("ref_prop").alias("proportion"))


@register("psi_pooled", rounded(with_ctes(_pooled_ctes() + OD.monitor_ctes("wsrc", MODEL_FEATURES),
                                          "SELECT * FROM scored"), ["psi"]))
def q_psi_pooled(spark, sf_dir):
    w, base = weekly_with_baseline(spark, sf_dir)
    bins, _ = D.build_baselines(base, MODEL_FEATURES)
    return D.monitor_numeric(w, bins, MODEL_FEATURES, "week_start")


@register("psi_by_class", rounded(with_ctes(_by_class_ctes(), "SELECT * FROM scored"), ["psi"]))
def q_psi_by_class(spark, sf_dir):
    return psi_by_class_df(spark, sf_dir)


@register("psi_predicted_class", rounded(with_ctes([_LI, _LIBASE] + OD.predicted_ctes("lbase", "lsrc"),
                                                   "SELECT * FROM pscored JOIN punseen USING (period)"), ["psi", "unseen_share"]))
def q_psi_predicted_class(spark, sf_dir):
    li, base = lineitem_monthly(spark, sf_dir)
    classes = D.class_shares(base.where(F.col("l_linestatus").isNotNull()), "l_linestatus")
    return D.monitor_predicted_class(li, classes, "l_linestatus", "period")


# the first week of the events holds one kind only; later weeks are predicted as kinds that it lacks
_EV_PRED = ("epred", "SELECT event_type AS pred, CAST(date_trunc('week', ts) AS DATE) AS period FROM events")


@register("psi_unseen_class", rounded(with_ctes([_EV_PRED, ("epbase", "SELECT * FROM epred WHERE pred < 'q' AND period = (SELECT min(period) FROM epred)")]
                                                + OD.predicted_ctes("epbase", "epred"), "SELECT * FROM pscored JOIN punseen USING (period)"),
                                      ["psi", "unseen_share"]))
def q_psi_unseen_class(spark, sf_dir):
    """F7 where the baseline lacks some of the classes."""
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("pred"), week_start("ts").alias("period"))
    base = ev.where("pred < 'q'").where(F.col("period") == ev.select(F.min("period")).scalar())
    return D.monitor_predicted_class(ev, D.class_shares(base, "pred"), "pred", "period")


@register("psi_all_features", rounded(with_ctes(
    [_LI, _LIBASE] + OD.baseline_ctes("lbase", LI_FEATURES) + OD.monitor_ctes("lsrc", LI_FEATURES)
    + OD.predicted_ctes("lbase", "lsrc"),
    "SELECT * FROM scored UNION ALL SELECT * FROM pscored"), ["psi"]))
def q_psi_all_features(spark, sf_dir):
    li, base = lineitem_monthly(spark, sf_dir)
    bins, classes = D.build_baselines(base, LI_FEATURES, class_col="l_returnflag",
                                      predicted_class_col="l_linestatus")
    return D.monitor_all_features(li, bins, LI_FEATURES, "period", class_col="l_returnflag",
                                  predicted_class_col="l_linestatus", classes=classes)


@register("class_balance", rounded(with_ctes(_W, """SELECT ship_type, week_start, n,
  CAST(sum(n) OVER (PARTITION BY week_start) AS BIGINT) AS total, n / sum(n) OVER (PARTITION BY week_start) AS proportion
FROM (SELECT ship_type, week_start, count(*) AS n FROM weekly GROUP BY ALL) t"""), ["proportion"]))
def q_class_balance(spark, sf_dir):
    return D.class_balance(weekly(spark, sf_dir), "ship_type", "week_start")


@register("drift_alarms", rounded(with_ctes(
    [_EV, _EVBASE] + OD.baseline_ctes("ebase", ["value"]) + OD.monitor_ctes("esrc", ["value"]),
    """SELECT *, 'feature moved: period ' || CAST(period AS VARCHAR) || ', ' || class || ': ' || feature
  || ', psi ' || printf('%.2f', psi) AS alarm
FROM scored WHERE psi > 25e-2"""), ["psi"]))
def q_drift_alarms(spark, sf_dir):
    ev, base = drifted_events(spark, sf_dir)
    bins, _ = D.build_baselines(base, ["value"], class_col="event_type")
    res = D.monitor_numeric(ev, bins, ["value"], "period", class_col="event_type")
    return D.check_drift(res)


@register("drift_rank", rounded(with_ctes(_by_class_ctes(),
                                          "SELECT feature, class, max(psi) AS max_psi FROM scored GROUP BY ALL"),
                                ["max_psi"]))
def q_drift_rank(spark, sf_dir):
    return D.rank_by_drift(psi_by_class_df(spark, sf_dir))


@register("psi_timeseries", rounded(with_ctes(_by_class_ctes(), f"""SELECT period, class, psi,
  CASE WHEN psi IS NULL THEN NULL WHEN psi < 1e-1 THEN 'stable' WHEN psi < 25e-2 THEN 'moderate'
       ELSE 'significant' END AS band
FROM scored WHERE feature = '{TS_FEATURE}'"""), ["psi"]))
def q_psi_timeseries(spark, sf_dir):
    return D.psi_timeseries(psi_by_class_df(spark, sf_dir, features=[TS_FEATURE]), TS_FEATURE)


@register("kl_by_class", rounded(with_ctes(_by_class_ctes("kl"), "SELECT * FROM scored"), ["kl"]))
def q_kl_by_class(spark, sf_dir):
    return psi_by_class_df(spark, sf_dir, measure="kl")


# ---------------------------------------------------------------- splits and samples

TRAIN_BOX = (55.0, 56.2, 8.0, 13.0)   # lat_min, lat_max, lon_min, lon_max
TEST_BOX = (56.0, 58.0, 8.0, 13.0)    # overlaps the train box in 56.0-56.2
SPLIT_DAYS = 14
LI_TRAIN_MONTHS, LI_TEST_MONTH = [1, 2, 3], 6
SAMPLE_PER_CLASS = 200


def _md5(cols: list[str], seed: int = 42) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"md5(concat_ws('|', {parts}, '{seed}'))"


_WKEY = "imo, week_start, ship_type"


@register("split_random", with_ctes(_W, f"""SELECT {_WKEY},
  CASE WHEN rn <= round_even(n * 2e-1, 0) THEN 'test' ELSE 'train' END AS split
FROM (SELECT {_WKEY}, row_number() OVER (PARTITION BY ship_type ORDER BY {_md5(['imo', 'week_start'])}, imo,
  week_start) AS rn, count(*) OVER (PARTITION BY ship_type) AS n FROM weekly) t"""))
def q_split_random(spark, sf_dir):
    w = weekly(spark, sf_dir, groups=["identity"], stored=True).select("imo", "week_start", "ship_type")
    return S.split_random(w, "ship_type", ["imo", "week_start"])


@register("split_temporal", with_ctes(_W, f"""SELECT {_WKEY},
  CASE WHEN week_start < (SELECT min(week_start) FROM weekly) + {SPLIT_DAYS} THEN 'train' ELSE 'test' END AS split
FROM weekly"""))
def q_split_temporal(spark, sf_dir):
    w = weekly(spark, sf_dir, groups=["identity"]).select("imo", "week_start", "ship_type")
    cutoff = F.date_add(w.select(F.min("week_start")).scalar(), SPLIT_DAYS)
    return S.split_temporal(w, "week_start", cutoff)


def _box(b):
    return (f"lat_mean BETWEEN {b[0]} AND {b[1]} AND lon_mean BETWEEN {b[2]} AND {b[3]}")


@register("split_geographic", with_ctes(_W, f"""SELECT {_WKEY}, 'train' AS split FROM weekly WHERE {_box(TRAIN_BOX)}
UNION ALL SELECT {_WKEY}, 'test' AS split FROM weekly WHERE {_box(TEST_BOX)}"""))
def q_split_geographic(spark, sf_dir):
    w = weekly(spark, sf_dir, groups=["identity", "spatial"])
    return S.split_geographic(w, TRAIN_BOX, TEST_BOX).select("imo", "week_start", "ship_type", "split")


_TYPES_VALUES = ", ".join(f"('{t}')" for t in ["Cargo", "Tanker", "Fishing", "Tug", "Passenger"])


@register("split_compositional", with_ctes(_W + [
    ("tot", "SELECT count(*) AS big_n FROM weekly"),
    ("cnt", f"""SELECT d.c AS ship_type, coalesce(x.n, 0) AS n FROM (VALUES {_TYPES_VALUES}) d(c)
LEFT JOIN (SELECT ship_type, count(*) AS n FROM weekly GROUP BY 1) x ON x.ship_type = d.c"""),
    ("cut", "SELECT ship_type, n, CAST(round_even(n / big_n * floor(big_n * 2e-1), 0) AS BIGINT) AS t FROM cnt, tot"),
    ("mm", "SELECT greatest(min(n - t), 0) AS m FROM cut"),
    ("r", f"""SELECT {_WKEY}, row_number() OVER (PARTITION BY ship_type ORDER BY {_md5(['imo', 'week_start'])},
  imo, week_start) AS rn FROM weekly WHERE ship_type IN (SELECT c FROM (VALUES {_TYPES_VALUES}) d(c))"""),
], """SELECT r.imo, r.week_start, r.ship_type, CASE WHEN rn <= t THEN 'test' ELSE 'train' END AS split
FROM r JOIN cut USING (ship_type), mm WHERE rn <= t + m"""))
def q_split_compositional(spark, sf_dir):
    w = weekly(spark, sf_dir, groups=["identity"], stored=True).select("imo", "week_start", "ship_type")
    return S.split_compositional(w, "ship_type", ["imo", "week_start"])


@register("split_months", f"""SELECT l_orderkey, l_linenumber, l_shipdate,
  CASE WHEN month(l_shipdate) IN ({', '.join(map(str, LI_TRAIN_MONTHS))}) THEN 'train' ELSE 'test' END AS split
FROM lineitem WHERE month(l_shipdate) IN ({', '.join(map(str, LI_TRAIN_MONTHS))}) OR month(l_shipdate) = {LI_TEST_MONTH}""")
def q_split_months(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return S.split_months(li, "l_shipdate", LI_TRAIN_MONTHS, LI_TEST_MONTH)


@register("split_region", with_ctes(_W, f"""SELECT {_WKEY}, region, CASE WHEN region = 'south' THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, CASE WHEN lat_mean >= 56 THEN 'north' ELSE 'south' END AS region FROM weekly) t"""))
def q_split_region(spark, sf_dir):
    w = weekly(spark, sf_dir, groups=["identity", "spatial"])
    w = w.withColumn("region", F.when(F.col("lat_mean") >= 56, "north").otherwise("south"))
    return S.split_region(w, "south", "north").select("imo", "week_start", "ship_type", "region", "split")


@register("sample_stratified", f"""SELECT l_orderkey, l_linenumber, l_returnflag FROM (
  SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_returnflag
    ORDER BY {_md5(['l_orderkey', 'l_linenumber'])}, l_orderkey, l_linenumber) AS rn FROM lineitem) t
WHERE rn <= {SAMPLE_PER_CLASS}""")
def q_sample_stratified(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return S.sample_stratified(li, "l_returnflag", ["l_orderkey", "l_linenumber"], SAMPLE_PER_CLASS)


# ---------------------------------------------------------------- statistics

PROFILE_COLUMNS = ["imo", "ship_type", "nav_status", "cargo_type"]
MISSING_COLUMNS = ["imo", "ts", "ship_type", "length", "width", "draught", "sog", "cog", "rot",
                   "heading", "nav_status", "latitude", "longitude", "cargo_type"]
KDE_FEATURE = "draught_length_ratio"
_VP = [PINGS_CTE, VESSEL_PINGS_CTE]  # the adapter and the ship-type filter
_ALONG = ("along", long_sql("asrc", ANALYSIS_FEATURES, False))
_ASRC = ("asrc", "SELECT ship_type AS class, * FROM weekly")
_ASRC_COMPLETE = ("asrc", "SELECT ship_type AS class, * FROM weekly WHERE "
                  + " AND ".join(f"{c} IS NOT NULL" for c in
                                 ["imo", "week_start", "ship_type"] + [c for c in OW.WEEKLY_DOUBLES]
                                 + ["n_nav_statuses", "n_pings", "time_span_seconds"]))


def complete_weekly(spark, sf_dir):
    """Weekly rows without any NULL (the tests drop incomplete rows first)."""
    return weekly(spark, sf_dir).na.drop().transform(materialize)  # read by several passes


@register("rows_per_entity", with_ctes(_VP, "SELECT imo, count(*) AS row_count FROM vpings GROUP BY imo"))
def q_rows_per_entity(spark, sf_dir):
    return ST.rows_per_entity(vessel_pings(spark, sf_dir), "imo")


@register("value_counts", with_ctes(_VP, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM vpings GROUP BY {c}"
    for c in PROFILE_COLUMNS)))
def q_value_counts(spark, sf_dir):
    return ST.value_counts(vessel_pings(spark, sf_dir), PROFILE_COLUMNS)


@register("activity_profile", rounded(with_ctes(_VP + [
    ("per", "SELECT imo, count(*) AS rc FROM vpings GROUP BY imo")],
    """SELECT CAST(sum(rc) AS BIGINT) AS n_rows, count(*) AS n_entities, max(rc) AS max_rows,
  quantile_cont(rc, 5e-1) AS median_rows, avg(rc) AS mean_rows, CAST(count_if(rc > 1440) AS BIGINT) AS n_busy,
  CAST(count_if(rc < 144) AS BIGINT) AS n_quiet FROM per"""), ["median_rows", "mean_rows"]))
def q_activity_profile(spark, sf_dir):
    return ST.activity_profile(vessel_pings(spark, sf_dir), "imo")


@register("missingness", rounded(with_ctes([PINGS_CTE], "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, count_if({c} IS NULL) / count(*) * 100 AS pct_null,
  count_if(CAST({c} AS VARCHAR) IN ('Unknown', 'Unknown value')) / count(*) * 100 AS pct_unknown,
  count_if(CAST({c} AS VARCHAR) = 'Undefined') / count(*) * 100 AS pct_undefined,
  (count_if({c} IS NULL) + count_if(CAST({c} AS VARCHAR) IN ('Unknown', 'Unknown value'))
   + count_if(CAST({c} AS VARCHAR) = 'Undefined')) / count(*) * 100 AS pct_missing FROM pings"""
    for c in MISSING_COLUMNS)), ["pct_null", "pct_unknown", "pct_undefined", "pct_missing"]))
def q_missingness(spark, sf_dir):
    return ST.missingness(pings(spark, sf_dir), MISSING_COLUMNS)


@register("grouped_describe", rounded(with_ctes(_W + [_ASRC, _ALONG], """SELECT feature, class,
  count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
  quantile_cont(value, 25e-2) AS p25, quantile_cont(value, 5e-1) AS p50, quantile_cont(value, 75e-2) AS p75,
  max(value) AS max FROM along GROUP BY feature, class"""), ["mean", "std", "min", "p25", "p50", "p75", "max"]))
def q_grouped_describe(spark, sf_dir):
    return ST.grouped_describe(weekly(spark, sf_dir, stored=True), ANALYSIS_FEATURES, "ship_type")


@register("histogram", rounded(with_ctes(_VP + [
    ("per", "SELECT imo, count(*) AS rc FROM vpings GROUP BY imo"),
    ("rng", "SELECT CAST(min(rc) AS DOUBLE) AS lo, CAST(max(rc) AS DOUBLE) AS hi FROM per"),
    ("cnt", f"""SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((rc - lo) * {ST.HIST_BINS} / (hi - lo)),
  {ST.HIST_BINS - 1}) END AS BIGINT) AS bin, count(*) AS count FROM per, rng GROUP BY 1""")],
    f"""SELECT g.bin, lo + g.bin * ((hi - lo) / {ST.HIST_BINS}) AS lo,
  lo + (g.bin + 1) * ((hi - lo) / {ST.HIST_BINS}) AS hi, coalesce(c.count, 0) AS count
FROM (SELECT range AS bin FROM range({ST.HIST_BINS})) g CROSS JOIN rng LEFT JOIN cnt c ON c.bin = g.bin"""),
    ["lo", "hi"]))
def q_histogram(spark, sf_dir):
    per = vessel_pings(spark, sf_dir).groupBy("imo").agg(F.count(F.lit(1)).alias("rc"))
    return ST.histogram(per, "rc")


@register("box_summary", rounded(with_ctes(_W + [_ASRC, _ALONG, (
    "qs", """SELECT feature, class, count(*) AS n, quantile_cont(value, 25e-2) AS q1,
  quantile_cont(value, 5e-1) AS median, quantile_cont(value, 75e-2) AS q3 FROM along GROUP BY ALL""")],
    """SELECT q.feature, q.class, q.n, q1, median, q3, q3 - q1 AS iqr,
  min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END) AS whisker_low,
  max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_high
FROM qs q JOIN along a ON a.feature = q.feature AND a.class = q.class GROUP BY ALL"""),
    ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]))
def q_box_summary(spark, sf_dir):
    return ST.box_summary(weekly(spark, sf_dir, stored=True), ANALYSIS_FEATURES, "ship_type")


@register("kde_by_class", rounded(with_ctes(_W + [
    ("kv", f"SELECT ship_type AS class, CAST({KDE_FEATURE} AS DOUBLE) AS v FROM weekly WHERE {KDE_FEATURE} IS NOT NULL"),
    ("st", """SELECT *, lo - 3e0 * h AS g0, (hi - lo + 6e0 * h) / 199 AS step FROM (
  SELECT *, sd * pow(CAST(n AS DOUBLE), -2e-1) AS h FROM (
    SELECT class, count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM kv GROUP BY class) a) b
  WHERE h > 0"""),
    ("pts", """SELECT d.class, d.v, d.c, s.n, s.h, s.g0, s.step, unnest(range(0, 200)) AS i
FROM (SELECT class, v, count(*) AS c FROM kv GROUP BY ALL) d JOIN st s USING (class)""")],
    """SELECT class, CAST(i AS BIGINT) AS i, first(g0 + i * step) AS x,
  sum(c * exp((((g0 + i * step) - v) / h) * -5e-1 * (((g0 + i * step) - v) / h)))
    / (first(n) * first(h) * 2.5066282746310002) AS density
FROM pts GROUP BY class, i"""), ["x", "density"]))
def q_kde_by_class(spark, sf_dir):
    return ST.kde_by_class(weekly(spark, sf_dir, stored=True), KDE_FEATURE, "ship_type")


_PAIRS = [(a, b) for i, a in enumerate(ANALYSIS_FEATURES) for b in ANALYSIS_FEATURES[i:]]


@register("correlations", rounded(with_ctes(_W + [("cc", "SELECT " + ", ".join(
    f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS "{a}|{b}"' for a, b in _PAIRS) + " FROM weekly")],
    f"""SELECT split_part(pair, '|', 1) AS a, split_part(pair, '|', 2) AS b, corr FROM cc
UNPIVOT INCLUDE NULLS (corr FOR pair IN ({', '.join(f'"{a}|{b}"' for a, b in _PAIRS)}))"""), ["corr"]))
def q_correlations(spark, sf_dir):
    return ST.correlations(weekly(spark, sf_dir), ANALYSIS_FEATURES)


_ANOVA_SQL = with_ctes(_W + [_ASRC_COMPLETE, _ALONG, (
    "per", """SELECT feature, class, count(value) AS n, avg(value) AS m, var_samp(value) AS v, sum(value) AS s
FROM along GROUP BY ALL"""), (
    "g", "SELECT *, sum(s) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS gm FROM per")],
    """SELECT feature, count(*) - 1 AS df_between, CAST(sum(n) - count(*) AS BIGINT) AS df_within,
  (sum(n * (m - gm) * (m - gm)) / (count(*) - 1)) / (sum(coalesce((n - 1) * v, 0)) / (sum(n) - count(*)))
    AS f_stat
FROM g GROUP BY feature""")


@register("anova_f", rounded(_ANOVA_SQL, ["f_stat"]))
def q_anova_f(spark, sf_dir):
    return ST.anova_f(complete_weekly(spark, sf_dir), ANALYSIS_FEATURES, "ship_type")


# The p-value oracles use the finite series that hold for an even number of
# degrees of freedom in the numerator (df_between = classes - 1 = 4 here):
#   F:    P(F > f)  = sum_{j < b} G(a + j) / (G(a) j!) x^a (1 - x)^j,
#         a = df_within / 2, b = df_between / 2, x = df_within / (df_within + df_between f)
#   chi2: P(X > h)  = sum_{i < m} e^-y y^i / i!,  m = df / 2, y = h / 2
# An independent check of the continued-fraction tails run by Spark; odd
# degrees of freedom give NULL here.
def _f_pvalue_sql(base: str) -> str:
    return f"""WITH base AS (SELECT * FROM (
{base}
) _b),
terms AS (SELECT feature, df_within / 2e0 AS a, df_within / (df_within + df_between * f_stat) AS x,
  unnest(range(0, CAST(df_between // 2 AS BIGINT))) AS j
  FROM base WHERE df_between % 2 = 0 AND f_stat > 0),
tail AS (SELECT feature, sum(exp(lgamma(a + j) - lgamma(a) - lgamma(j + 1) + a * ln(x)
  + CASE WHEN j = 0 THEN 0e0 ELSE j * ln(1 - x) END)) AS p FROM terms GROUP BY feature)
SELECT base.*, CASE WHEN f_stat IS NULL OR isnan(f_stat) THEN 'NaN'::DOUBLE WHEN f_stat <= 0 THEN 1e0
  ELSE tail.p END AS p_value
FROM base LEFT JOIN tail USING (feature)"""


def _chi2_pvalue_sql(base: str) -> str:
    return f"""WITH base AS (SELECT * FROM (
{base}
) _b),
terms AS (SELECT feature, h_stat / 2e0 AS y, unnest(range(0, CAST(df // 2 AS BIGINT))) AS i
  FROM base WHERE df % 2 = 0 AND h_stat > 0),
tail AS (SELECT feature, sum(exp(-y - lgamma(i + 1) + CASE WHEN i = 0 THEN 0e0 ELSE i * ln(y) END)) AS p
  FROM terms GROUP BY feature)
SELECT base.*, CASE WHEN h_stat IS NULL OR isnan(h_stat) THEN 'NaN'::DOUBLE WHEN h_stat <= 0 THEN 1e0
  ELSE tail.p END AS p_value
FROM base LEFT JOIN tail USING (feature)"""


@register("anova_pvalues", rounded(_f_pvalue_sql(_ANOVA_SQL), ["f_stat", "p_value"]))
def q_anova_pvalues(spark, sf_dir):
    return ST.with_pvalues(anova=ST.anova_f(complete_weekly(spark, sf_dir), ANALYSIS_FEATURES, "ship_type"))


_KRUSKAL_SQL = with_ctes(_W + [_ASRC_COMPLETE, _ALONG,
    ("kc", "SELECT feature, value, class, count(*) AS n FROM along GROUP BY ALL"),
    ("vt", "SELECT feature, value, sum(n) AS t FROM kc GROUP BY ALL"),
    ("rk", """SELECT feature, value, t, coalesce(sum(t) OVER (PARTITION BY feature ORDER BY value
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2 AS avg_rank FROM vt"""),
    ("rs", """SELECT kc.feature, kc.class, sum(kc.n * rk.avg_rank) AS r, sum(kc.n) AS nc
FROM kc JOIN rk USING (feature, value) GROUP BY ALL"""),
    ("per", "SELECT feature, sum(r * r / nc) AS s, count(*) AS k FROM rs GROUP BY feature"),
    ("ties", """SELECT feature, sum(pow(CAST(t AS DOUBLE), 3) - t) AS tie_sum, CAST(sum(t) AS DOUBLE) AS nn
FROM vt GROUP BY feature""")],
    """SELECT feature, k - 1 AS df,
  (12e0 / (nn * (nn + 1)) * s - 3 * (nn + 1)) / (1 - tie_sum / (nn * nn * nn - nn)) AS h_stat
FROM per JOIN ties USING (feature)""")


@register("kruskal_h", rounded(_KRUSKAL_SQL, ["h_stat"]))
def q_kruskal_h(spark, sf_dir):
    return ST.kruskal_h(complete_weekly(spark, sf_dir), ANALYSIS_FEATURES, "ship_type")


@register("kruskal_pvalues", rounded(_chi2_pvalue_sql(_KRUSKAL_SQL), ["h_stat", "p_value"]))
def q_kruskal_pvalues(spark, sf_dir):
    return ST.with_pvalues(kruskal=ST.kruskal_h(complete_weekly(spark, sf_dir), ANALYSIS_FEATURES, "ship_type"))


# ---------------------------------------------------------------- drift views and importance weighting


PIVOT_CLASSES = ["Cargo", "Fishing", "Passenger", "Tanker", "Tug"]


@register("psi_heatmap", None)
def q_psi_heatmap(spark, sf_dir):
    """the table over all periods, then in long form again, one row per cell."""
    wide = D.psi_heatmap(psi_by_class_df(spark, sf_dir))
    return wide.unpivot(["class", "feature"], [F.col(f"`{c}`") for c in wide.columns[2:]], "period", "psi").withColumn(
        "period", F.to_date("period"))


@register("class_balance_pivot", None)
def q_class_balance_pivot(spark, sf_dir):
    bal = D.class_balance(weekly(spark, sf_dir), "ship_type", "week_start")
    return D.class_balance_pivot(bal, "ship_type", "week_start", PIVOT_CLASSES)


def anova_importances(w, features=MODEL_FEATURES):
    """Importance of a feature = its share of the summed ANOVA F over features
    (of the complete rows); stored, one row per feature."""
    f = ST.anova_f(w.na.drop(), features, "ship_type").where(F.col("f_stat").isNotNull()).transform(materialize)
    total = f.select(F.sum("f_stat")).scalar()
    return f.select("feature", (F.col("f_stat") / total).alias("importance"))


@register("weighted_drift", None)
def q_weighted_drift(spark, sf_dir):
    w, base = weekly_with_baseline(spark, sf_dir)
    return D.weighted_drift(psi_of_weekly(w, base), anova_importances(w))


@register("alarms_by_importance", None)
def q_alarms_by_importance(spark, sf_dir):
    w, base = weekly_with_baseline(spark, sf_dir)
    flagged = D.check_drift(psi_of_weekly(w, base))
    return D.alarms_by_importance(flagged, anova_importances(w)).select(
        "period", "feature", "class", "psi", "importance", "severity")


def _anova_ctes(features, name="anova"):
    return [("masrc", _ASRC_COMPLETE[1]), ("malong", long_sql("masrc", features, False)),
            ("mper", """SELECT feature, class, count(value) AS n, avg(value) AS m, var_samp(value) AS v,
  sum(value) AS s FROM malong GROUP BY ALL"""),
            ("mg", "SELECT *, sum(s) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS gm FROM mper"),
            (name, """SELECT feature, (sum(n * (m - gm) * (m - gm)) / (count(*) - 1))
  / (sum(coalesce((n - 1) * v, 0)) / (sum(n) - count(*))) AS f_stat FROM mg GROUP BY feature"""),
            ("imp", f"SELECT feature, f_stat / sum(f_stat) OVER () AS importance FROM {name} WHERE f_stat IS NOT NULL")]


ORACLE["psi_heatmap"] = rounded(with_ctes(_by_class_ctes(), """SELECT r.class, r.feature, c.period, s.psi
FROM (SELECT DISTINCT class, feature FROM scored) r CROSS JOIN (SELECT DISTINCT period FROM scored) c
LEFT JOIN scored s ON s.class = r.class AND s.feature = r.feature AND s.period = c.period"""), ["psi"])
_shares = ", ".join(f"coalesce(max(CASE WHEN ship_type = '{c}' THEN proportion END), 0) AS \"{c}\"" for c in PIVOT_CLASSES)
ORACLE["class_balance_pivot"] = rounded(with_ctes(_W, f"""SELECT week_start, {_shares}
FROM (SELECT ship_type, week_start, n / sum(n) OVER (PARTITION BY week_start) AS proportion
  FROM (SELECT ship_type, week_start, count(*) AS n FROM weekly GROUP BY ALL) t) s GROUP BY week_start"""), PIVOT_CLASSES)
ORACLE["weighted_drift"] = rounded(with_ctes(_by_class_ctes() + _anova_ctes(MODEL_FEATURES), """SELECT period, class,
  sum(psi * importance) AS weighted_psi, count(psi) AS n_features
FROM scored JOIN imp USING (feature) GROUP BY period, class"""), ["weighted_psi"])
ORACLE["alarms_by_importance"] = rounded(with_ctes(_by_class_ctes() + _anova_ctes(MODEL_FEATURES), """SELECT
  period, feature, class, psi, importance, psi * coalesce(importance, 0) AS severity
FROM scored LEFT JOIN imp USING (feature) WHERE psi > 25e-2"""), ["psi", "importance", "severity"])


# ---------------------------------------------------------------- evaluation (rule-based predictions)

# A deterministic rule stands in for a model so the metric operators can be
# checked against SQL; the forest's own scores are the rows-only queries.
RULE_PREDICTION = ("CASE WHEN fishing_ratio >= 25e-2 THEN 'Fishing' WHEN moored_ratio >= 25e-2 THEN 'Tug' "
                   "WHEN anchor_ratio >= 25e-2 THEN 'Tanker' WHEN length >= 15e1 THEN 'Passenger' ELSE 'Cargo' END")
LI_RULE = "CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'N' END"
SLICE_DAYS = 30


def rule_scored(spark, sf_dir):
    w = weekly(spark, sf_dir, groups=["identity", "dimensions", "status"])
    return w.select("imo", "week_start", F.col("ship_type").alias("label"),
                    F.expr(RULE_PREDICTION).alias("prediction"))


def report_sql(src: str, by: list[str]) -> list[tuple[str, str]]:
    b = "".join(f"{c}, " for c in by)
    on = "".join(f"x.{c} = c.{c} AND " for c in by)
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return [
        ("conf", f"SELECT {b}CAST(label AS VARCHAR) AS label, CAST(prediction AS VARCHAR) AS prediction, "
                 f"count(*) AS n FROM {src} GROUP BY ALL"),
        ("cls", f"SELECT DISTINCT {b}label AS class FROM conf UNION SELECT DISTINCT {b}prediction FROM conf"),
        ("pc", f"""SELECT c.*, coalesce(x.tp, 0) AS tp, coalesce(y.sup, 0) AS support, coalesce(z.pr, 0) AS predicted
FROM cls c
LEFT JOIN (SELECT {b}label AS class, n AS tp FROM conf WHERE label = prediction) x ON {on}x.class = c.class
LEFT JOIN (SELECT {b}label AS class, sum(n) AS sup FROM conf GROUP BY ALL) y ON {on.replace('x.', 'y.')}y.class = c.class
LEFT JOIN (SELECT {b}prediction AS class, sum(n) AS pr FROM conf GROUP BY ALL) z ON {on.replace('x.', 'z.')}z.class = c.class"""),
        ("pc2", "SELECT *, coalesce(tp / nullif(predicted, 0), 0) AS precision, "
                "coalesce(tp / nullif(support, 0), 0) AS recall FROM pc"),
        ("pc3", "SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pc2"),
        ("report", f"""SELECT {b}class, precision, recall, f1, CAST(support AS BIGINT) AS support FROM pc3
UNION ALL SELECT {b}'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM pc3 {'GROUP BY ' + ', '.join(by) if by else ''}
UNION ALL SELECT {b}'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM pc3 {'GROUP BY ' + ', '.join(by) if by else ''}
UNION ALL SELECT {b}'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), sum(tp) / sum(support),
  CAST(sum(support) AS BIGINT) FROM pc3 {'GROUP BY ' + ', '.join(by) if by else ''}"""),
    ]


_RULE = ("rscored", f"SELECT imo, week_start, ship_type AS label, {RULE_PREDICTION} AS prediction FROM weekly")


@register("confusion", with_ctes(_W + [_RULE], "SELECT label, prediction, count(*) AS n FROM rscored GROUP BY ALL"))
def q_confusion(spark, sf_dir):
    return EV.confusion(rule_scored(spark, sf_dir))


@register("classification_report", rounded(with_ctes(_W + [_RULE] + report_sql("rscored", []),
                                                     "SELECT * FROM report"), ["precision", "recall", "f1"]))
def q_classification_report(spark, sf_dir):
    return EV.classification_report(rule_scored(spark, sf_dir))


_LI_SCORED = ("lscored", f"""SELECT l_returnflag AS label, {LI_RULE} AS prediction,
  CAST(floor(date_diff('day', (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem), CAST(l_shipdate AS DATE))
    / {SLICE_DAYS}) AS BIGINT) AS slice FROM lineitem""")
_LI_KEPT = ("lkept", """SELECT * FROM lscored WHERE slice < (
  SELECT CASE WHEN NOT EXISTS (SELECT 1 FROM lscored WHERE slice = 0) THEN 0
    ELSE (SELECT min(slice + 1) FROM (SELECT DISTINCT slice FROM lscored) p
          WHERE slice + 1 NOT IN (SELECT DISTINCT slice FROM lscored)) END)""")


@register("report_by_slice", rounded(with_ctes([_LI_SCORED, _LI_KEPT] + report_sql("lkept", ["slice"]),
    f"""SELECT slice, CAST((SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem) + CAST(slice * {SLICE_DAYS} AS INTEGER)
  AS DATE) AS slice_start, class, precision, recall, f1, support FROM report"""), ["precision", "recall", "f1"]))
def q_report_by_slice(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", F.col("l_returnflag").alias("label"), F.expr(LI_RULE).alias("prediction"))
    start = li.select(F.min(F.to_date("l_shipdate"))).scalar()
    return EV.report_by_slice(li, "l_shipdate", start, SLICE_DAYS)


# ---------------------------------------------------------------- random forest (rows-only)

def forest_run(spark, sf_dir):
    """Stratified split of the weekly table, forest fitted on the train part."""
    w = weekly(spark, sf_dir, stored=True)
    sp = S.split_random(w, "ship_type", ["imo", "week_start"]).transform(materialize)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    return M.train_forest(train, MODEL_FEATURES, "ship_type"), test


@register("forest_scores")
def q_forest_scores(spark, sf_dir):
    model, test = forest_run(spark, sf_dir)
    scored = M.predict(model, test, MODEL_FEATURES)
    return EV.classification_report(scored, "ship_type", "prediction")


@register("impurity_importance")
def q_impurity_importance(spark, sf_dir):
    return M.impurity_importance(forest_run(spark, sf_dir)[0])


# ---------------------------------------------------------------- permutation importance (of the rule)

# what the rule's answers owe to each feature: its own answers are the labels
RULE_FEATURES = ["fishing_ratio", "moored_ratio", "anchor_ratio", "length"]
PERM_REPEATS = 10


def _shuffled_sql(feature: str) -> str:
    cols = ", ".join(f"d_{c} AS {c}" if c == feature else c for c in RULE_FEATURES)
    return f"""SELECT '{feature}' AS feature, r, avg(CASE WHEN label = {RULE_PREDICTION} THEN 1e0 ELSE 0e0 END) AS acc
FROM (SELECT r, label, {cols} FROM nxt) s GROUP BY r"""


_PERM = _W + [
    ("prm", f"""SELECT r, row_number() OVER (PARTITION BY r ORDER BY {_md5(['imo', 'week_start', 'r'])}) AS rn,
  count(*) OVER (PARTITION BY r) AS n, {RULE_PREDICTION} AS label, {', '.join(RULE_FEATURES)}
FROM weekly, range({PERM_REPEATS}) t(r)"""),
    ("nxt", f"""SELECT a.r, a.label, {', '.join(f'a.{c}, b.{c} AS d_{c}' for c in RULE_FEATURES)}
FROM prm a JOIN prm b ON b.r = a.r AND b.rn = a.rn % a.n + 1"""),
    ("acc", "\nUNION ALL\n".join(_shuffled_sql(f) for f in RULE_FEATURES)),
    ("importances", """SELECT feature, avg(1 - acc) AS importance_mean, stddev_pop(1 - acc) AS importance_std
FROM acc GROUP BY feature""")]


@register("permutation_importance", rounded(with_ctes(_PERM, "SELECT * FROM importances"),
                                            ["importance_mean", "importance_std"]))
def q_permutation_importance(spark, sf_dir):
    rule = F.expr(RULE_PREDICTION)
    w = weekly(spark, sf_dir, groups=["dimensions", "status"]).select("imo", "week_start", *RULE_FEATURES,
                                                                      rule.alias("label"))
    return M.permutation_importance(lambda d: d.withColumn("prediction", rule), w.transform(materialize),
                                    RULE_FEATURES, "label", ["imo", "week_start"], PERM_REPEATS)


@register("selected_features", rounded(with_ctes(_PERM, """SELECT * FROM importances
WHERE importance_mean > 1e-3 AND importance_std < importance_mean"""), ["importance_mean", "importance_std"]))
def q_selected_features(spark, sf_dir):
    return M.select_features(q_permutation_importance(spark, sf_dir))


# ---------------------------------------------------------------- sources, sinks, logs, monitor, stream


MONITOR_PERIOD = "2024-02-05"     # the monitoring run's period label
IDS_FROM_DAY, IDS_TO_DAY = 7, 20  # vessel ids active in [first day + 7, first day + 20]
APPEND_AFTER_DAYS = 14            # the stored table holds the first two weeks


def first_day(df, ts="ts"):
    return df.select(F.min(F.to_date(ts))).scalar()


@register("vessel_ids", with_ctes(_VP, f"""SELECT DISTINCT imo FROM vpings
WHERE CAST(ts AS DATE) BETWEEN (SELECT min(CAST(ts AS DATE)) FROM vpings) + {IDS_FROM_DAY}
  AND (SELECT min(CAST(ts AS DATE)) FROM vpings) + {IDS_TO_DAY}
  AND regexp_matches(CAST(imo AS VARCHAR), '^[0-9]+$')"""))
def q_vessel_ids(spark, sf_dir):
    p = vessel_pings(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    d0 = first_day(p)
    return R.vessel_ids(p, F.date_add(d0, IDS_FROM_DAY), F.date_add(d0, IDS_TO_DAY))


@register("append_new_weeks", with_ctes(_W, f"""SELECT imo, week_start, n_pings FROM weekly
WHERE week_start >= (SELECT min(CAST(date_trunc('week', ts) AS DATE)) FROM vpings) + {APPEND_AFTER_DAYS}"""))
def q_append_new_weeks(spark, sf_dir):
    p = vessel_pings(spark, sf_dir)
    first = p.select(F.min(week_start("ts"))).scalar()
    early = p.where(F.col("ts") < F.date_add(first, APPEND_AFTER_DAYS).cast("timestamp_ntz"))
    stored = weekly_features(early, min_pings=ADAPTER_MIN_PINGS, groups=["temporal"]).select("imo", "week_start")
    fresh = weekly_features(p, min_pings=ADAPTER_MIN_PINGS, groups=["temporal"])
    return K.new_rows(fresh, stored).select("imo", "week_start", "n_pings")


def log_lines(spark, sf_dir):
    """Prediction-log text built from the weekly table: one JSON line per row
    (rule prediction as the class), a truncated copy of every line (malformed)
    and a blank line per week."""
    w = weekly(spark, sf_dir)
    scored = w.withColumn("prediction", F.expr(RULE_PREDICTION)).withColumn(
        "probabilities", F.create_map(F.col("prediction"), F.lit(1.0)))
    # UTC text built from the NTZ wall time: the same whatever the session zone
    stamp = F.concat(F.date_format(F.col("week_start").cast("timestamp_ntz")
                                   + F.make_interval(mins=F.col("imo").cast("int")),
                                   "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    lines = L.to_log_rows(scored, MODEL_FEATURES, ts=stamp).select(F.to_json(F.struct("*")).alias("value"))
    bad = lines.select(F.substring("value", 1, 40).alias("value"))
    blank = w.select("week_start").distinct().select(F.lit("").alias("value"))
    return lines.unionByName(bad).unionByName(blank)


@register("new_predictions", rounded(with_ctes(_W + [("lg", f"""SELECT
  strftime(CAST(week_start AS TIMESTAMP) + to_minutes(imo), '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS timestamp,
  CAST(week_start AS TIMESTAMP) + to_minutes(imo) AS t, {RULE_PREDICTION} AS vessel_type,
  sog_median, CAST(n_pings AS DOUBLE) AS n_pings FROM weekly""")],
    """SELECT timestamp, vessel_type, sog_median, n_pings FROM lg
WHERE t > (SELECT min(t) FROM lg) + INTERVAL 7 DAY"""), ["sog_median", "n_pings"]))
def q_new_predictions(spark, sf_dir):
    """Entries after a cutoff (the first entry + 7 days) from a log with
    blank and malformed lines; feature values are read back from the JSON."""
    lines = log_lines(spark, sf_dir)
    entries = L.parse_log(lines, MODEL_FEATURES)
    since = entries.select(F.min("ts")).scalar()
    return entries.where(F.col("ts") > since + F.expr("INTERVAL 7 DAYS")).select(
        "timestamp", "vessel_type", F.col("features.sog_median").alias("sog_median"),
        F.col("features.n_pings").alias("n_pings"))


@register("monitor_run")
def q_monitor_run(spark, sf_dir):
    w, base = weekly_with_baseline(spark, sf_dir)
    bins, _ = D.build_baselines(base, MODEL_FEATURES)
    entries = L.parse_log(log_lines(spark, sf_dir), MODEL_FEATURES)
    res, _ = J.check_log(spark, entries, bins, MODEL_FEATURES, period=MONITOR_PERIOD)
    return res


# every valid log line is one weekly row (features survive the JSON round trip
# exactly), so the check equals a pooled PSI of all weekly rows in one period
def _log_check_ctes(period_sql: str) -> list[tuple[str, str]]:
    return (_W + [("wsrc", f"SELECT '__all__' AS class, {period_sql} AS period, * FROM weekly"),
                  ("wbase", f"""SELECT * FROM wsrc WHERE week_start < (SELECT min(week_start) FROM wsrc)
  + {WEEKLY_BASELINE_DAYS}""")]
            + OD.baseline_ctes("wbase", MODEL_FEATURES) + OD.monitor_ctes("wsrc", MODEL_FEATURES))


ORACLE["monitor_run"] = rounded(with_ctes(_log_check_ctes(f"DATE '{MONITOR_PERIOD}'"), "SELECT * FROM scored"),
                                ["psi"])


# append mode emits a week once the watermark (latest ping - 1 day) has passed its end
@register("stream_weekly", rounded(with_ctes(_W, """SELECT * FROM weekly
WHERE CAST(week_start AS TIMESTAMP) + INTERVAL 7 DAY <= (SELECT max(ts) FROM vpings) - INTERVAL 1 DAY"""),
    OW.WEEKLY_DOUBLES))
def q_stream_weekly(spark, sf_dir):
    base = scratch_path(spark, f"stream-weekly-{uuid.uuid4().hex[:12]}")
    schema = table(spark, sf_dir, "events").schema
    q = run_weekly_stream(spark, sf_dir, schema, sink=f"{base}/out", checkpoint=f"{base}/ckpt",
                          file_glob="events.parquet", min_pings=ADAPTER_MIN_PINGS,
                          state_partitions=spark.sparkContext.defaultParallelism,
                          adapt=lambda s: keep_ship_types(pings_from_events(s)))
    q.awaitTermination()
    return read_weeks(spark, f"{base}/out")



# ---------------------------------------------------------------- top-k report, class slice, summary metrics
TOP_K = 10
SLICE_START, SLICE_STOP = 5, 15


@register("drift_top_k", rounded(with_ctes(_by_class_ctes(), f"""SELECT feature, class, max(psi) AS max_psi
FROM scored GROUP BY feature, class ORDER BY round(max_psi, 9) DESC NULLS LAST, feature, class
LIMIT {TOP_K}"""), ["max_psi"]))
def q_drift_top_k(spark, sf_dir):
    return D.rank_by_drift(psi_by_class_df(spark, sf_dir), k=TOP_K)


@register("class_slice", with_ctes(_W, f"""SELECT {_WKEY} FROM (
  SELECT {_WKEY}, row_number() OVER (PARTITION BY ship_type ORDER BY {_md5(['imo', 'week_start'])}, imo,
    week_start) AS rn FROM weekly) t
WHERE rn > {SLICE_START} AND rn <= {SLICE_STOP}"""))
def q_class_slice(spark, sf_dir):
    w = weekly(spark, sf_dir, groups=["identity"], stored=True).select("imo", "week_start", "ship_type")
    return S.class_slice(w, "ship_type", ["imo", "week_start"], SLICE_START, SLICE_STOP)


@register("model_metrics", rounded(with_ctes(_W + [_RULE] + report_sql("rscored", []), """SELECT
  max(CASE WHEN class = 'accuracy' THEN f1 END) AS accuracy,
  max(CASE WHEN class = 'macro avg' THEN f1 END) AS f1_macro, max(support) AS n FROM report"""),
    ["accuracy", "f1_macro"]))
def q_model_metrics(spark, sf_dir):
    return EV.summary_metrics(rule_scored(spark, sf_dir))


# ---------------------------------------------------------------- parameter variants

SAMPLE_FRACTION = 0.05
RANGE_FROM_DAY, RANGE_TO_DAY = 3, 20


@register("split_random_flat", with_ctes(_W, f"""SELECT {_WKEY},
  CASE WHEN rn <= round_even(n * 2e-1, 0) THEN 'test' ELSE 'train' END AS split
FROM (SELECT {_WKEY}, row_number() OVER (ORDER BY {_md5(['imo', 'week_start'])}, imo, week_start) AS rn,
  count(*) OVER () AS n FROM weekly) t"""))
def q_split_random_flat(spark, sf_dir):
    """H1 without stratification (the feature-selection split)."""
    w = weekly(spark, sf_dir, groups=["identity"], stored=True).select("imo", "week_start", "ship_type")
    return S.split_random(w, "ship_type", ["imo", "week_start"], stratify=False)


@register("sample_fraction", f"""SELECT l_orderkey, l_linenumber, l_returnflag FROM (
  SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_returnflag
    ORDER BY {_md5(['l_orderkey', 'l_linenumber'])}, l_orderkey, l_linenumber) AS rn,
    count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) t
WHERE rn <= round_even(n * {SAMPLE_FRACTION}, 0)""")
def q_sample_fraction(spark, sf_dir):
    """J2 with a per-class fraction (5 %) instead of a cap."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return S.sample_stratified(li, "l_returnflag", ["l_orderkey", "l_linenumber"], per_class=None,
                               fraction=SAMPLE_FRACTION)


def _range_ctes():
    ctes = OW.weekly_ctes(ADAPTER_MIN_PINGS, source_cte="rpings")
    ctes.insert(2, ("rpings", f"""SELECT * FROM vpings WHERE CAST(ts AS DATE) BETWEEN
  (SELECT min(CAST(ts AS DATE)) FROM vpings) + {RANGE_FROM_DAY} AND (SELECT min(CAST(ts AS DATE)) FROM vpings) + {RANGE_TO_DAY}"""))
    return ctes


@register("weekly_in_range", rounded(with_ctes(_range_ctes(), """SELECT imo, week_start, n_pings, time_span_seconds,
  mean_ping_interval_seconds FROM weekly"""), ["mean_ping_interval_seconds"]))
def q_weekly_in_range(spark, sf_dir):
    """Roll-up of the pings dated in [first day + 3, first day + 20], inclusive."""
    p = vessel_pings(spark, sf_dir)
    d0 = p.agg(F.min(F.to_date("ts"))).first()[0]  # one scalar
    rng = between_dates(p, d0 + dt.timedelta(days=RANGE_FROM_DAY), d0 + dt.timedelta(days=RANGE_TO_DAY))
    return weekly_features(rng, min_pings=ADAPTER_MIN_PINGS, groups=["temporal"]).select(
        "imo", "week_start", "n_pings", "time_span_seconds", "mean_ping_interval_seconds")


# the whole log is one micro-batch (availableNow, no file limit), checked on
# the processing date (UTC); alarms as in F9 over the pooled class
@register("stream_drift", rounded(with_ctes(_log_check_ctes("CAST(timezone('UTC', now()) AS DATE)"),
    f"""SELECT *, CASE WHEN psi > {PSI_MODERATE!r} THEN 'feature moved: period ' || CAST(period AS VARCHAR)
  || ', ' || feature || ', psi ' || printf('%.2f', psi) END AS alarm, CAST(0 AS INTEGER) AS batch_id
FROM scored"""), ["psi"]))
def q_stream_drift(spark, sf_dir):
    """K2: the prediction log (built from the weekly table) lands as files and the
    streaming check compares each batch with the baseline weeks."""
    from ..streaming.jobs import run_drift_stream
    base = scratch_path(spark, f"stream-drift-{uuid.uuid4().hex[:12]}")
    log_lines(spark, sf_dir).write.text(f"{base}/log")
    _, baseline = weekly_with_baseline(spark, sf_dir)
    bins, _ = D.build_baselines(baseline, MODEL_FEATURES)
    q = run_drift_stream(spark, f"{base}/log", bins, MODEL_FEATURES, f"{base}/results", f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/results")


DRIFT_BATCHES = 5


@register("stream_drift_batches", rounded(with_ctes(_log_check_ctes(f"DATE '{MONITOR_PERIOD}'"),
    f"""SELECT *, CASE WHEN psi > {PSI_MODERATE!r} THEN 'feature moved: period ' || CAST(period AS VARCHAR)
  || ', ' || feature || ', psi ' || printf('%.2f', psi) END AS alarm FROM scored"""), ["psi"]))
def q_stream_drift_batches(spark, sf_dir):
    """K2: the log arrives in five batches of one period, one of which runs again;
    the last check equals one check of the whole log."""
    from ..streaming.jobs import drift_batches, latest_drift, run_drift_stream
    base = scratch_path(spark, f"stream-drift-{uuid.uuid4().hex[:12]}")
    lines = log_lines(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(DRIFT_BATCHES))).transform(materialize)
    _, baseline = weekly_with_baseline(spark, sf_dir)
    bins, _ = D.build_baselines(baseline, MODEL_FEATURES)
    period = F.lit(MONITOR_PERIOD).cast("date")
    for k in range(DRIFT_BATCHES):
        lines.where(F.col("part") == k).select("value").write.mode("append").text(f"{base}/log")
        run_drift_stream(spark, f"{base}/log", bins, MODEL_FEATURES, f"{base}/results", f"{base}/ckpt",
                         counts_path=f"{base}/counts", period=period).awaitTermination()
    again = drift_batches(bins, MODEL_FEATURES, f"{base}/results", f"{base}/counts", period=period)
    again(lines.where(F.col("part") == 2).select("value"), 2)
    return latest_drift(spark.read.parquet(f"{base}/results")).drop("batch_id")
