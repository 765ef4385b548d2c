"""DuckDB text of the weekly roll-up, used as a CTE by many oracle queries."""

from __future__ import annotations

from ..config import CARGO_RATIOS, NAV_STATUS_RATIOS
from .sqltext import PINGS_CTE, VESSEL_PINGS_CTE, q

WEEKLY_DOUBLES = [
    "length", "width", "max_draught", "min_draught", "draught_variability",
    "mean_moving_speed", "max_speed", "std_speed", "sog_p10", "sog_median", "sog_p90",
    "frac_time_slow", "frac_time_fast", "cog_variability", "rot_mean_abs", "rot_std",
    "heading_cog_diff_mean", *NAV_STATUS_RATIOS, "lat_std", "lon_std", "lat_mean", "lon_mean",
    "bbox_area", *CARGO_RATIOS, "length_beam_ratio", "draught_length_ratio", "sog_bimodality",
    "mean_ping_interval_seconds",
]


def _mode_cte(col: str) -> str:
    return (f"SELECT imo, week_start, {col} AS v FROM (SELECT imo, week_start, {col}, "
            f"row_number() OVER (PARTITION BY imo, week_start ORDER BY count(*) DESC, {col}) AS rn "
            f"FROM wb WHERE {col} IS NOT NULL GROUP BY imo, week_start, {col}) t WHERE rn = 1")


def _nearest(q_: str) -> str:
    return f"_s[CAST(floor((_ns - 1) * {q_} + 5e-1) AS BIGINT) + 1]"


def _whole(x: str) -> str:
    """A reading in steps of 1e-9, as a whole number."""
    return f"CAST(floor({x} * 1e9 + 5e-1) AS HUGEINT)"


def exact_mean(x: str) -> str:
    return f"CAST(sum({_whole(x)}) AS DOUBLE) / count({x}) / 1e9"


def exact_std(x: str) -> str:
    v = _whole(x)
    return (f"CASE WHEN count({x}) > 1 THEN sqrt(CAST(count({x}) * CAST(sum({v} * {v}) AS HUGEINT) - CAST(sum({v}) AS HUGEINT) * "
            f"CAST(sum({v}) AS HUGEINT) AS DOUBLE) / (count({x}) * (count({x}) - 1)) / (1e9 * 1e9)) END")


def weekly_ctes(min_pings: int, source_cte: str = "vpings") -> list[tuple[str, str]]:
    pmod = "CASE WHEN (heading - cog + 18e1) % 36e1 < 0 THEN (heading - cog + 18e1) % 36e1 + 36e1 " \
           "ELSE (heading - cog + 18e1) % 36e1 END"
    status = ",\n  ".join(f"count_if(nav_status = {q(v)}) / count(ts) AS {k}"
                          for k, v in NAV_STATUS_RATIOS.items())
    cargo = ",\n  ".join(f"count_if(cargo_type = {q(v)}) / count(ts) AS {k}"
                         for k, v in CARGO_RATIOS.items())
    agg = f"""SELECT imo, week_start,
  max(draught) AS max_draught, min(draught) AS min_draught,
  max(draught) - min(draught) AS draught_variability,
  {exact_mean("(CASE WHEN sog > 5e-1 THEN sog END)")} AS mean_moving_speed,
  max(sog) AS max_speed, {exact_std("sog")} AS std_speed,
  list_sort(list(sog) FILTER (WHERE sog IS NOT NULL)) AS _s, count(sog) AS _ns,
  count_if(sog < 1e0) / count(*) AS frac_time_slow,
  count_if(sog > 1e1) / count(*) AS frac_time_fast,
  {exact_std("cog")} AS cog_variability, {exact_mean("abs(rot)")} AS rot_mean_abs,
  {exact_std("abs(rot)")} AS rot_std,
  {exact_mean(f"abs(({pmod}) - 18e1)")} AS heading_cog_diff_mean,
  count(DISTINCT nav_status) + max(CASE WHEN nav_status IS NULL THEN 1 ELSE 0 END) AS n_nav_statuses,
  {status},
  {exact_std("latitude")} AS lat_std, {exact_std("longitude")} AS lon_std,
  {exact_mean("latitude")} AS lat_mean, {exact_mean("longitude")} AS lon_mean,
  (max(latitude) - min(latitude)) * (max(longitude) - min(longitude)) AS bbox_area,
  {cargo},
  count(ts) AS n_pings,
  (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS time_span_seconds
FROM wb GROUP BY imo, week_start HAVING count(ts) >= {int(min_pings)}"""
    weekly = f"""SELECT a.imo, a.week_start, ms.v AS ship_type, ml.v AS length, mw.v AS width,
  max_draught, min_draught, draught_variability, mean_moving_speed, max_speed, std_speed,
  {_nearest('1e-1')} AS sog_p10, {_nearest('5e-1')} AS sog_median, {_nearest('9e-1')} AS sog_p90,
  frac_time_slow, frac_time_fast, cog_variability, rot_mean_abs, rot_std, heading_cog_diff_mean,
  n_nav_statuses, {', '.join(NAV_STATUS_RATIOS)}, lat_std, lon_std, lat_mean, lon_mean, bbox_area,
  {', '.join(CARGO_RATIOS)}, n_pings, time_span_seconds,
  ml.v / (mw.v + 1e-6) AS length_beam_ratio,
  max_draught / (ml.v + 1e-6) AS draught_length_ratio,
  ({_nearest('9e-1')} - {_nearest('1e-1')}) / (std_speed + 1e-6) AS sog_bimodality,
  time_span_seconds / greatest(n_pings - 1, 1) AS mean_ping_interval_seconds
FROM wagg a
LEFT JOIN m_ship ms USING (imo, week_start)
LEFT JOIN m_len ml USING (imo, week_start)
LEFT JOIN m_wid mw USING (imo, week_start)"""
    return [
        PINGS_CTE, VESSEL_PINGS_CTE,
        ("wb", f"SELECT *, CAST(date_trunc('week', ts) AS DATE) AS week_start FROM {source_cte} "
               "WHERE ts IS NOT NULL"),
        ("wagg", agg),
        ("m_ship", _mode_cte("ship_type")),
        ("m_len", _mode_cte("length")),
        ("m_wid", _mode_cte("width")),
        ("weekly", weekly),
    ]
