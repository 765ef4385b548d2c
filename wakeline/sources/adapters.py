"""Driver tables re-shaped into the inputs the operators expect.

No position-report data ships with the task, so a ``pings`` view is derived
from ``events`` by plain SQL expressions.  The same expression text is used by
the Spark job and by the DuckDB oracle, so both engines see identical inputs.
Constants are written with an exponent (``1e1``) so they are DOUBLE in both
engines rather than DECIMAL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import table

# group index parsed from the JSON-ish props column
EVENTS_K = "TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k"

PINGS_COLUMNS = [
    "user_id AS imo",
    "ts AS ts",
    "CASE user_id % 6 WHEN 0 THEN 'Cargo' WHEN 1 THEN 'Tanker' WHEN 2 THEN 'Fishing' "
    "WHEN 3 THEN 'Tug' WHEN 4 THEN 'Passenger' ELSE 'Pleasure' END AS ship_type",
    "CAST(50 + user_id % 200 + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS length",
    "CAST(10 + user_id % 20 AS DOUBLE) AS width",
    "CASE WHEN k % 11 = 0 THEN NULL ELSE 5 + k % 10 / 2e0 END AS draught",
    "CASE WHEN k % 13 = 0 THEN NULL ELSE value / 1e1 END AS sog",
    "k * 36e-1 AS cog",
    "CAST(k % 41 - 20 AS DOUBLE) AS rot",
    "CAST(event_id * 37 % 360 AS DOUBLE) AS heading",
    "CASE event_type WHEN 'click' THEN 'Under way using engine' WHEN 'view' THEN 'At anchor' "
    "WHEN 'purchase' THEN 'Engaged in fishing' WHEN 'signup' THEN 'Moored' END AS nav_status",
    "54 + event_id % 400 / 1e2 AS latitude",
    "8 + k / 2e1 AS longitude",
    "CASE k % 7 WHEN 0 THEN 'Category X' WHEN 1 THEN 'Category Y' WHEN 2 THEN 'Category Z' "
    "WHEN 3 THEN 'Category OS' WHEN 4 THEN 'Reserved for future use' WHEN 5 THEN NULL "
    "ELSE 'No additional information' END AS cargo_type",
]


def pings_sql(events_relation: str = "events") -> str:
    """SQL text of the adapter, shared with the oracle."""
    cols = ",\n  ".join(PINGS_COLUMNS)
    return f"SELECT\n  {cols}\nFROM (SELECT *, {EVENTS_K} FROM {events_relation}) ev"


def pings_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr("*", EVENTS_K).selectExpr(*PINGS_COLUMNS)


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pings_from_events(table(spark, sf_dir, "events"))
