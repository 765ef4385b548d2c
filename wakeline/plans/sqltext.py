"""Helpers to compose the DuckDB oracle SQL text."""

from __future__ import annotations

from ..sources.adapters import pings_sql
from ..config import SHIP_TYPES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def rounded(sql: str, double_cols, digits: int = 6) -> str:
    """Round the named DOUBLE columns of a query's output."""
    if not double_cols:
        return sql
    # "+ 0e0" turns a rounded -0.0 into 0.0, as Spark's decimal rounding does
    rep = ", ".join(f"round({c} * (1 + 1e-11), {digits}) + 0e0 AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _out"


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {parts}\n{body}"


PINGS_CTE = ("pings", pings_sql("events"))
VESSEL_PINGS_CTE = ("vpings", f"SELECT * FROM pings WHERE ship_type IN {in_list(SHIP_TYPES)}")
