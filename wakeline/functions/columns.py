"""Reusable column expressions.

Each helper returns a ``Column`` built from ``pyspark.sql.functions`` so it stays
inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PSI_EPSILON, PSI_MODERATE, PSI_STABLE

__all__ = [
    "col_of", "circular_abs_diff", "share_where", "n_distinct_incl_null", "mode_of",
    "safe_div", "clip_low", "psi_term", "kl_term", "bin_of", "hash_order", "psi_band",
    "round_doubles", "week_start", "utc_instant", "utc_date", "month_start", "nearest_rank", "is_digits",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def circular_abs_diff(a, b) -> Column:
    """|a - b| on a 360-degree circle, in [0, 180].  Uses floor modulo (pmod):
    a truncating ``%`` keeps the sign and would leave values below -180."""
    return F.abs(F.pmod(col_of(a) - col_of(b) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0))


def share_where(cond: Column, denom) -> Column:
    """Rows matching ``cond`` over the non-null count of ``denom`` (aggregate)."""
    return F.count_if(cond) / F.count(col_of(denom))


def n_distinct_incl_null(c) -> Column:
    """Distinct values where NULL counts as one value (aggregate).  Uses a
    bounded set per group, no distinct-aggregate expand."""
    c = col_of(c)
    return (F.size(F.collect_set(c)) + F.max(F.when(c.isNull(), 1).otherwise(0))).cast("long")


def mode_of(c) -> Column:
    """Most frequent non-null value; the smallest one wins a tie (aggregate)."""
    return F.mode(col_of(c), True)


def safe_div(a, b) -> Column:
    """a / b, NULL when b is zero (ANSI mode would raise)."""
    return F.try_divide(col_of(a), col_of(b))


def clip_low(c, eps: float = PSI_EPSILON) -> Column:
    return F.greatest(col_of(c), F.lit(eps))


def psi_term(comp, ref, eps: float = PSI_EPSILON) -> Column:
    """One bin's contribution to the population stability index."""
    c, r = clip_low(comp, eps), clip_low(ref, eps)
    return (c - r) * F.ln(c / r)


def kl_term(comp, ref, eps: float = PSI_EPSILON) -> Column:
    """One bin's contribution to KL(comp || ref), same clipping as PSI."""
    c, r = clip_low(comp, eps), clip_low(ref, eps)
    return c * F.ln(c / r)


def bin_of(edges, v, max_edges: int | None = None) -> Column:
    """Number of interior edges <= v: left-closed bins, bin 0 below the first edge.

    With ``max_edges`` known (n_bins - 1), the count is an unrolled sum of
    comparisons that stays inside whole-stage codegen; a lambda over the array
    (``filter``) would be evaluated interpreted, row by row.
    """
    v, e = col_of(v), col_of(edges)
    if max_edges is None:
        return F.size(F.filter(e, lambda x: x <= v)).cast("long")
    terms = [F.when(F.try_element_at(e, F.lit(i)) <= v, 1).otherwise(0) for i in range(1, max_edges + 1)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total.cast("long")


def hash_order(cols, seed: int) -> Column:
    """Deterministic pseudo-random order key, stable under repartitioning."""
    parts = [col_of(c).cast("string") for c in cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def psi_band(psi) -> Column:
    p = col_of(psi)
    return (F.when(p.isNull(), F.lit(None).cast("string"))
            .when(p < PSI_STABLE, "stable")
            .when(p < PSI_MODERATE, "moderate")
            .otherwise("significant"))


def week_start(ts) -> Column:
    """Monday of the ts's week, as DATE (no time-zone conversion of NTZ values)."""
    c = col_of(ts)
    return F.date_sub(F.to_date(c), (F.dayofweek(c) + 5) % 7)


def month_start(ts) -> Column:
    """First day of the ts's month, as DATE."""
    return F.trunc(F.to_date(col_of(ts)), "month")


def utc_instant(ts) -> Column:
    """A TIMESTAMP instant whose UTC wall time equals the TIMESTAMP_NTZ value,
    whatever the session time zone (event time for watermarks and windows)."""
    c = col_of(ts)
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def utc_date(instant) -> Column:
    """The UTC calendar date of a TIMESTAMP instant, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(col_of(instant)) / 86400).cast("int"))


def nearest_rank(n, q: float) -> Column:
    """0-based rank of the 'nearest' quantile rule: round((n - 1) * q), half up."""
    return F.floor((col_of(n) - 1) * F.lit(float(q)) + F.lit(0.5))


def is_digits(c) -> Column:
    return col_of(c).cast("string").rlike("^[0-9]+$")


# Relative nudge applied before rounding for comparisons: values on a rounding
# tie (exact decimal inputs, power-of-two counts) then land on the same side in
# engines that sum in a different order or round through a scaled float.
ROUND_NUDGE = 1e-11


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE/FLOAT column (for engine-to-engine comparison)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name) * F.lit(1.0 + ROUND_NUDGE), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
