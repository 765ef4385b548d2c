"""Exact means and deviations: whole-number power sums that can be merged.

A reading is taken in steps of 1 / ``STEPS``, as a whole number.  Its sum and
the sum of its squares are then exact, so they do not depend on the order of
the rows, on the partitioning, or on how often partial sums were merged.  The
square is added up in three parts (the number is split at ``LOW_BITS``), each
in a BIGINT that whole-stage code adds up; they are put together as a
DECIMAL(38, 0) once per group.

Bounds: readings under ``LIMIT`` in size, and 2**21 of them per group; a sum
beyond that raises, it never wraps.  A group with a reading that is NaN or not
under ``LIMIT`` (no field of a position report is) gets NaN.  NULL readings do
not count; a mean of none and a deviation of fewer than two is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 1e9
LIMIT = 4096.0
LOW_BITS = 21


def power_sums(name: str, x: Column, squares: bool = True) -> dict[str, Column]:
    """The columns whose sums over the rows are the moments ``name`` of ``x``."""
    v = F.when(F.abs(x) < LIMIT, F.floor(x * STEPS + 0.5))
    out = {f"{name}_n": F.when(v.isNotNull(), 1).otherwise(0),
           f"{name}_odd": F.when(x.isNotNull() & v.isNull(), 1).otherwise(0),
           f"{name}_s": v}
    if squares:
        high, low = F.shiftright(v, LOW_BITS), v.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
        out |= {f"{name}_hh": high * high, f"{name}_hl": high * low, f"{name}_ll": low * low}
    return out


def _defined(name: str, value: Column) -> Column:
    return F.when(F.col(f"{name}_odd") > 0, F.lit(float("nan"))).otherwise(value)


def mean(name: str) -> Column:
    n = F.col(f"{name}_n")
    return _defined(name, F.when(n > 0, F.col(f"{name}_s").cast("double") / n / STEPS))


def deviation(name: str) -> Column:
    """Sample standard deviation from n * sum of squares - (sum) squared, a whole number."""
    def whole(part: str) -> Column:
        return F.col(f"{name}_{part}").cast("decimal(19,0)")

    def power(bits: int) -> Column:
        return F.lit(str(1 << bits)).cast("decimal(14,0)")

    n, total = F.col(f"{name}_n"), whole("s")
    squares = (whole("hh") * power(2 * LOW_BITS) + whole("hl") * power(LOW_BITS + 1)).cast("decimal(38,0)") + whole("ll")
    spread = (n.cast("decimal(10,0)") * squares.cast("decimal(28,0)")).cast("decimal(38,0)") - total * total
    return _defined(name, F.when(n > 1, F.sqrt(spread.cast("double") / (n * (n - 1)) / (STEPS * STEPS))))
