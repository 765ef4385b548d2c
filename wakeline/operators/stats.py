"""Profiles and statistical tests.

All of them are aggregates over Spark-partitioned data; only tables with one
row per feature / class / grid point ever reach a Python function (p-value
tails), and those are bounded by the number of features.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .drift import broadcast_if_small, to_long
from .prefix import running_sum
from .quantiles import exact_quantiles

KDE_GRID = 200
KDE_CUT = 3.0
HIST_BINS = 10_000


def rows_per_entity(df: DataFrame, key: str) -> DataFrame:
    """Rows per entity, most active first."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"))


def track_order(df: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """G1: the times of each entity in order: ``n`` rows at the time and
    ``n_before`` earlier rows.  An entity with most rows is cut into ranges."""
    times = df.groupBy(key, ts).agg(F.count(F.lit(1)).alias("n"))
    return running_sum(times, [key], ts, "n", out="n_before").select(key, ts, "n", "n_before")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of each value of several columns, long form (NULL counted)."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.explode(items).alias("_it")).select("_it.column", "_it.value")
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))


def activity_profile(df: DataFrame, key: str, busy: int = 60 * 24, quiet: int = 24 * 6) -> DataFrame:
    """Rows, entities, max / median / mean rows per entity, counts above
    ``busy`` and under ``quiet`` rows (median: mean of the two middle values)."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("rc")).withColumn("_g", F.lit(0)).transform(materialize)
    med = exact_quantiles(per, ["_g"], "rc", {"median_rows": 0.5}, method="linear")
    agg = per.groupBy("_g").agg(
        F.sum("rc").alias("n_rows"), F.count(F.lit(1)).alias("n_entities"),
        F.max("rc").alias("max_rows"), F.avg("rc").alias("mean_rows"),
        F.count_if(F.col("rc") > busy).alias("n_busy"), F.count_if(F.col("rc") < quiet).alias("n_quiet"))
    return agg.join(med.drop("n"), "_g").select("n_rows", "n_entities", "max_rows", "median_rows",
                                                "mean_rows", "n_busy", "n_quiet")


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column, % NULL, % "Unknown"/"Unknown value", % "Undefined" and total, in one pass."""
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        s = F.col(c).cast("string")
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}"),
                 F.count_if(s.isin("Unknown", "Unknown value")).alias(f"u{i}"),
                 F.count_if(s == "Undefined").alias(f"d{i}")]
    one = df.agg(*aggs)
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nn"),
                               F.col(f"u{i}").alias("nu"), F.col(f"d{i}").alias("nd"))
                      for i, c in enumerate(columns)])
    long_df = one.select("_n", F.explode(items).alias("_it")).select("_n", "_it.*")
    pct = lambda c: F.col(c) / F.col("_n") * 100
    return long_df.select("column", pct("nn").alias("pct_null"), pct("nu").alias("pct_unknown"),
                          pct("nd").alias("pct_undefined"),
                          ((F.col("nn") + F.col("nu") + F.col("nd")) / F.col("_n") * 100).alias("pct_missing"))


def grouped_describe(df: DataFrame, features: Sequence[str], class_col: str) -> DataFrame:
    """Count, mean, std, min, quartiles (linear), max per class and feature."""
    long_df = to_long(df, features, class_col)
    base = long_df.groupBy("feature", "class").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    qs = exact_quantiles(long_df, ["feature", "class"], "value",
                         {"p25": 0.25, "p50": 0.5, "p75": 0.75}, method="linear").drop("n")
    return base.join(qs, ["feature", "class"]).select(
        "feature", "class", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(values: DataFrame, value: str, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width counts over [min, max]; the last bin is closed on the right.
    Dense: every bin appears, empty ones with count 0."""
    v = values.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    lo, hi = v.select(F.min("v")).scalar(), v.select(F.max("v")).scalar()  # scalar subqueries
    idx = F.least(F.floor((F.col("v") - lo) * bins / (hi - lo)), F.lit(bins - 1))
    idx = F.when(hi == lo, F.lit(0)).otherwise(idx).cast("long")
    counts = v.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / bins
    grid = values.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (grid.join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("lo"),
                    (lo + (F.col("bin") + 1) * width).alias("hi"),
                    F.coalesce("count", F.lit(0)).alias("count"))
            .where(lo.isNotNull()))


def box_summary(df: DataFrame, features: Sequence[str], class_col: str) -> DataFrame:
    """Quartiles and 1.5-IQR whiskers (most extreme values inside the fences)."""
    long_df = to_long(df, features, class_col)
    qs = exact_quantiles(long_df, ["feature", "class"], "value",
                         {"q1": 0.25, "median": 0.5, "q3": 0.75}, method="linear")
    # one row per feature and class, read for its size, the fences and the result
    qs = qs.withColumn("iqr", F.col("q3") - F.col("q1")).transform(materialize)
    fences = qs.select("feature", "class", (F.col("q1") - 1.5 * F.col("iqr")).alias("_lf"),
                       (F.col("q3") + 1.5 * F.col("iqr")).alias("_hf"))
    inside = long_df.join(broadcast_if_small(fences), ["feature", "class"]).groupBy("feature", "class").agg(
        F.min(F.when(F.col("value") >= F.col("_lf"), F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= F.col("_hf"), F.col("value"))).alias("whisker_high"))
    return qs.join(inside, ["feature", "class"]).select(
        "feature", "class", "n", "q1", "median", "q3", "iqr", "whisker_low", "whisker_high")


#: Cells per bandwidth, terms of the expansion, and bandwidths beyond which a kernel is 0.
KDE_CELLS = 64
KDE_TERMS = 6
KDE_REACH = 8.5


def _hermite(z: Column, terms: int) -> list[Column]:
    """He_0 .. of z: He_k+1 = z He_k - k He_k-1."""
    out = [F.lit(1.0), z]
    while len(out) < terms:
        out.append(z * out[-1] - (len(out) - 1) * out[-2])
    return out


def kde_cells(v: DataFrame, st: DataFrame) -> DataFrame:
    """(class, v) -> per class and cell of h / ``KDE_CELLS``: the cell's middle
    and the power sums of the distances to it, in bandwidths."""
    width = F.col("h") / KDE_CELLS
    cells = (v.join(broadcast_if_small(st), "class")
             .withColumn("cell", F.floor((F.col("v") - F.col("lo")) / width))
             .withColumn("u", (F.col("v") - F.col("lo")) / F.col("h") - (F.col("cell") + 0.5) / KDE_CELLS))
    power, powers = F.lit(1.0), []
    for k in range(KDE_TERMS):
        powers.append(F.sum(power).alias(f"m{k}"))
        power = power * F.col("u")
    return cells.groupBy("class", "cell").agg(*powers)


def kde_by_class(df: DataFrame, value: str, class_col: str, grid: int = KDE_GRID,
                 cut: float = KDE_CUT) -> DataFrame:
    """Gaussian KDE per class, each normalised on its own (Scott bandwidth
    h = std * n^(-1/5); grid of ``grid`` points from min - cut*h to max + cut*h).

    A fast Gauss transform: values are collapsed, map-side, to power sums per
    cell of h / 64, and a cell's kernels are expanded around its middle,

        exp(-(z - u)^2 / 2) = exp(-z^2 / 2) * sum He_k(z) u^k / k!,

    with |u| <= 1 / 128.  Six terms leave less than 1e-14 of a kernel's height;
    beyond 8.5 bandwidths, where 3e-16 of it is left, nothing is added.  A class
    has at most 64 (max - min) / h cells, whatever its rows and distinct values,
    and each emits the grid points within its reach.
    """
    v = df.select(F.col(class_col).cast("string").alias("class"),
                  F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    st = v.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                                F.min("v").alias("lo"), F.max("v").alias("hi"))
    st = st.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))) \
           .where(F.col("h") > 0)
    st = st.withColumn("g0", F.col("lo") - cut * F.col("h")).withColumn(
        "step", (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid - 1)).transform(materialize)
    h, g0, step = F.col("h"), F.col("g0"), F.col("step")
    middle = F.col("lo") + (F.col("cell") + 0.5) * h / KDE_CELLS
    first = F.greatest(F.lit(0), F.ceil((middle - KDE_REACH * h - g0) / step))
    last = F.least(F.lit(grid - 1), F.floor((middle + KDE_REACH * h - g0) / step))
    reached = kde_cells(v, st).join(broadcast_if_small(st), "class").select(
        "class", "n", "h", "g0", "step", middle.alias("middle"), *[f"m{k}" for k in range(KDE_TERMS)],
        F.explode(F.when(first <= last, F.sequence(first, last))).alias("i"))
    z = (g0 + F.col("i") * step - F.col("middle")) / h
    terms = [p * F.col(f"m{k}") / math.factorial(k) for k, p in enumerate(_hermite(z, KDE_TERMS))]
    sums = (reached.withColumn("part", F.exp(-0.5 * z * z) * sum(terms[1:], terms[0]))
            .groupBy("class", F.col("i").cast("long").alias("i")).agg(F.sum("part").alias("part")))
    points = st.select("class", "n", "h", "g0", "step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid - 1).cast("long"))).alias("i"))
    return (points.join(sums, ["class", "i"], "left")
            .select("class", "i", (g0 + F.col("i") * step).alias("x"),
                    (F.coalesce("part", F.lit(0.0)) / (F.col("n") * h * math.sqrt(2 * math.pi))).alias("density")))


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pairwise Pearson (pairwise-complete rows), one pass, long form a <= b."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{k}")
                   for k, (a, b) in enumerate(pairs)])
    items = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{k}").alias("corr"))
                      for k, (a, b) in enumerate(pairs)])
    return one.select(F.explode(items).alias("_it")).select("_it.*")


def anova_f(df: DataFrame, features: Sequence[str], class_col: str) -> DataFrame:
    """One-way ANOVA F per feature across classes (per-class count, mean, variance)."""
    long_df = to_long(df, features, class_col)
    per = long_df.groupBy("feature", "class").agg(
        F.count("value").alias("n"), F.avg("value").alias("m"), F.var_samp("value").alias("v"),
        F.sum("value").alias("s"))
    w = Window.partitionBy("feature")
    per = per.withColumn("gm", F.sum("s").over(w) / F.sum("n").over(w))
    agg = per.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"),
        F.sum(F.col("n") * (F.col("m") - F.col("gm")) * (F.col("m") - F.col("gm"))).alias("ssb"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("v"), F.lit(0.0))).alias("ssw"))
    return agg.select("feature", (F.col("k") - 1).alias("df_between"),
                      (F.col("n_total") - F.col("k")).alias("df_within"),
                      F.try_divide(F.col("ssb") / (F.col("k") - 1),
                                   F.col("ssw") / (F.col("n_total") - F.col("k"))).alias("f_stat"))


def kruskal_h(df: DataFrame, features: Sequence[str], class_col: str) -> DataFrame:
    """Tie-corrected Kruskal-Wallis H per feature.

    Average ranks come from running counts over each feature's distinct values,
    computed by :func:`prefix.running_sum` (range-partitioned, so a feature's
    values are spread over many tasks instead of one window).
    """
    long_df = to_long(df, features, class_col)
    counts = long_df.groupBy("feature", "value", "class").agg(F.count(F.lit(1)).alias("n"))
    vt = counts.groupBy("feature", "value").agg(F.sum("n").alias("t"))
    vt = running_sum(vt, ["feature"], "value", "t", out="before")
    ranks = vt.select("feature", "value", "t", (F.col("before") + (F.col("t") + 1) / 2.0).alias("avg_rank"))
    ties = ranks.groupBy("feature").agg(
        F.sum(F.col("t").cast("double") ** 3 - F.col("t")).alias("tie_sum"), F.sum("t").alias("big_n"))
    rs = counts.join(ranks.select("feature", "value", "avg_rank"), ["feature", "value"]).groupBy(
        "feature", "class").agg(F.sum(F.col("n") * F.col("avg_rank")).alias("r"), F.sum("n").alias("nc"))
    per = rs.groupBy("feature").agg(F.sum(F.col("r") * F.col("r") / F.col("nc")).alias("s"),
                                    F.count(F.lit(1)).alias("k"))
    j = per.join(ties, "feature")
    n = F.col("big_n").cast("double")
    h = 12.0 / (n * (n + 1)) * F.col("s") - 3 * (n + 1)
    corr = 1 - F.col("tie_sum") / (n * n * n - n)
    return j.select("feature", (F.col("k") - 1).alias("df"), F.try_divide(h, corr).alias("h_stat"))


# --------------------------------------------------------------- p-value tails
# scipy is not available; the tails below are the standard continued-fraction /
# series forms of the regularised incomplete beta and gamma functions.  They run
# on one row per feature (a Pandas UDF over a tiny table).

def _betacf(a: float, b: float, x: float) -> float:
    tiny, qab, qap, qam = 1e-300, a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            return h
    return math.nan  # not converged


def _lgamma_rise(a: float, b: float) -> float:
    """lgamma(a + b) - lgamma(a); by Stirling's series where a is large, as the
    difference of two large values has no digits left there."""
    if a < 1000:
        return math.lgamma(a + b) - math.lgamma(a)
    tail = lambda x: 1 / (12 * x) - 1 / (360 * x**3)
    return (a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b + tail(a + b) - tail(a)


def betainc_reg(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularised incomplete beta I_x(a, b); ``y`` is 1 - x where the caller has
    it with more digits.  NaN if the fraction does not converge."""
    y = 1 - x if y is None else y
    if x <= 0 or y >= 1:
        return 0.0
    if y <= 0:
        return 1.0
    log_x = math.log1p(-y) if y < 0.5 else math.log(x)
    log_y = math.log1p(-x) if x < 0.5 else math.log(y)
    rise = _lgamma_rise(a, b) - math.lgamma(b) if a >= b else _lgamma_rise(b, a) - math.lgamma(a)
    front = math.exp(rise + a * log_x + b * log_y)
    if y > (b + 1) / (a + b + 2):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, y) / b


LARGE_DF = 1e6  # from here on the F tail is the chi-square tail with its 1/d2 term


def f_sf(f: float, d1: float, d2: float) -> float:
    """Survival function of the F distribution.

    Above ``LARGE_DF`` the denominator's chi-square / d2 is 1 with variance
    2 / d2, so the tail is Q(b, u) plus half its second derivative times that
    variance, with b = d1 / 2 and u = b f; what is left out falls as 1 / d2^2."""
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    if d2 > LARGE_DF and d1 < d2 / 1000:
        b, u = d1 / 2.0, d1 * f / 2.0
        bend = math.exp(b * math.log(u) - u - math.lgamma(b)) * (u - b + 1)
        return min(1.0, max(0.0, gammaincc_reg(b, u) + bend / d2))
    return betainc_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f))


def gammaincc_reg(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    lg = math.lgamma(a)
    if x < a + 1:
        term = total = 1.0 / a
        ap = a
        for _ in range(1000):
            ap += 1
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-16:
                return 1.0 - total * math.exp(-x + a * math.log(x) - lg)
        return math.nan  # not converged
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        de = d * c
        h *= de
        if abs(de - 1) < 1e-15:
            return math.exp(-x + a * math.log(x) - lg) * h
    return math.nan  # not converged


def chi2_sf(x: float, k: float) -> float:
    if x is None or math.isnan(x) or k <= 0:
        return float("nan")
    return gammaincc_reg(k / 2.0, x / 2.0)


@F.pandas_udf(T.DoubleType())
def f_pvalue(f, d1, d2):
    import pandas as pd
    return pd.Series([f_sf(a, b, c) if a == a and a is not None else float("nan")
                      for a, b, c in zip(f, d1, d2)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(x, k):
    import pandas as pd
    return pd.Series([chi2_sf(a, b) if a == a and a is not None else float("nan")
                      for a, b in zip(x, k)], dtype="float64")


def with_pvalues(anova: DataFrame | None = None, kruskal: DataFrame | None = None) -> DataFrame:
    """p-values for the ANOVA F and Kruskal H tables (one row per feature)."""
    if anova is not None:
        return anova.withColumn("p_value", f_pvalue("f_stat", F.col("df_between").cast("double"),
                                                    F.col("df_within").cast("double")))
    return kruskal.withColumn("p_value", chi2_pvalue("h_stat", F.col("df").cast("double")))
