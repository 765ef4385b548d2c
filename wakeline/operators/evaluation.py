"""Classification metrics from (label, prediction) rows.

Everything starts from one ``groupBy(label, prediction).count()`` - a k x k
table - so the metrics cost one partial-aggregated scan whatever the size of
the scored data.  The report is one chain on top of it: counts per class, then
class rows and totals from one pair of grouping sets.  Undefined precision /
recall / F1 are 0, as in the usual classification report.  A null label or
prediction is a class of its own; no rows give an empty report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              by: list[str] | None = None) -> DataFrame:
    """Counts per (true, predicted) class."""
    by = by or []
    return df.groupBy(*by, F.col(label).cast("string").alias("label"),
                      F.col(prediction).cast("string").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _per_class(conf: DataFrame, by: list[str]) -> DataFrame:
    """Hits, support and predictions of each class, with precision, recall and F1."""
    n, zero = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("label").eqNullSafe(F.col("prediction")), n).otherwise(zero)
    sides = F.array(F.struct(F.col("label").alias("class"), hit.alias("tp"), n.alias("support"), zero.alias("predicted")),
                    F.struct(F.col("prediction").alias("class"), zero.alias("tp"), zero.alias("support"),
                             n.alias("predicted")))
    t = (conf.select(*by, F.explode(sides).alias("_s")).groupBy(*by, F.col("_s.class").alias("class"))
         .agg(*[F.sum(f"_s.{c}").alias(c) for c in ("tp", "support", "predicted")]))
    t = t.withColumns({"precision": _ratio(F.col("tp"), F.col("predicted")),
                       "recall": _ratio(F.col("tp"), F.col("support"))})
    return t.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def _report(conf: DataFrame, by: list[str]) -> DataFrame:
    measures = ("precision", "recall", "f1")
    sums = (_per_class(conf, by).groupingSets([[*by, "class"], by], *by, "class")
            .agg(F.grouping("class").alias("_total"), F.sum("support").alias("s"), F.sum("tp").alias("tp"),
                 *[F.avg(m).alias(m) for m in measures],
                 *[F.sum(F.col(m) * F.col("support")).alias(f"w_{m}") for m in measures]))

    def row(name: Column, *values: Column) -> Column:
        return F.struct(name.alias("class"), *[v.alias(m) for v, m in zip(values, measures)],
                        F.col("s").alias("support"))

    mean = [F.col(m) for m in measures]  # of one row for a class
    none = F.lit(None).cast("double")
    rows = F.when(F.col("_total") == 0, F.array(row(F.col("class"), *mean))).otherwise(F.array(
        row(F.lit("macro avg"), *mean),
        row(F.lit("weighted avg"), *[F.try_divide(F.col(f"w_{m}"), F.col("s")) for m in measures]),
        row(F.lit("accuracy"), none, none, F.try_divide(F.col("tp"), F.col("s")))))
    return sums.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.*")


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro / weighted
    averages and an accuracy row (its F1 column holds the accuracy)."""
    by = by or []
    return _report(confusion(df, label, prediction, by), by)


def summary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and macro F1 in one row."""
    rep = classification_report(df, label, prediction)
    return rep.where(F.col("class").isin("accuracy", "macro avg")).groupBy().agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "macro avg", F.col("f1"))).alias("f1_macro"),
        F.max("support").alias("n"))


def report_by_slice(df: DataFrame, ts: str, start, days: int = 30, label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    """The classification report for consecutive ``days``-long slices from
    ``start``, stopping before the first empty slice.

    The counts per slice are stored once; the search for the first empty slice
    and the report read that small table."""
    start_c = F.lit(start).cast("date") if not hasattr(start, "_jc") else start
    by = ["slice", "slice_start"]
    d = (df.withColumn("_start", start_c)
         .withColumn("slice", F.floor(F.datediff(F.to_date(ts), F.col("_start")) / days).cast("long"))
         .where(F.col("slice") >= 0)
         .withColumn("slice_start", F.date_add("_start", (F.col("slice") * days).cast("int"))))
    conf = confusion(d, label, prediction, by).transform(materialize)
    present = conf.select("slice").distinct()
    # first missing slice index: 0 if absent, else the smallest s + 1 not present
    gaps = present.select((F.col("slice") + 1).alias("slice")).join(present, "slice", "left_anti")
    has_zero = present.where(F.col("slice") == 0).select(F.count(F.lit(1))).scalar()
    first_gap = F.when(has_zero == 0, F.lit(0)).otherwise(gaps.select(F.min("slice")).scalar())
    return _report(conf.where(F.col("slice") < first_gap), by)
