"""Helpers that the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.drift import broadcast_if_small
from ..session import materialize

#: ASCII white space, as a Java regular expression.
SPACE = r"[\x20\x09-\x0D]+"
#: The column that holds a whole input row while an operator works on it, so
#: that no column of the input can clash with one that the operator adds.
ROW = "_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame) -> DataFrame:
    """Each row as one struct column."""
    return df.select(F.struct("*").alias(ROW))


def field(name: str) -> Column:
    """A column of the packed row."""
    return F.col(ROW)[name]


def unpacked(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def words(text: Column) -> Column:
    """Maximal runs without ASCII white space, in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def hash_sample(df: DataFrame, bound: int, *key: str) -> DataFrame:
    """About ``bound`` rows, or all if there are no more: those whose key's hash
    lies below the share.  Each task passes on its share only, and the same rows
    come out however the table is cut up."""
    n = df.count()
    if n <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(*key), F.lit(1 << 40)) < int(bound / n * (1 << 40)))


def range_sorted(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` dealt into ranges of (group, order) and stored, with the range
    number in ``_pid``.  Spark samples the keys, so a group with a third of the
    rows is spread over many ranges.  Stored once: a second run of the plan
    could draw other bounds."""
    return materialize(df.repartitionByRange(*group, *order).withColumn("_pid", F.spark_partition_id()), name)


def prefix_sum(ranged: DataFrame, group: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in its group.

    ``ranged`` comes from ``range_sorted``.  A sum inside each range plus an
    offset for the ranges before it; only groups that lie in several ranges
    have one, at most twice as many rows as there are ranges.  They are counted
    and broadcast if few, else joined by a shuffle.  Groups with a null key are
    groups like others."""
    valued = ranged.withColumn("_value", value)
    totals = valued.groupBy("_pid", *group).agg(F.sum("_value").alias("_total"))
    each = Window.partitionBy(*group)
    offsets = (totals.withColumn("_spans", F.count("*").over(each))
               .where("_spans > 1")
               .withColumn("_offset", F.sum("_total").over(each.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
               .select(F.col("_pid").alias("_opid"), *[F.col(g).alias(f"_o{g}") for g in group], "_offset"))
    local = Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_pid") == F.col("_opid")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_o{g}"))
    zero = F.lit(0)
    return (valued.withColumn("_local", F.coalesce(F.sum("_value").over(local), zero))
            .join(broadcast_if_small(offsets), same, "left")
            .withColumn(out, F.col("_local") + F.coalesce(F.col("_offset"), zero))
            .drop("_value", "_local", "_offset", "_opid", *[f"_o{g}" for g in group]))
