"""Train/test splits and samples.

Every split returns the input rows with a ``split`` column ("train" / "test")
instead of four frames.  Randomness is a hash order, ``md5(key | seed)``: the
same on every run and under any partitioning, and reproducible in SQL.
Per-class "first k in hash order" uses :func:`ranking.rank_below`, which never
puts a whole class into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RANDOM_SEED, SHIP_TYPES
from ..functions import hash_order
from .pings import in_box
from .ranking import rank_below


def _hashed(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    return df.withColumn("_order", hash_order(keys, seed))


def split_random(df: DataFrame, class_col: str, keys: Sequence[str], test_size: float = 0.2,
                 seed: int = RANDOM_SEED, stratify: bool = True) -> DataFrame:
    """Stratified random split; round-half-even(n_c * test_size) rows of
    each class go to test.  Without stratification the whole table is one group."""
    grp = class_col if stratify else None
    d = _hashed(df, keys, seed)
    if grp is None:
        d = d.withColumn("_all", F.lit(1))
        grp = "_all"
    cut = d.groupBy(grp).agg(F.count(F.lit(1)).alias("n")).select(
        grp, F.lit("test").alias("name"), F.bround(F.col("n") * test_size, 0).cast("long").alias("k"))
    flagged = rank_below(d, [grp], "_order", list(keys), cut)
    out = flagged.withColumn("split", F.when(F.col("below_test"), "test").otherwise("train"))
    return out.drop("_order", "below_test", *(["_all"] if grp == "_all" else []))


def split_temporal(df: DataFrame, date_col: str, cutoff) -> DataFrame:
    """H2: rows before the cutoff train, the rest test."""
    c = F.lit(cutoff).cast(df.schema[date_col].dataType)
    return df.withColumn("split", F.when(F.col(date_col) < c, "train").otherwise("test")) \
             .where(F.col(date_col).isNotNull())


def split_geographic(df: DataFrame, train_box, test_box, lat: str = "lat_mean",
                     lon: str = "lon_mean") -> DataFrame:
    """H3: inclusive boxes; a row in both boxes appears in both splits, a row in
    neither is dropped."""
    train = df.where(in_box(lat, lon, train_box)).withColumn("split", F.lit("train"))
    test = df.where(in_box(lat, lon, test_box)).withColumn("split", F.lit("test"))
    return train.unionByName(test)


def split_compositional(df: DataFrame, class_col: str, keys: Sequence[str], test_size: float = 0.2,
                        seed: int = RANDOM_SEED, classes: Sequence[str] = SHIP_TYPES) -> DataFrame:
    """H4: test keeps the natural class mix, train is class-balanced.

    N counts every row (other classes too); each listed class sends
    round-half-even(n_c / N * floor(N * test_size)) rows to test, and every class
    then gives the same number of train rows: the smallest remainder over the
    listed classes.
    """
    d = _hashed(df, keys, seed)
    total = F.lit(df.count())  # N, one scalar
    listed = d.where(F.col(class_col).isin(list(classes)))
    counts = listed.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))
    dom = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias(class_col))
    counts = dom.join(counts, class_col, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    n_test = F.floor(total * test_size)
    counts = counts.withColumn("t", F.bround(F.col("n") / total * n_test, 0).cast("long"))
    m = counts.agg(F.min(F.col("n") - F.col("t")).alias("m")).first()["m"]  # one scalar
    m = int(max(m or 0, 0))
    cut = counts.select(class_col, F.lit("test").alias("name"), F.col("t").alias("k")).unionByName(
        counts.select(class_col, F.lit("end").alias("name"), (F.col("t") + m).alias("k")))
    flagged = rank_below(listed, [class_col], "_order", list(keys), cut)
    out = flagged.withColumn("split", F.when(F.col("below_test"), "test")
                             .when(F.col("below_end"), "train"))
    return out.where(F.col("split").isNotNull()).drop("_order", "below_test", "below_end")


def split_months(df: DataFrame, date_col: str, train_months: Sequence[int], test_month: int) -> DataFrame:
    """H5: months of the date column in a list (train) or equal to one (test)."""
    mo = F.month(date_col)
    return df.withColumn("split", F.when(mo.isin(list(train_months)), "train")
                         .when(mo == test_month, "test")).where(F.col("split").isNotNull())


def split_region(df: DataFrame, train_region: str, test_region: str, region_col: str = "region") -> DataFrame:
    """H6: equality on a caller-supplied region column."""
    r = F.col(region_col)
    return df.withColumn("split", F.when(r == train_region, "train").when(r == test_region, "test")) \
             .where(F.col("split").isNotNull())


def sample_stratified(df: DataFrame, class_col: str, keys: Sequence[str], per_class: int | None = 200,
                      fraction: float | None = None, seed: int = RANDOM_SEED) -> DataFrame:
    """min(n_c, per_class) rows per class (or round-half-even(n_c * fraction))."""
    d = _hashed(df, keys, seed)
    counts = d.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))
    k = (F.least(F.col("n"), F.lit(per_class)) if fraction is None
         else F.bround(F.col("n") * fraction, 0))
    cut = counts.select(class_col, F.lit("keep").alias("name"), k.cast("long").alias("k"))
    flagged = rank_below(d, [class_col], "_order", list(keys), cut)
    return flagged.where(F.col("below_keep")).drop("_order", "below_keep")


def class_slice(df: DataFrame, class_col: str, keys: Sequence[str], start: int, stop: int,
                seed: int = RANDOM_SEED) -> DataFrame:
    """Rows ranked [start, stop) inside each class in hash order."""
    d = _hashed(df, keys, seed)
    counts = d.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))
    cut = counts.select(class_col, F.lit("lo").alias("name"), F.lit(start).cast("long").alias("k")).unionByName(
        counts.select(class_col, F.lit("hi").alias("name"), F.lit(stop).cast("long").alias("k")))
    flagged = rank_below(d, [class_col], "_order", list(keys), cut)
    return flagged.where(F.col("below_hi") & ~F.col("below_lo")).drop("_order", "below_lo", "below_hi")
