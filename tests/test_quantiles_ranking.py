"""The multi-level exact quantile and first-k paths, forced with tiny limits,
checked against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wakeline.functions import hash_order
from wakeline.operators.quantiles import by_counts, exact_quantiles
from wakeline.operators.ranking import rank_below


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = [("g1", rnd.gauss(0, 1)) for _ in range(n)]
    rows += [("g2", float(rnd.randint(0, 30))) for _ in range(n // 3)]
    rows += [("g3", 5.0)] * 50 + [("g4", 1.5)]
    rows += [("g5", 1e6 * rnd.random() ** 8) for _ in range(n // 2)]
    return spark.createDataFrame(rows, "g string, v double"), rows


@pytest.mark.parametrize("limit", [40, 10_000_000])
def test_exact_quantiles_linear_matches_numpy(spark, limit):
    df, rows = _data(spark)
    probs = {f"q{i}": i / 10 for i in range(1, 10)}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, method="linear", exact_limit=limit,
                                           n_buckets=8).collect()}
    for g in ["g1", "g2", "g3", "g4", "g5"]:
        vals = np.array([v for k, v in rows if k == g])
        want = np.quantile(vals, [i / 10 for i in range(1, 10)])
        assert [got[g][f"q{i}"] for i in range(1, 10)] == pytest.approx(list(want), rel=1e-12, abs=1e-12)
        assert got[g].n == len(vals)


def test_exact_quantiles_nearest_matches_rule(spark):
    df, rows = _data(spark, n=600)
    got = {r.g: r.med for r in exact_quantiles(df, ["g"], "v", {"med": 0.5}, method="nearest",
                                                exact_limit=30, n_buckets=4).collect()}
    for g in ["g1", "g2", "g5"]:
        vals = sorted(v for k, v in rows if k == g)
        assert got[g] == vals[int(np.floor((len(vals) - 1) * 0.5 + 0.5))]


def test_by_counts_ignores_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("a", 2.0), ("a", 4.0)], "g string, v double")
    r = by_counts(df, ["g"], "v", {"m": 0.5}, method="nearest").first()
    assert r.n == 4 and r.m == 3.0


@pytest.mark.parametrize("limit", [5, 1_000_000])
def test_rank_below_matches_row_number(spark, limit):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", "b", "b", "c"]), i) for i in range(2500)]
    df = spark.createDataFrame(rows, "g string, id long").withColumn("h", hash_order(["id"], 42))
    cuts = spark.createDataFrame([("a", "t", 17), ("b", "t", 700), ("c", "t", 10_000), ("b", "u", 1)],
                                 "g string, name string, k long")
    got = rank_below(df, ["g"], "h", ["id"], cuts, window_limit=limit)
    w = Window.partitionBy("g").orderBy("h", "id")
    want = df.withColumn("rn", F.row_number().over(w)).select(
        "id", (F.col("rn") <= F.when(F.col("g") == "a", 17).when(F.col("g") == "b", 700).otherwise(10_000))
        .alias("t"), ((F.col("g") == "b") & (F.col("rn") <= 1)).alias("u"))
    joined = got.join(want, "id")
    assert joined.count() == 2500
    assert joined.where((F.col("below_t") != F.col("t")) | (F.col("below_u") != F.col("u"))).count() == 0


def test_running_sum_matches_window(spark):
    from wakeline.operators.prefix import running_sum
    rnd = random.Random(11)
    rows = [("a" if rnd.random() < 0.8 else "b", float(v), rnd.randint(1, 5)) for v in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double, t long")
    got = running_sum(df, ["g"], "v", "t", out="before", partitions=7)
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("want", F.coalesce(F.sum("t").over(w), F.lit(0)))
    j = got.join(want, ["g", "v"])
    assert j.count() == 3000 and j.where(F.col("before") != F.col("want")).count() == 0


@pytest.mark.parametrize("limit", [0, 1, 7, 2_000_000])
def test_cutoffs_past_small_and_null_groups_survive_refinement(spark, limit):
    rows = [("small" if i < 5 else None if i < 20 else "large", i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i long").withColumn("h", F.md5(F.col("i").cast("string")))
    cutoffs = df.select("g").distinct().select("g", F.lit("top").alias("name"), F.lit(15).alias("k"))
    got = {r["i"] for r in rank_below(df, ["g"], "h", ["i"], cutoffs, window_limit=limit).where("below_top").collect()}
    rank = F.row_number().over(Window.partitionBy("g").orderBy("h", "i"))
    assert got == {r["i"] for r in df.withColumn("r", rank).where("r <= 15").collect()}


def test_track_order_counts_earlier_rows_with_ties(spark):
    from wakeline.operators.stats import track_order
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 1), (2, 5), (1, 2)], "imo long, ts long")
    assert sorted(tuple(r) for r in track_order(df, "imo").collect()) == [(1, 1, 2, 0), (1, 2, 1, 2), (1, 3, 1, 3), (2, 5, 1, 0)]
