"""Splits and samples."""

from pyspark.sql import functions as F

from tests.conftest import SF001
from wakeline.operators import splits as S
from wakeline.plans.catalog import weekly


def test_geographic_overlap_goes_to_both(spark):
    df = spark.createDataFrame([(1, 55.0, 9.0), (2, 56.1, 9.0), (3, 60.0, 9.0)], "id long, lat_mean double, lon_mean double")
    out = S.split_geographic(df, (55.0, 56.2, 8.0, 10.0), (56.0, 58.0, 8.0, 10.0))
    got = sorted((r.id, r.split) for r in out.collect())
    assert got == [(1, "train"), (2, "test"), (2, "train")]


def test_random_split_is_stratified_disjoint_and_stable(spark):
    w = weekly(spark, SF001).select("imo", "week_start", "ship_type")
    a = S.split_random(w, "ship_type", ["imo", "week_start"])
    b = S.split_random(w.repartition(5), "ship_type", ["imo", "week_start"])
    assert a.count() == w.count() and a.columns == w.columns + ["split"]
    assert a.exceptAll(b).count() == 0
    per = {(r.ship_type, r.split): r["count"] for r in a.groupBy("ship_type", "split").count().collect()}
    n = {r.ship_type: r["count"] for r in w.groupBy("ship_type").count().collect()}
    for c, nc in n.items():
        assert per.get((c, "test"), 0) == round(nc * 0.2)


def test_compositional_split_balances_train(spark):
    w = weekly(spark, SF001).select("imo", "week_start", "ship_type")
    out = S.split_compositional(w, "ship_type", ["imo", "week_start"])
    assert out.columns == w.columns + ["split"]
    train = [r["count"] for r in out.where(F.col("split") == "train").groupBy("ship_type").count().collect()]
    assert len(set(train)) == 1


def test_compositional_split_single_row_class(spark):
    rows = [(i, "Cargo") for i in range(10)] + [(100, "Tanker")]
    df = spark.createDataFrame(rows, "id long, ship_type string")
    out = S.split_compositional(df, "ship_type", ["id"], classes=["Cargo", "Tanker"])
    counts = {(r.ship_type, r.split): r["count"] for r in out.groupBy("ship_type", "split").count().collect()}
    assert counts.get(("Cargo", "train")) == counts.get(("Tanker", "train")) == 1


def test_sample_caps_each_class(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(100)], "id long, c string")
    out = S.sample_stratified(df, "c", ["id"], per_class=10)
    assert out.columns == df.columns
    assert sorted(r["count"] for r in out.groupBy("c").count().collect()) == [10, 10]
    frac = S.sample_stratified(df, "c", ["id"], per_class=None, fraction=0.5)
    assert frac.count() == round(66 * 0.5) + round(34 * 0.5)
