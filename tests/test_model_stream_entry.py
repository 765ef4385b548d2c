"""Model contract, stream = batch over closed weeks, driver entry points."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from wakeline.operators import model as M


def _tiny(spark, cols=("f1", "f2")):
    return spark.createDataFrame([(1, 2, "A"), (3, 4, "B"), (5, 6, "A"), (7, 8, "B")],
                                 f"{cols[0]} long, {cols[1]} long, label string")


def test_tiny_model_trains_predicts_with_probabilities(spark):
    m = M.train_forest(_tiny(spark), ["f1", "f2"], "label", num_trees=2, max_depth=3, min_leaf=1, seed=0)
    out = M.predict_proba(m, _tiny(spark), ["f1", "f2"]).collect()
    assert len(out) == 4 and all(r.prediction in ("A", "B") for r in out)
    assert all(sum(r.probabilities.values()) == pytest.approx(1.0) for r in out)


def test_model_schema_contract(spark, tmp_path):
    m = M.train_forest(_tiny(spark), ["f1", "f2"], "label", num_trees=2, max_depth=3, min_leaf=1)
    M.save_model(m, str(tmp_path / "run"), ["f1", "f2"])
    loaded = M.load_model(str(tmp_path / "run"), ["f1", "f2"])
    assert M.model_features(loaded) == ["f1", "f2"]
    with pytest.raises(ValueError, match="other features"):
        M.load_model(str(tmp_path / "run"), ["f1", "different_column"])
    with pytest.raises(FileNotFoundError):
        M.load_model(str(tmp_path / "nothing"))


def test_large_forest_is_grown_in_stored_parts(spark, tmp_path, monkeypatch):
    rows = spark.range(60).selectExpr("if(id % 7 = 0, null, id % 10) AS a", "cast(id * 37 % 11 as double) AS b", "7 AS c",
                                      "if(id % 10 < 4, 'x', if(id % 10 < 8, 'y', 'z')) AS label").repartition(3, "b")
    features, names = ["a", "b", "c"], ["x", "y", "z"]
    monkeypatch.setattr(M, "FIT_BOUND", 200)
    monkeypatch.setattr(M, "PART_BOUND", 120)        # two trees of 60 rows at a time
    m = M.train_forest(rows, features, "label", num_trees=5, max_depth=5, seed=3)
    parts = list(m.load())
    fits = [p.stages[3] for p in parts]
    assert [f.getNumTrees for f in fits] == [2, 2, 1]
    assert M.model_labels(m) == names and M.model_features(m) == features
    out = M.predict_proba(m, rows, features)
    assert out.columns == ["a", "b", "c", "label", "prediction", "probabilities"] and out.count() == 60
    vectors = parts[0].stages[2].transform(parts[0].stages[1].transform(M.prepare(rows, features)))
    vector = {(r.a, r.b): r["_features"] for r in vectors.select("a", "b", "_features").collect()}
    good = 0
    for i, r in enumerate(out.orderBy("a", "b").collect()):
        if i % 10 == 0:                              # the votes of all five trees, added up here
            votes = [sum(f.predictRaw(vector[r.a, r.b])[k] for f in fits) for k in range(3)]
            assert [r.probabilities[n] for n in names] == pytest.approx([v / 5 for v in votes])
        assert r.probabilities[r.prediction] == max(r.probabilities.values()) and sum(r.probabilities.values()) == pytest.approx(1)
        good += r.prediction == r.label
    assert good > 30
    values = {r.feature: r.importance for r in M.impurity_importance(m).collect()}
    each = [t.featureImportances.toArray() for f in fits for t in f.trees if t.depth > 0]
    assert list(values.values()) == pytest.approx(sorted((sum(e) / len(each) for e in zip(*each)), reverse=True))
    assert values["c__imp"] == 0 and sum(values.values()) == pytest.approx(1)
    M.save_model(m, str(tmp_path / "run"), features)
    again = M.predict_proba(M.load_model(str(tmp_path / "run"), features), rows, features)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_permutation_importance_of_a_rule(spark):
    df = spark.range(40).selectExpr("id", "cast(id % 2 as double) AS a", "cast(id % 3 as double) AS b",
                                    "if(id % 2 = 0, 'x', 'y') AS label")
    rule = F.expr("if(a = 0, 'x', 'y')")
    out = {r.feature: r for r in M.permutation_importance(lambda d: d.withColumn("prediction", rule), df,
                                                          ["a", "b"], "label", ["id"], repeats=3).collect()}
    assert out["b"].importance_mean == 0 and 0 < out["a"].importance_mean <= 1


def test_report_of_nulls_and_of_no_rows(spark):
    from wakeline.operators import evaluation as EV
    df = spark.createDataFrame([("A", "A"), ("A", None), (None, None)], "label string, prediction string")
    rows = {r["class"]: r for r in EV.classification_report(df).collect()}
    assert set(rows) == {"A", None, "macro avg", "weighted avg", "accuracy"}
    assert (rows["A"].recall, rows[None].precision, rows[None].support) == (0.5, 0.5, 1)
    assert rows["accuracy"].f1 == pytest.approx(2 / 3) and rows["accuracy"].support == 3
    assert EV.classification_report(df.limit(0)).count() == 0


def test_stream_equals_batch_over_closed_weeks(spark):
    from wakeline.plans.catalog import QUERIES, weekly
    stream = QUERIES["stream_weekly"](spark, SF001)
    batch = QUERIES["weekly_features"](spark, SF001)
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    watermark = ev.select(F.max("ts") - F.expr("INTERVAL 1 DAY")).first()[0]
    # a week is closed once its end (start + 7 days) is at or before the watermark
    batch = batch.where(F.date_add("week_start", 7).cast("timestamp_ntz") <= F.lit(watermark))
    assert stream.count() == batch.count() > 0
    assert stream.exceptAll(batch).count() == 0
    assert weekly(spark, SF001).count() >= batch.count()


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 55
    from wakeline.plans.catalog import QUERIES  # the text operators' queries are not in the library's own catalog
    bad = [n for n in QUERIES if n.startswith("op") or "pipeline" in n]
    assert not bad and set(QUERIES) <= set(qs)


def test_tune_for_input_sizes_partitions(spark):
    from wakeline.session import tune_for_input
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert tune_for_input(spark, 100 * (1 << 40), cores=8000) == 409600
        assert tune_for_input(spark, 1 << 20, cores=4) == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))


def test_ship_package(spark):
    from wakeline.session import ship_package
    path = ship_package(spark)
    assert path.endswith("wakeline.zip")


def test_selected_schema_written(spark, tmp_path):
    from wakeline.sources import sinks
    imp = spark.createDataFrame([("f1", 0.05, 0.01), ("f2", 0.0005, 0.0001), ("f3", 0.02, 0.03)],
                                "feature string, importance_mean double, importance_std double")
    data = spark.createDataFrame([(1.0, 2, 3.0)], "f1 double, f2 long, f3 double")
    chosen = M.write_selected_schema(imp, data, str(tmp_path / "schema"))
    assert chosen == ["f1"]
    assert sinks.load_schema(spark, str(tmp_path / "schema")) == {"columns": ["f1"], "dtypes": {"f1": "float64"}}


def test_stream_start_state_conf(spark):
    """RocksDB is used only when the session names no provider; the session's
    own settings are back in place after the start."""
    from wakeline.streaming.jobs import STATE_CONF, _start
    key = "spark.sql.streaming.stateStore.providerClass"
    seen = {}

    class Writer:
        def start(self):
            seen["provider"] = spark.conf.get(key, None)
            seen["partitions"] = spark.conf.get("spark.sql.shuffle.partitions")
            return "started"

    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.unset(key)
    assert _start(spark, Writer(), {"spark.sql.shuffle.partitions": "3"}) == "started"
    assert seen == {"provider": STATE_CONF[key], "partitions": "3"}
    assert spark.conf.get(key, None) is None
    assert spark.conf.get("spark.sql.shuffle.partitions") == parts

    mine = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, mine)
    try:
        _start(spark, Writer(), {})
        assert seen["provider"] == mine
    finally:
        spark.conf.unset(key)
