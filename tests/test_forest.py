"""Large forests, grown by tasks: the same trees as spark.ml where nothing is drawn, jobs, bins, stored forms."""

import json

import pytest

from wakeline.operators import forest as G
from wakeline.operators import model as M


def _rows(spark, n=300, parts=3):
    return spark.range(n).selectExpr(
        "if(id % 7 = 0, null, id * id % 23) AS a", "cast(id * 37 % 91 as double) AS b", "7 AS c", "id",
        "if(id * id % 23 < 6 + id % 5, 'x', if(id * 37 % 91 < 40, 'y', 'z')) AS label").repartition(parts, "id")


def _probabilities(model, rows, features):
    out = M.predict_proba(model, rows, features).select("id", "prediction", "probabilities").collect()
    return {r.id: (r.prediction, r.probabilities) for r in out}


def _trees(model):
    stages = [p.stages[3] for p in (model.load() if isinstance(model, M.ForestParts) else [model])]
    return [t.toDebugString.split("\n", 1)[1] for s in stages for t in s.trees]


@pytest.mark.parametrize("local", [500_000, 60])         # all in one task; nodes of over 60 rows split over the partitions
def test_grown_by_tasks_as_by_spark_ml(spark, monkeypatch, local):
    rows, params = _rows(spark), {"num_trees": 2, "max_depth": 4, "bootstrap": False, "min_leaf": 5}
    one = M.train_forest(rows, ["a"], "label", **params)           # two slots: both are drawn at every node
    monkeypatch.setattr(M, "FIT_BOUND", 0)
    monkeypatch.setattr(G, "LOCAL_ROWS", local)
    many = M.train_forest(rows, ["a"], "label", **params)
    assert (many.tops[0].feature[0] >= 0) == (local == 60)
    assert _trees(many) == _trees(one) and len(_trees(one)) == 2
    a, b = (_probabilities(m, rows, ["a"]) for m in (one, many))
    assert len(a) == 300 and {k: v[0] for k, v in a.items()} == {k: v[0] for k, v in b.items()}
    assert all(b[k][1] == pytest.approx(v[1]) for k, v in a.items())
    was, now = ({r.feature: r.importance for r in M.impurity_importance(m).collect()} for m in (one, many))
    assert now == pytest.approx(was)


def test_top_nodes_over_partitions(spark, monkeypatch):
    monkeypatch.setattr(M, "FIT_BOUND", 100)
    monkeypatch.setattr(M, "PART_BOUND", 700)
    monkeypatch.setattr(G, "LOCAL_ROWS", 50)
    monkeypatch.setattr(G, "PASS_NODES", 8)
    rows, features = _rows(spark), ["a", "b", "c"]
    m = M.train_forest(rows, features, "label", num_trees=4, max_depth=7, seed=-5)
    assert sum(len(t.feature) > 3 for t in m.tops) >= 2       # a tree whose first draw is of constants only is one leaf
    parts = list(m.load())
    fits = [p.stages[3] for p in parts]
    assert [f.getNumTrees for f in fits] == [2, 2] and all(t.depth <= 7 for f in fits for t in f.trees)
    vectors = parts[0].stages[2].transform(parts[0].stages[1].transform(M.prepare(rows, features)))
    vector = {r.id: r["_features"] for r in vectors.select("id", "_features").collect()}
    for k, (said, probabilities) in _probabilities(m, rows, features).items():
        votes = [sum(f.predictRaw(vector[k])[i] for f in fits) / 4 for i in range(3)]
        assert [probabilities[x] for x in "xyz"] == pytest.approx(votes) and probabilities[said] == max(probabilities.values())
    each = [t.featureImportances.toArray() for f in fits for t in f.trees if t.depth > 0]
    values = {r.feature: r.importance for r in M.impurity_importance(m).collect()}
    assert [values[x] for x in m.columns] == pytest.approx([sum(e) / len(each) for e in zip(*each)])
    nodes = [x for x in G.node_rows(spark, 0, 4, m.tops, m.settings, f"{m.path}/trees")]
    assert len({x[0] for x in nodes}) == 4 and min(x[1][4] for x in nodes) >= 2
    by_id = {(t, x[0]): x for t, x in nodes}
    for (t, _), x in by_id.items():
        if x[6] >= 0:
            a, b = by_id[t, x[6]], by_id[t, x[7]]
            assert a[4] + b[4] == x[4] and (a[6] >= 0 or b[6] >= 0 or a[1] != b[1])     # siblings that say the same are merged


def test_jobs_do_not_grow_with_the_trees(spark, monkeypatch):
    monkeypatch.setattr(M, "FIT_BOUND", 100)
    monkeypatch.setattr(M, "PART_BOUND", 60)
    rows, jobs = _rows(spark, 60), []
    for trees in (2, 12):
        spark.sparkContext.setJobGroup(f"forest-{trees}", "")
        m = M.train_forest(rows, ["a", "b"], "label", num_trees=trees, max_depth=3)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"forest-{trees}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(m.tops) == 12 and M.predict(m, rows, ["a", "b"]).count() == 60
    assert jobs[1] == pytest.approx(jobs[0], abs=3)


def test_importances_without_loading_the_trees(spark, monkeypatch):
    monkeypatch.setattr(M, "FIT_BOUND", 100)
    m = M.train_forest(_rows(spark, 60), ["a", "b", "c"], "label", num_trees=5, max_depth=4)
    want = {r.feature: r.importance for r in M.impurity_importance(m).collect()}
    each = [t.featureImportances.toArray() for p in m.load() for t in p.stages[3].trees if t.depth > 0]
    assert [want[x] for x in m.columns] == pytest.approx([sum(e) / len(each) for e in zip(*each)])
    monkeypatch.setattr(M.ForestParts, "load", None)
    assert {r.feature: r.importance for r in M.impurity_importance(m).collect()} == want


def test_forest_without_a_split(spark, monkeypatch):
    monkeypatch.setattr(M, "FIT_BOUND", 10)
    m = M.train_forest(_rows(spark, 40), ["c"], "label", num_trees=3)
    out = _probabilities(m, _rows(spark, 40), ["c"])
    assert len(out) == 40 and len({v[0] for v in out.values()}) == 1
    assert all(r.importance == 0 for r in M.impurity_importance(m).collect())
    assert M.predict(m, _rows(spark, 40).limit(0), ["c"]).count() == 0


def test_split_points(spark):
    rows = spark.range(2000).selectExpr("cast(id % 5 * 10 as double) AS few", "cast(if(id < 1200, 50, id % 101) as double) AS heavy",
                                        "cast(id as double) AS even", "1.0D AS flat", "if(id < 1000, 3.0D, 1.0D) AS w").repartition(4)
    few, heavy, even, flat = G.split_points(rows, ["few", "heavy", "even", "flat"], "w", 8)
    assert few == [5, 15, 25, 35] and flat == []
    assert 49.5 in heavy and 50.5 in heavy and len(heavy) <= 7     # the value with most of the weight has a bin of its own
    assert len(even) == 7 and all(e == pytest.approx(w, abs=2) for e, w in zip(even, [500 / 3, 1000 / 3, 500, 2000 / 3, 2500 / 3, 1000, 1500]))
    assert G.split_points(rows.repartition(7, "even"), ["few", "heavy", "even", "flat"], "w", 8) == [few, heavy, even, flat]


def test_forest_stored_by_an_earlier_version(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(M, "FIT_BOUND", 100)
    monkeypatch.setattr(M, "PART_BOUND", 120)
    rows, features = _rows(spark, 60), ["a", "b"]
    m = M.train_forest(rows, features, "label", num_trees=3, max_depth=4)
    for i, part in enumerate(m.load()):
        part.write().save(f"{tmp_path}/old/model/{i:05d}")
    about = json.dumps({"columns": features, "parts": 2, "labels": ["x", "y", "z"]})
    spark.createDataFrame([(about,)], "schema string").coalesce(1).write.text(f"{tmp_path}/old/features")
    old = M.load_model(f"{tmp_path}/old", features)
    M.save_model(old, f"{tmp_path}/copy", features)
    now = _probabilities(m, rows, features)
    for k, v in _probabilities(M.load_model(f"{tmp_path}/copy", features), rows, features).items():
        assert v[1] == pytest.approx(now[k][1])
    a, b = ({r.feature: r.importance for r in M.impurity_importance(x).collect()} for x in (old, m))
    assert a == pytest.approx(b)
    assert M.model_labels(old) == ["x", "y", "z"] and M.model_features(old) == features


def test_bootstrap_and_draws():
    import numpy as np
    how = G.Settings([[]] * 10, [1.0], 2, 4, 3, 1, -7, True)
    bags = [G._bag(np.arange(200_000), t, how) for t in (0, 1)]
    assert all(b.mean() == pytest.approx(1, abs=0.01) and b.var() == pytest.approx(1, abs=0.02) for b in bags)
    assert abs(np.corrcoef(*bags)[0, 1]) < 0.01
    drawn = G._draw(G._rng(how, 1, 0), 50_000, 10, 4)
    assert all(len(set(r)) == 4 for r in drawn[:500].tolist())
    assert np.bincount(drawn.ravel(), minlength=10) / 50_000 == pytest.approx(0.4, abs=0.02)
