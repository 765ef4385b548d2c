"""Random forest, scoring and feature importance on spark.ml.

* Missing values: Spark's forest rejects NaN, so features go through a median
  ``Imputer`` fitted on the training rows plus 0/1 missing-indicator columns.
* Balanced class weights ``N / (k * n_c)`` come from a per-class count (one row
  per class) joined back to the rows.
* Depth: "unlimited" is capped at 30, the largest depth spark.ml accepts.
* spark.ml keeps the nodes of a fit in the driver, about half as many as rows
  times trees.  A forest with more than ``FIT_BOUND`` of these is grown, stored
  and asked by tasks (``forest``), by the same rules.  ``ForestParts.load`` gives
  it as spark.ml models of some trees each (``PART_BOUND``).
* Permutation importance shifts the rows by one place in hash order, another
  order per repeat; places come from range-partitioned running counts, so no
  permutation needs one task.  One row per repeat is shuffled; the copies per
  feature are made after that, where they are scored.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Imputer, IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FOREST_MAX_DEPTH, FOREST_MIN_LEAF, FOREST_TREES, RANDOM_SEED
from ..functions import hash_order
from ..session import materialize, scratch_path
from ..sources.sinks import path_exists
from . import forest as G
from .drift import broadcast_if_small
from .prefix import running_sum

#: Training rows times trees of a forest grown by one fit, and of each spark.ml
#: model that a larger one is given as.
FIT_BOUND = 1_000_000
PART_BOUND = 500_000


class ForestParts(NamedTuple):
    """A forest grown by tasks: ``path`` holds its trees and the fitted stages before them."""
    path: str
    labels: list[str]
    features: list[str]
    per_part: int
    params: dict
    settings: G.Settings
    tops: list[G.Top]

    @property
    def columns(self) -> list[str]:
        return _slot_names(self.features)

    def load(self) -> Iterator[PipelineModel]:
        """One spark.ml model of ``per_part`` trees after the other; the driver need not keep any."""
        front = PipelineModel.load(f"{self.path}/front")
        for first in range(0, self.settings.trees, self.per_part):
            trees = _spark_forest(self, first, min(first + self.per_part, self.settings.trees))
            yield PipelineModel(stages=[*front.stages, trees, _class_names(self.labels)])


class StoredFits(NamedTuple):
    """A large forest as earlier versions stored it: several pipeline models with some of the trees each."""
    paths: list[str]
    labels: list[str]
    features: list[str]

    def load(self) -> Iterator[PipelineModel]:
        for path in self.paths:
            yield PipelineModel.load(path)


Forest = PipelineModel | ForestParts | StoredFits


def _imp(f: str) -> str:
    return f"{f}__imp"


def _miss(f: str) -> str:
    return f"{f}__missing"


def features_and_target(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The features in their order, then the target."""
    return df.select(*features, label)


def _slot_names(features: Sequence[str]) -> list[str]:
    """What the forest's vector is put together from."""
    return [_imp(f) for f in features] + [_miss(f) for f in features]


def prepare(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Cast features to DOUBLE and add missing indicators."""
    out = df
    for f in features:
        out = out.withColumn(f, F.col(f).cast("double")).withColumn(
            _miss(f), F.col(f).isNull().cast("double"))
    return out


def with_class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Balanced weights N / (k * n_c)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    total = counts.select(F.sum("_nc")).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    w = counts.select(label, (total / (k * F.col("_nc"))).alias(weight))
    return df.join(broadcast_if_small(w), label)


def forest_pipeline(features: Sequence[str], label: str, num_trees: int = FOREST_TREES,
                    max_depth: int = FOREST_MAX_DEPTH, min_leaf: int = FOREST_MIN_LEAF,
                    seed: int = RANDOM_SEED, node_memory_mb: int = 64, bootstrap: bool = True) -> Pipeline:
    """Indexer -> median imputer -> assembler -> weighted random forest.

    ``bootstrap=False`` grows every tree on all rows.

    ``node_memory_mb`` caps the statistics aggregated per pass over the data
    (spark.ml ``maxMemoryInMB``): deep trees are then grown in more, smaller
    passes instead of exhausting the heap.  Node ids are cached per row (and
    checkpointed every 10 levels) so deep trees do not re-ship every tree to the
    executors at each level."""
    features = list(features)
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="_label_idx", stringOrderType="alphabetAsc",
                      handleInvalid="keep"),
        Imputer(strategy="median", inputCols=features, outputCols=[_imp(f) for f in features]),
        VectorAssembler(inputCols=_slot_names(features), outputCol="_features", handleInvalid="keep"),
        RandomForestClassifier(featuresCol="_features", labelCol="_label_idx", weightCol="weight",
                               numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=min_leaf,
                               seed=seed, bootstrap=bootstrap, predictionCol="_pred_idx", probabilityCol="_proba",
                               rawPredictionCol="_raw", maxMemoryInMB=node_memory_mb,
                               cacheNodeIds=True, checkpointInterval=10),
    ])


def train_forest(df: DataFrame, features: Sequence[str], label: str, num_trees: int = FOREST_TREES,
                 seed: int = RANDOM_SEED, **params) -> Forest:
    """Fit on ``df``; the returned model maps predictions back to class names."""
    data = with_class_weights(prepare(df, features), label)
    n = data.count() if num_trees > 1 else 0
    if n * num_trees > FIT_BOUND:
        return _train_parts(data, n, list(features), label, num_trees, seed, params)
    fitted = forest_pipeline(features, label, num_trees=num_trees, seed=seed, **params).fit(data)
    return PipelineModel(stages=fitted.stages + [_class_names(fitted.stages[0].labels)])


def _class_names(labels: list[str]) -> IndexToString:
    return IndexToString(inputCol="_pred_idx", outputCol="prediction", labels=labels)


def _train_parts(data: DataFrame, n: int, features: list[str], label: str, num_trees: int, seed: int, params: dict) -> ForestParts:
    """Grown and stored by tasks.  Index, medians and bins are made once."""
    spark = data.sparkSession
    *front, grower = forest_pipeline(features, label, num_trees=num_trees, seed=seed, **params).getStages()
    front = Pipeline(stages=front).fit(data)
    index, medians, _ = front.stages
    columns = _slot_names(features)
    rows = medians.transform(index.transform(data)).select(
        *columns, "weight", F.col("_label_idx").cast("int").alias("_class"), F.monotonically_increasing_id().alias(G.ROW))
    rows = rows.transform(materialize, "vectors")
    weights = {r["_class"]: r["w"] for r in rows.groupBy("_class").agg(F.max("weight").alias("w")).collect()}    # one row per class
    how = G.Settings(G.split_points(rows, columns, "weight", grower.getMaxBins()), [weights.get(i, 0.0) for i in range(len(index.labels))],
                     num_trees, math.ceil(math.sqrt(len(columns))), grower.getMaxDepth(), grower.getMinInstancesPerNode(), seed, grower.getBootstrap())
    path = scratch_path(spark, f"forest/{uuid.uuid4().hex[:12]}")
    front.write().save(f"{path}/front")
    tops = G.grow_forest(rows, n, columns, how, f"{path}/trees")
    about = {p.name: v for p, v in grower.extractParamMap().items()}
    return ForestParts(path, list(index.labels), features, max(1, PART_BOUND // n), about, how, tops)


_NODE = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
         "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")


def _spark_forest(model: ForestParts, first: int, last: int) -> RandomForestClassificationModel:
    """The trees [first, last) as spark.ml's model, by way of its files."""
    spark, n = SparkSession.getActiveSession(), last - first
    path = scratch_path(spark, f"forest/{uuid.uuid4().hex[:12]}")
    size = {"numFeatures": len(model.columns), "numClasses": len(model.labels) + 1}

    def about(kind: str, but: Sequence[str], **more) -> str:
        params = {k: v for k, v in model.params.items() if k not in but}
        return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": 0, "sparkVersion": spark.version,
                           "uid": f"{kind}_{uuid.uuid4().hex[:12]}", "paramMap": params, "defaultParamMap": {}} | size | more)

    tree = about("DecisionTreeClassificationModel", ["numTrees", "subsamplingRate", "featureSubsetStrategy", "bootstrap"])
    whole = about("RandomForestClassificationModel", [], paramMap=model.params | {"numTrees": n}, numTrees=n)
    nodes = spark.createDataFrame(G.node_rows(spark, first, last, model.tops, model.settings, f"{model.path}/trees"), _NODE)
    nodes.write.parquet(f"{path}/data")
    spark.createDataFrame([(i, tree, 1.0) for i in range(n)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)


def model_labels(model: Forest) -> list[str]:
    return list(model.stages[0].labels if isinstance(model, PipelineModel) else model.labels)


def model_features(model: Forest) -> list[str]:
    if not isinstance(model, PipelineModel):
        return list(model.features)
    return [c[: -len("__imp")] for c in model.stages[1].getOutputCols()]


def _scored(model: Forest, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The rows with ``prediction`` and ``_share``, the trees' share for each class (and for unseen labels)."""
    rows = prepare(df, features)
    slots = _slot_names(features)
    used = ["_features", "_raw", "_proba", "_pred_idx", "_label_idx", *[_imp(f) for f in features]]
    if isinstance(model, PipelineModel):
        return model.transform(rows).withColumn("_share", vector_to_array("_proba")).drop(*used, *slots)
    if isinstance(model, StoredFits):
        # the votes are carried along with the rows: no key is needed to add them up
        rows = rows.withColumn("_votes", F.array(*[F.lit(0.0)] * (len(model.labels) + 1)))
        for part in model.load():
            votes = F.zip_with("_votes", vector_to_array("_raw"), lambda a, b: a + b)
            rows = part.transform(rows).withColumn("_votes", votes).drop(*used, "prediction").transform(materialize, "votes")
        return _by_votes(model, rows.drop(*slots))
    medians = PipelineModel.load(f"{model.path}/front").stages[1]
    # stored, so that a row keeps its number
    rows = medians.transform(rows).drop("prediction").withColumn(G.ROW, F.monotonically_increasing_id()).transform(materialize, "scored")
    asked = rows.select(G.ROW, *model.columns)
    votes = G.votes(asked, asked.count(), model.columns, model.tops, model.settings, f"{model.path}/trees")
    return _by_votes(model, rows.join(votes, G.ROW).drop(G.ROW, *slots))


def _by_votes(model: ForestParts | StoredFits, rows: DataFrame) -> DataFrame:
    total = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
    best = F.array_position("_votes", F.array_max("_votes")).cast("int")     # the first of equals, as in spark.ml
    return (rows.withColumn("prediction", F.get(F.array(*[F.lit(x) for x in model.labels]), best - 1))
            .withColumn("_share", F.transform("_votes", lambda x: x / total)).drop("_votes"))


def predict(model: Forest, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Batch prediction, ``prediction`` column with the class name."""
    return _scored(model, df, features).drop("_share")


def predict_proba(model: Forest, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """I4: prediction plus a class -> probability map."""
    names = model_labels(model)
    labels = F.array(*[F.lit(x) for x in names])
    # the label indexer keeps one extra slot for unseen labels: drop it
    probs = F.slice("_share", 1, len(names))
    return _scored(model, df, features).withColumn("probabilities", F.map_from_arrays(labels, probs)).drop("_share")


def save_model(model: Forest, path: str, features: Sequence[str]) -> None:
    """Model plus its ordered feature list, side by side under ``path``; a
    forest grown by tasks as its folder, with what else it needs in the list."""
    spark = SparkSession.getActiveSession()
    about = {"columns": list(features)}
    if isinstance(model, ForestParts):
        about["forest"] = model._asdict() | {"settings": model.settings._asdict(), "tops": [t._asdict() for t in model.tops]}
        PipelineModel.load(f"{model.path}/front").write().overwrite().save(f"{path}/model/front")
        spark.read.parquet(f"{model.path}/trees").write.mode("overwrite").parquet(f"{path}/model/trees")
    elif isinstance(model, StoredFits):
        about["parts"], about["labels"] = len(model.paths), model.labels
        for i, part in enumerate(model.load()):
            part.write().overwrite().save(f"{path}/model/{i:05d}")
    else:
        model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(about),)], "schema string") \
         .coalesce(1).write.mode("overwrite").text(f"{path}/features")


def load_model(path: str, expected_features: Sequence[str] | None = None) -> Forest:
    """Load; raise when the stored feature order differs from the expected one."""
    spark = SparkSession.getActiveSession()
    if not path_exists(spark, f"{path}/model"):
        raise FileNotFoundError(f"{path} holds no model; a training run writes one.")
    about = json.loads(spark.read.text(f"{path}/features").first()[0])
    stored = about["columns"]
    if expected_features is not None and list(stored) != list(expected_features):
        raise ValueError(f"This model takes other features, or in another order: it has {list(stored)}, "
                         f"asked for were {list(expected_features)}.")
    if "forest" in about:
        found = about["forest"] | {"path": f"{path}/model", "settings": G.Settings(**about["forest"]["settings"]),
                                   "tops": [G.Top(**t) for t in about["forest"]["tops"]]}
        return ForestParts(**found)
    if "parts" in about:
        return StoredFits([f"{path}/model/{i:05d}" for i in range(about["parts"])], about["labels"], list(stored))
    return PipelineModel.load(f"{path}/model")


def permutation_importance(score: Callable[[DataFrame], DataFrame], test: DataFrame, features: Sequence[str],
                           label: str, keys: Sequence[str], repeats: int = 10,
                           seed: int = RANDOM_SEED) -> DataFrame:
    """I8: mean and (population) std of the accuracy drop when one feature is shuffled.

    ``score`` adds the column ``prediction`` and keeps the others, for a forest
    ``lambda df: predict(model, df, features)``.  ``keys`` name a row.  Returns
    ``(feature, importance_mean, importance_std)``, largest first.
    """
    features, keys = list(features), list(keys)

    def share() -> Column:
        return F.avg((F.col(label) == F.col("prediction")).cast("double"))

    base_acc, n = score(test).agg(share()).first()[0], test.count()
    turn = F.explode(F.array(*[F.lit(r) for r in range(repeats)])).alias("_r")
    turns = test.select("*", turn).withColumn("_h", hash_order([*keys, "_r"], seed)).withColumn("_one", F.lit(1))
    ranked = running_sum(turns, ["_r"], "_h", "_one", out="_at").drop("_h", "_one")
    # the row after each one, the first after the last
    donors = ranked.select("_r", F.pmod(F.col("_at") - 1, F.lit(n)).alias("_at"),
                           F.struct(*[F.col(f).cast("double").alias(f) for f in features]).alias("_next"))
    copies = ranked.join(donors, ["_r", "_at"]).select("*", F.explode(F.array(*[F.lit(f) for f in features])).alias("_f"))
    shuffled = {f: F.when(F.col("_f") == f, F.col("_next")[f]).otherwise(F.col(f).cast("double")) for f in features}
    scored = score(copies.withColumns(shuffled).drop("_next", "_at"))
    drop = scored.groupBy("_f", "_r").agg((F.lit(base_acc) - share()).alias("d"))
    return (drop.groupBy(F.col("_f").alias("feature"))
            .agg(F.avg("d").alias("importance_mean"), F.stddev_pop("d").alias("importance_std"))
            .orderBy(F.desc("importance_mean")))


def select_features(importances: DataFrame, threshold: float = 0.001) -> DataFrame:
    """Keep features with mean > threshold and std < mean."""
    return importances.where((F.col("importance_mean") > threshold)
                             & (F.col("importance_std") < F.col("importance_mean")))


def write_selected_schema(importances: DataFrame, dataset: DataFrame, path: str,
                          threshold: float = 0.001) -> list[str]:
    """I9 + A11: write the selected features (most important first) and their
    types as the feature schema file; returns the list."""
    from ..sources import sinks
    chosen = [r["feature"] for r in select_features(importances, threshold)
              .orderBy(F.desc("importance_mean")).select("feature").collect()]  # one row per feature
    sinks.write_schema(dataset.sparkSession, path, sinks.schema_spec(dataset, chosen))
    return chosen


def impurity_importance(model: Forest) -> DataFrame:
    """Impurity importances of the fitted forest, one row per vector slot."""
    spark = SparkSession.getActiveSession()
    if not isinstance(model, PipelineModel):
        names, vals = _part_importances(model)
    else:
        names, vals = model.stages[2].getInputCols(), model.stages[3].featureImportances.toArray().tolist()  # one value per input column
    return spark.createDataFrame(list(zip(names, vals)), "feature string, importance double") \
                .orderBy(F.desc("importance"))


def _part_importances(model: ForestParts | StoredFits) -> tuple[list[str], list[float]]:
    """The mean over all trees that split anything."""
    if isinstance(model, ForestParts):
        each = G.tree_importances(SparkSession.getActiveSession(), model.tops, model.settings, f"{model.path}/trees")
        return model.columns, (each.sum(axis=0) / max(int((each.sum(axis=1) > 0).sum()), 1)).tolist()
    names, sums, trees = [], [], 0
    for part in model.load():                  # each part's values are the mean over its own trees
        names, forest = part.stages[2].getInputCols(), part.stages[3]
        n = sum(t.depth > 0 for t in forest.trees)
        vals = forest.featureImportances.toArray().tolist()
        sums = [a + n * b for a, b in zip(sums or [0.0] * len(vals), vals)]
        trees += n
    return names, [x / max(trees, 1) for x in sums]
