"""Model fitting, comparison, persistence and batch scoring (Spark MLlib).

Estimators are chosen by name from a registry; every model is a
``PipelineModel`` (encoding + assembly + scaling + regressor), saved and
loaded as one unit, so scoring applies exactly the transformations fitted
on the training split (the reference refits a scaler at serving time).
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoframe.functions.expressions import col_of
from ecoframe.operators.evaluate import regression_metrics
from ecoframe.operators.features import onehot_vector_model, onehot_wide
from ecoframe.operators.forest import min_split_forest
from ecoframe.operators.grow import fit_forest
from ecoframe.operators.knn import knn_regress
from ecoframe.operators.linear import LeastSquares
from ecoframe.operators.walk import Walker, inputs
from ecoframe.schema import KNN_K, RF_FINAL_PARAMS
from ecoframe.session import discard, materialize

# MLlib's deepest tree has 30 levels, and 256 bins are as fine as its candidate splits get here.
# It has no least split size: `fit_model` prunes the final forest by RF_FINAL_MIN_SPLIT.
DEPTH = dict(maxDepth=30, maxBins=256, maxMemoryInMB=512, cacheNodeIds=True)
# Final forest: no bootstrap, 75 % of features per split.
RF_FINAL = dict(numTrees=RF_FINAL_PARAMS["n_estimators"], bootstrap=RF_FINAL_PARAMS["bootstrap"],
                featureSubsetStrategy=str(RF_FINAL_PARAMS["max_features"]),
                minInstancesPerNode=RF_FINAL_PARAMS["min_samples_leaf"], seed=RF_FINAL_PARAMS["random_state"], **DEPTH)
RF_FINAL_MIN_SPLIT = RF_FINAL_PARAMS["min_samples_split"]
# Library defaults of the dashboard forest: bootstrap, all features.
RF_DEFAULT = dict(numTrees=100, bootstrap=True, featureSubsetStrategy="all", seed=42, **DEPTH)
RF_SETTINGS = {"rf_final": RF_FINAL, "rf_default": RF_DEFAULT}


def estimator(name: str, label: str = "label", features: str = "features", **kw):
    if name == "ols":
        return LeastSquares(featuresCol=features, labelCol=label)
    if name in RF_SETTINGS:
        return RandomForestRegressor(featuresCol=features, labelCol=label, **{**RF_SETTINGS[name], **kw})
    raise KeyError(name)


def feature_pipeline(numeric: list, categorical: list, scale: bool = True) -> list:
    """Stages that turn the narrow table into a ``features`` vector."""
    stages = []
    if categorical:
        stages += onehot_vector_model(categorical, numeric, out="raw_features").getStages()
    else:
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol="raw_features"))
    if scale:  # the numbers alone: centring flags would make every sparse row dense
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol="numbers"))
        stages.append(StandardScaler(inputCol="numbers", outputCol="scaled_numbers", withMean=True, withStd=True))
        stages.append(VectorAssembler(inputCols=["scaled_numbers", *[f"{c}_vec" for c in categorical]], outputCol="features"))
    else:
        stages.append(VectorAssembler(inputCols=["raw_features"], outputCol="features"))
    return stages


TREE_ROWS = 50_000  # rows of a task: MLlib holds a counter and a node number per training row and tree, and a row walks 100 trees


def spread(rows: DataFrame, at_most: int = TREE_ROWS, cores: int = 1) -> DataFrame:
    """``rows`` in as many partitions as keep every one near ``at_most`` rows, and on up to ``cores`` cores a tenth of that;
    unchanged where they are enough already."""
    n = rows.count()
    parts = max(-(-n // at_most), min(-(-10 * n // at_most), cores))
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


# Training rows of a task where `TREE_ROWS` would make more tasks than cores.  In every pass a task sends a table of all open nodes,
# as large for few rows as for many, so tasks are few; what a row holds (about 1 kB) goes to disk where memory is short.
FOREST_ROWS = 500_000


def deal(rows: DataFrame, bootstrap: bool) -> DataFrame:
    """Training rows (with a ``label``) of a forest, in whole rounds over the cores.  A task adds its rows to the table of open nodes one
    after another: sorted, they find the places of the row before, which are still in the processor's cache.  A bootstrap is drawn
    by partition and place: where rows are too few for a task on every core, they stay as they are."""
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    if n <= TREE_ROWS * cores:
        return spread(rows, TREE_ROWS, 1 if bootstrap else cores)
    order = ["label", *[c for c in rows.columns if c != "label"]]
    return rows.repartition(-(-n // (FOREST_ROWS * cores)) * cores).sortWithinPartitions(*[col_of(c) for c in order])


WEIGHT = "_weight"  # rows that one training row stands for


def together(rows: DataFrame) -> DataFrame:
    """Equal rows as one, and how many they were as `WEIGHT`.  A forest without bootstrap grown on these weights is the one
    grown on the rows: every count and sum of a node is the same."""
    return rows.groupBy(*[col_of(c) for c in rows.columns]).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))


GROWN_ROWS = 1_000_000  # training rows (different ones without bootstrap) above which the trees are grown whole, see `grow`


def fit_model(train: DataFrame, name: str, numeric: list, categorical: list, label: str,
              scale: bool = True, **kw) -> PipelineModel:
    data, written, grown = train.withColumn("label", col_of(label).cast("double")), None, False
    if name.startswith("rf"):
        data = data.select("label", *[col_of(c) for c in [*numeric, *categorical]])
        # a scaler counts rows, and MLlib's bootstrap draws each of them: only without both are weights the same there
        bootstrap = {**RF_SETTINGS[name], **kw}["bootstrap"]
        grown = not scale and bootstrap and data.count() > GROWN_ROWS
        if not scale and (grown or not bootstrap):
            data = written = materialize(together(data), "training-rows")
            grown = grown or written.count() > GROWN_ROWS
        if not grown:
            kw = {**kw, "weightCol": WEIGHT} if written is not None else kw
            data = deal(data, bootstrap=written is None)
    stages, min_split = feature_pipeline(numeric, categorical, scale), RF_FINAL_MIN_SPLIT if name == "rf_final" else 0
    if grown:
        features = Pipeline(stages=stages).fit(data)
        model = PipelineModel([*features.stages, fit_forest(data, features, estimator(name, **kw), numeric, categorical, WEIGHT, min_split)])
    else:
        model = Pipeline(stages=stages + [estimator(name, **kw)]).fit(data)
        if min_split:
            model = PipelineModel([*model.stages[:-1], min_split_forest(model.stages[-1], min_split)])
    if written is not None:
        discard(written)
    return model


def predict(model: PipelineModel, df: DataFrame, keep: list, label: str | None = None) -> DataFrame:
    cols = [col_of(c) for c in keep]
    if label:
        cols.append(col_of(label).alias("y_true"))
    if inputs(model):
        return Walker(df.sparkSession, model).predictions(df, cols).withColumnRenamed("prediction", "y_pred")
    return model.transform(df).select(*cols, F.col("prediction").alias("y_pred"))


def model_signature(model: PipelineModel, df: DataFrame, inputs: list, features: str = "raw_features") -> dict:
    """Input columns with types, output column and feature names of a fitted pipeline."""
    types = dict(df.dtypes)
    return {"inputs": [{"name": c, "type": types[c]} for c in inputs], "output": {"name": "prediction", "type": "double"},
            "features": feature_names(model, df, features)}


def save_model(model: PipelineModel, path: str, signature: dict | None = None) -> str:
    """Saves the pipeline, and its signature (with the feature list) as JSON beside it."""
    model.write().overwrite().save(path)
    if signature is not None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(signature),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}-signature")
    return path


def load_signature(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}-signature").first()["value"])


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_names(model: PipelineModel, df: DataFrame, col: str = "raw_features") -> list:
    """Slot names of the assembled vector, from the ML attribute metadata."""
    meta = model.transform(df.limit(0)).schema[col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs += group
    return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]


def knn_predictions(train: DataFrame, test: DataFrame, numeric: list, categories: dict, label: str, key: str, k: int = KNN_K) -> DataFrame:
    """``(key, y_true, y_pred)`` of the test rows: unscaled numbers and 0/1 flags of the trained ``categories`` (column -> values)."""
    cols = list(numeric)
    sides = [train, test]
    for c, values in categories.items():
        sides = [onehot_wide(side, c, c, values) for side in sides]
        cols += [f"{c}_{v}" for v in values]
    p = knn_regress(*sides, cols, label, key, key, k=k)
    # equal keys are equal rows with one prediction: one row per key before joining
    return test.select(col_of(key), col_of(label).alias("y_true")).join(p.distinct(), key).withColumnRenamed("prediction", "y_pred")


def compare_models(train: DataFrame, test: DataFrame, label: str, feature_sets: dict, key: str, models=("ols", "knn", "rf_default"),
                   categories: dict | None = None, known: dict | None = None, rf_kw: dict | None = None) -> DataFrame:
    """Fit every model on every feature set (name -> (numeric, categorical)); one row of test metrics each:
    ``(model, features, n, mse, rmse, r2)``.

    Test predictions are written once per (model, set), ``known`` ones are taken as they are, and one grouped
    aggregate over all of them gives the metrics.  ``categories`` are the trained values of the categorical columns."""
    spark = train.sparkSession
    together = None
    for fs_name, (numeric, categorical) in feature_sets.items():
        for m in models:
            pred = (known or {}).get((m, fs_name))
            if pred is None:
                if m == "knn":
                    made = knn_predictions(train, test, numeric, {c: categories[c] for c in categorical}, label, key)
                else:
                    mdl = fit_model(train, m, numeric, categorical, label, scale=False, **(rf_kw or {}) if m.startswith("rf") else {})
                    made = predict(mdl, test, [key], label)
                pred = materialize(made.select("y_true", "y_pred"), f"predictions-{m}")
            pred = pred.select(F.lit(m).alias("model"), F.lit(fs_name).alias("features"), "y_true", "y_pred")
            together = pred if together is None else together.unionByName(pred)
    if together is None:
        return spark.createDataFrame([], "model string, features string, n long, mse double, rmse double, r2 double")
    return regression_metrics(together, by=["model", "features"])
