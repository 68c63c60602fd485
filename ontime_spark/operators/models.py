"""Classifiers (M1-M3), prediction (M10), persistence (S9) and feature importances.

The three model types keep their published names: 'lr' (logistic regression), 'rf' (random
forest) and 'xgboost' (second-order gradient boosting with all published settings,
``operators.boosting``). 'gbt' is Spark's own GBTClassifier, which has no L1/L2 terms.
Class balance is a weight column: N / (2 n_c) for 'lr' and 'rf', and n_neg / n_pos on the
positives for 'gbt'; 'xgboost' weighs them in its gradients.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark import schemas as S
from ontime_spark.operators import boosting
from ontime_spark.operators.encoders import class_weights

MODEL_TYPES = ("lr", "rf", "xgboost")

Model = PipelineModel | boosting.BoostedTreesModel

# Published hyper-parameters.
LR_MAX_ITER = 1000
RF_TREES, RF_DEPTH = 300, 15
GBT_DEPTH, GBT_RATE, GBT_ROUNDS, GBT_SUBSAMPLE, GBT_COLSAMPLE, GBT_MIN_CHILD = 6, 0.1, 500, 0.8, 0.8, 3


def add_weights(df: DataFrame, model_type: str, label: str = "label") -> DataFrame:
    """Weight column for class balance (A7), joined from the two-row weight table."""
    w = class_weights(df, label)
    if model_type == "gbt":
        w = w.select(label, F.when(F.col(label) == 1, F.col("scale_pos_weight"))
                     .otherwise(F.lit(1.0)).alias("weight"))
    else:
        w = w.select(label, "weight")
    return df.join(F.broadcast(w), label, "left")


def build_estimator(model_type: str, n_weight: float | None = None, seed: int = S.RANDOM_STATE,
                    rf_trees: int = RF_TREES, gbt_rounds: int = GBT_ROUNDS,
                    features: str = "features", label: str = "label"):
    """M1, M2 and Spark's GBT with the published settings (``rf_trees`` and ``gbt_rounds`` are lowered in
    tests and in registered queries)."""
    if model_type == "lr":
        # C = 1 on a weighted sum of losses  <=>  regParam = 1 / sum(weights) on Spark's mean.
        return LogisticRegression(featuresCol=features, labelCol=label, weightCol="weight",
                                  maxIter=LR_MAX_ITER, regParam=1.0 / (n_weight or 1.0),
                                  elasticNetParam=0.0, standardization=False, family="binomial")
    if model_type == "rf":
        return RandomForestClassifier(featuresCol=features, labelCol=label, weightCol="weight",
                                      numTrees=rf_trees, maxDepth=RF_DEPTH, seed=seed)
    if model_type == "gbt":
        return GBTClassifier(featuresCol=features, labelCol=label, weightCol="weight",
                             maxDepth=GBT_DEPTH, stepSize=GBT_RATE, maxIter=gbt_rounds,
                             subsamplingRate=GBT_SUBSAMPLE,
                             featureSubsetStrategy=str(GBT_COLSAMPLE),
                             minInstancesPerNode=GBT_MIN_CHILD, seed=seed)
    raise ValueError(f"no model type {model_type!r}; there are {', '.join(MODEL_TYPES)}")


def train_model(train: DataFrame, model_type: str = "xgboost",
                feature_cols: Sequence[str] | None = None, label: str = S.TARGET_COL,
                **kwargs) -> Model:
    """Fit assembler + classifier on a numeric matrix (columns ``feature_cols`` and ``label``).
    Returns a ``PipelineModel`` (save/load with Spark ML persistence), or for 'xgboost' a
    ``BoostedTreesModel`` (``gbt_rounds`` or ``settings`` change the published settings)."""
    cols = list(feature_cols or [c for c in S.NUMERIC_FEATURES if c in train.columns])
    if model_type == "xgboost":
        settings = kwargs.pop("settings", boosting.Settings(rounds=kwargs.pop("gbt_rounds", GBT_ROUNDS)))
        return boosting.fit(train, cols, label, settings)
    data = train.withColumn("label", F.col(label).cast("double"))
    data = add_weights(data, model_type)
    n_weight = data.agg(F.sum("weight")).first()[0] if model_type == "lr" else None
    est = build_estimator(model_type, n_weight=n_weight, **kwargs)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features",
                                            handleInvalid="keep"), est])
    return pipe.fit(data)


def predict(model: Model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds ``probability_delayed`` (P(class 1)) and ``predicted`` (probability >
    threshold, as the classifier's own prediction)."""
    if isinstance(model, boosting.BoostedTreesModel):
        out = df.withColumn("probability_delayed", model.probability())
        return out.withColumn("predicted", (F.col("probability_delayed") > threshold).cast("int"))
    out = model.transform(df)
    p = vector_to_array("probability")[1]
    return (out.withColumn("probability_delayed", p)
               .withColumn("predicted", (F.col("probability_delayed") > threshold).cast("int"))
               .drop("features", "rawPrediction", "probability", "prediction"))


def classifier(model: PipelineModel):
    return model.stages[-1]


def feature_names(model: Model) -> list[str]:
    if isinstance(model, boosting.BoostedTreesModel):
        return list(model.features)
    return list(model.stages[0].getInputCols())


def feature_importances(spark: SparkSession, model: Model, top_n: int = 20) -> DataFrame:
    """Top-n importances of a tree model (a 36-entry vector held by the model)."""
    if isinstance(model, boosting.BoostedTreesModel):
        rows = model.importances()
    else:
        clf = classifier(model)
        if not hasattr(clf, "featureImportances"):
            raise TypeError("feature importances need a tree model")
        imp = clf.featureImportances.toArray().tolist()
        rows = list(zip(feature_names(model), [float(v) for v in imp]))
    return spark.createDataFrame(rows, "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature").limit(top_n)


def save_model(model: Model, path: str) -> str:
    """S9."""
    if isinstance(model, boosting.BoostedTreesModel):
        return model.save(SparkSession.getActiveSession(), path)
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> Model:
    spark = SparkSession.getActiveSession()
    if path_exists(spark, f"{path}/nodes"):
        return boosting.BoostedTreesModel.load(spark, path)
    return PipelineModel.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)


def load_all_models(spark: SparkSession, models_dir: str) -> dict[str, Model]:
    """Every saved model of the three types that exists, keyed by type."""
    out = {}
    for t in MODEL_TYPES:
        p = os.path.join(models_dir, f"{t}_model")
        if path_exists(spark, p):
            out[t] = load_model(p)
    return out
