"""Regression comparison and boosted forecasting on ``pyspark.ml`` (training is distributed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.operators.features import hash_split
from itinera.operators.layout import local_rows


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature vector; rows with a missing feature are kept with 0."""
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)


def compare_regressors(
    df: DataFrame, features: Sequence[str], label: str, ids: Sequence[str], share: float = 0.8, trees: int = 20, seed: int = 42
) -> DataFrame:
    """RMSE and R2 of a linear model, a tree and a forest on a held-out share. Eager: fits the models."""
    data = hash_split(assemble(df, features).withColumn("__y", F.col(label).cast("double")), ids, share)
    train, held = data.filter("is_train"), data.filter("NOT is_train")
    models = {
        "Linear Regression": LinearRegression(labelCol="__y"),
        "Decision Tree": DecisionTreeRegressor(labelCol="__y", seed=seed),
        "Random Forest": RandomForestRegressor(labelCol="__y", numTrees=trees, seed=seed),
    }
    rows = []
    for name, model in models.items():
        scored = model.fit(train).transform(held)
        score = lambda m: RegressionEvaluator(labelCol="__y", metricName=m).evaluate(scored)  # noqa: B023, E731
        rows.append((name, float(score("rmse")), float(score("r2"))))
    return local_rows(df.sparkSession, rows, "model string, rmse double, r2 double")


def boosted_forecast(
    train: DataFrame, features: Sequence[str], label: str, weight: str, is_validation: str, iterations: int = 20,
    depth: int = 5, seed: int = 42,
):
    """Weighted boosted trees that stop early on the validation rows. Eager; returns the fitted model."""
    data = assemble(train, features).withColumns(
        {"__y": F.col(label).cast("double"), "__w": F.col(weight).cast("double")}
    )
    booster = GBTRegressor(
        labelCol="__y", weightCol="__w", validationIndicatorCol=is_validation, maxIter=iterations, maxDepth=depth,
        seed=seed, predictionCol="prediction",
    )
    return booster.fit(data)


def forecast(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    return model.transform(assemble(df, features)).drop("features")


def top_importances(spark: SparkSession, model, features: Sequence[str], k: int = 15) -> DataFrame:
    """The k most important features of a fitted tree model."""
    ranked = sorted(zip(features, model.featureImportances.toArray()), key=lambda x: (-x[1], x[0]))
    return local_rows(spark, [(f, float(v)) for f, v in ranked[:k]], "feature string, importance double")
