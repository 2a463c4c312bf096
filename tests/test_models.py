"""Trees and boosted forecasts against plain splits."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from itinera.plans import models


@pytest.fixture(scope="module")
def steps(spark):
    """A step that a line cannot follow, and a column without influence."""
    return spark.range(400).select(
        "id", (F.col("id") % 100).cast("double").alias("x"), ((F.col("id") * 7) % 13).cast("double").alias("noise"),
        F.when(F.col("id") % 100 < 37, 2.0).otherwise(12.0).alias("y"), F.lit(1.0).alias("w"), (F.col("id") % 5 == 0).alias("late"),
    )


def test_trees_find_the_step_that_a_line_misses(steps):
    got = {r["model"]: r for r in models.compare_regressors(steps, ["x", "noise"], "y", ["id"], trees=5).collect()}
    line = got["Linear Regression"]["rmse"]  # cuts are binned, so a tree misses a few values next to the step
    assert got["Decision Tree"]["rmse"] < 0.8 * line and got["Random Forest"]["rmse"] < 0.9 * line
    assert got["Decision Tree"]["r2"] > 0.8


def test_one_round_is_the_best_single_split(spark, steps):
    model = models.boosted_forecast(steps, ["x", "noise"], "y", "w", "late", iterations=1, depth=1)
    rows = models.forecast(model, steps, ["x", "noise"]).select("x", "noise", "y", "late", "prediction").collect()
    train = [r for r in rows if not r["late"]]
    best = None
    for name in ("x", "noise"):
        for cut in sorted({r[name] for r in train})[:-1]:
            sides = [[r["y"] for r in train if (r[name] <= cut) == low] for low in (True, False)]
            loss = sum(((np.array(s) - np.mean(s)) ** 2).sum() for s in sides)
            if best is None or loss < best[0]:
                best = (loss, name, cut, [float(np.mean(s)) for s in sides])
    _, name, cut, means = best
    near = [r for r in rows if abs(r[name] - cut) > 4]  # the library chooses among binned cuts
    assert [r["prediction"] for r in near] == pytest.approx([means[0] if r[name] <= cut else means[1] for r in near], abs=0.6)
    top = models.top_importances(spark, model, ["x", "noise"]).collect()
    assert (top[0]["feature"], round(top[0]["importance"], 6)) == ("x", 1.0)
