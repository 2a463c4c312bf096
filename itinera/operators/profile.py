"""Counts, fill rates, reconciliation and distribution summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.operators.quantiles import exact_quantiles


def rejection_summary(rejected: DataFrame, reason: str = "RejectionReason") -> DataFrame:
    """Rows per reason, most frequent first."""
    return rejected.groupBy(reason).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), reason)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("measure"), "n")


def reconcile(source: DataFrame, accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: source, target, rejected, accounted, delta (negative by the number of route splits)."""
    counts = reduce(
        DataFrame.unionByName,
        [_count(source, "source"), _count(accepted, "target"), _count(rejected, "rejected")],
    )
    pick = lambda name: F.sum(F.when(F.col("measure") == name, F.col("n")).otherwise(0))
    one = counts.agg(*[pick(m).alias(f"{m}_rows") for m in ("source", "target", "rejected")])
    return one.withColumns(
        {
            "accounted_rows": F.col("target_rows") + F.col("rejected_rows"),
            "delta_rows": F.col("source_rows") - F.col("target_rows") - F.col("rejected_rows"),
        }
    )


def fill_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: total, filled, missing, percentage filled; one pass over the table."""
    counts = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count(F.col(c)).alias(f"__n_{i}") for i, c in enumerate(columns)])
    items = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"__n_{i}").alias("filled")) for i, c in enumerate(columns)]
    )
    rows = counts.select(F.col("__total").alias("total"), F.inline(items))
    return rows.select(
        "column_name",
        "total",
        "filled",
        (F.col("total") - F.col("filled")).alias("missing"),
        F.round(F.when(F.col("total") > 0, 100.0 * F.col("filled") / F.col("total")), 4).alias("filled_pct"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: null count; plus the table's row, column and duplicate-row counts on every line."""
    fills = fill_rate(df, df.columns).select("column_name", F.col("missing").alias("nulls"), F.col("total").alias("row_count"))
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    extra = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
    return fills.select(
        "*", F.lit(len(df.columns)).alias("column_count"), extra.select("duplicate_rows").scalar().alias("duplicate_rows")
    )


def value_counts(df: DataFrame, column: str, normalize: bool = False, drop_null: bool = True) -> DataFrame:
    """Rows per value, most frequent first; ``normalize`` adds the share of all counted rows."""
    rows = df.filter(F.col(column).isNotNull()) if drop_null else df
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    if normalize:
        total = rows.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
        counts = counts.withColumn("share", F.col("cnt") / total)
    return counts.orderBy(F.desc("cnt"), column)


def group_mean_top(df: DataFrame, group: str, value: str, k: int = 10, digits: int | None = None) -> DataFrame:
    """The k groups with the highest mean (the report is a top-k by definition)."""
    mean = F.avg(value) if digits is None else F.round(F.avg(value), digits)
    return df.groupBy(group).agg(mean.alias("mean_value")).orderBy(F.desc("mean_value"), group).limit(k)


def variance_ranking(df: DataFrame, columns: Sequence[str], k: int, digits: int | None = None) -> DataFrame:
    """The k columns of largest sample variance; all variances come from one pass."""
    rounded = lambda c: c if digits is None else F.round(c, digits)
    one = df.agg(*[rounded(F.var_samp(c)).alias(c) for c in columns])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("variance")) for c in columns])
    return one.select(F.inline(items)).orderBy(F.desc("variance"), "feature").limit(k)


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Pearson correlation of every pair over the rows that have both values, long form, one pass for any number of columns.

    Tasks add up one matrix of co-moments each, in blocks of rows. The matrices are merged row by row by Chan's formula, in
    two steps, so what a merging task holds depends on the numbers of columns and tasks alone.
    """
    k = len(columns)
    read = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def add_up(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(k)])
                for at in range(0, len(x), 4096):
                    total = _merged(total, _moments(x[at : at + 4096]))
        if total is not None:
            rows = [np.ascontiguousarray(total[:, i]).tobytes() for i in range(k)]
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(rows, pa.binary())], names=["i", "m"])

    def merge(rows):
        total = None
        for m in rows["m"]:
            total = _merged(total, np.frombuffer(m).reshape(6, k))
        return pd.DataFrame({"i": rows["i"].iloc[:1], "m": [total.tobytes()]})

    parts = read.mapInArrow(add_up, "i int, m binary").withColumn("g", F.spark_partition_id() % _MERGERS)
    one = parts.groupBy("i", "g").applyInPandas(merge, "i int, m binary").groupBy("i").applyInPandas(merge, "i int, m binary")

    def cells(batches):
        names = pa.array(list(columns))
        for batch in batches:
            for i, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, _, _, xx, yy, xy = np.frombuffer(m).reshape(6, k)
                with np.errstate(divide="ignore", invalid="ignore"):
                    r = np.where(n > 1, xy / np.sqrt(xx * yy), np.nan)
                # a correlation that is not defined is null, as built-in functions give it
                values = pa.array(r, pa.float64(), mask=~np.isfinite(r))
                yield pa.RecordBatch.from_arrays([pa.array([columns[i]] * k), names, values], names=["a", "b", "r"])

    out = one.mapInArrow(cells, "a string, b string, r double")
    return out if digits is None else out.withColumn("r", F.round("r", digits))


# Groups of tasks whose rows are merged before the last step.
_MERGERS = 64


def _moments(x: np.ndarray) -> np.ndarray:
    """(count, mean of x, mean of y, co-moments xx, yy, xy) for each pair of columns, over rows where both are present."""
    present = ~np.isnan(x)
    here = present.astype(float)
    n = here.T @ here
    shift = np.where(present.any(axis=0), np.nansum(x, axis=0) / np.maximum(present.sum(axis=0), 1), 0.0)
    z = np.where(present, x - shift, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        sx, sy = z.T @ here, here.T @ z
        mx, my = np.where(n > 0, sx / n, 0.0), np.where(n > 0, sy / n, 0.0)
    square = (z * z).T
    xx, yy = square @ here - n * mx * mx, here.T @ square.T - n * my * my
    xy = z.T @ z - n * mx * my
    return np.stack([n, mx + shift[:, None], my + shift[None, :], np.maximum(xx, 0.0), np.maximum(yy, 0.0), xy])


def _merged(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    if a is None:
        return b
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = np.where(a[0] > 0, b[1] - a[1], 0.0), np.where(a[0] > 0, b[2] - a[2], 0.0)
    w = a[0] * share
    means = [np.where(a[0] > 0, a[1] + dx * share, b[1]), np.where(a[0] > 0, a[2] + dy * share, b[2])]
    return np.stack([n, *means, a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w, a[5] + b[5] + dx * dy * w])


def describe(df: DataFrame, column: str, digits: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of one column, as (measure, value)."""
    quarts = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    rounded = lambda c: c if digits is None else F.round(c, digits)
    stats: dict[str, Column] = {
        "count": F.count(column).cast("double"),
        "mean": F.avg(column),
        "std": F.stddev_samp(column),
        "min": F.min(column).cast("double"),
        "25%": F.lit(quarts[0]).cast("double"),
        "50%": F.lit(quarts[1]).cast("double"),
        "75%": F.lit(quarts[2]).cast("double"),
        "max": F.max(column).cast("double"),
    }
    one = df.agg(*[rounded(v).alias(k) for k, v in stats.items()])
    items = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(f"`{k}`").alias("value")) for k in stats])
    return one.select(F.inline(items))


def weighted_score(df: DataFrame, actual: str, predicted: str, weight: str, groups: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """``sqrt(max(0, 1 - sum(w(y-p)^2) / sum(w y^2)))`` per group or overall; 0 where the denominator is not positive."""
    y, p, w = F.col(actual), F.col(predicted), F.col(weight)
    sums = df.groupBy(*groups).agg(
        F.sum(w * (y - p) * (y - p)).alias("__num"), F.sum(w * y * y).alias("__den"), F.count(F.lit(1)).alias("row_count")
    )
    score = F.when(
        F.col("__den") > 0, F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - F.col("__num") / F.col("__den")))
    ).otherwise(F.lit(0.0))
    return sums.select(*groups, "row_count", (score if digits is None else F.round(score, digits)).alias("score"))
