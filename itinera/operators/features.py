"""Time-series features, encodings, splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.operators.grouped import join_on, number_within, shift_within


def lag_features(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], lags: int = 2,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """``<c>_lag1..n`` and ``<c>_diff1`` per group, missing history as 0.

    Like the values themselves, nulls in ``columns`` become 0 in the output.
    """
    shifts = {f"{c}_lag{k}": (c, -k) for c in columns for k in range(1, lags + 1)}
    out = shift_within(df, keys, order, shifts, rows_per_chunk=rows_per_chunk)
    out = out.withColumns({f"{c}_diff1": F.col(c) - F.col(f"{c}_lag1") for c in columns})
    zero = [*columns, *shifts, *[f"{c}_diff1" for c in columns]]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(out.schema[c].dataType)) for c in zero})


def row_statistics(columns: Sequence[str]) -> dict[str, Column]:
    """Mean, sample deviation (0 when undefined) and null count across the columns of a row."""
    values = [F.col(c).cast("double") for c in columns]
    n = reduce(add, [F.when(v.isNotNull(), 1).otherwise(0) for v in values])
    total = reduce(add, [F.coalesce(v, F.lit(0.0)) for v in values])
    mean = F.when(n > 0, total / n)
    squares = reduce(add, [F.coalesce((v - mean) * (v - mean), F.lit(0.0)) for v in values])
    return {
        "feature_mean": mean,
        "feature_std": F.when(n > 1, F.sqrt(squares / (n - 1))).otherwise(F.lit(0.0)),
        "feature_missing": F.lit(len(values)) - n,
    }


def scale_by_max(df: DataFrame, column: str, out: str) -> DataFrame:
    """The column divided by its overall maximum."""
    return df.withColumn(out, F.col(column) / df.agg(F.max(column).alias("m")).select("m").scalar())


def category_codes(df: DataFrame, column: str, rows_per_chunk: int | None = None) -> DataFrame:
    """Distinct values with 0-based codes in sort order.

    The values are split where a sample of them says, and positions are carried over the parts, so no task sorts all
    of them, whatever prefix they share. Eager.
    """
    values = df.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    return number_within(values, [], ["value"], "__no", rows_per_chunk).select("value", (F.col("__no") - 1).alias("code"))


def label_encode(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Codes of the sorted categories as new columns; null is -1."""
    for c in columns:
        codes = category_codes(df, c).select(F.col("value").alias(c), F.col("code").alias(f"{c}{suffix}"))
        df = join_on(df, codes, [c], "left").withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(-1)))
    return df


def time_split(df: DataFrame, time: str, share: float = 0.8, rows_per_chunk: int | None = None, out: str = "is_train") -> DataFrame:
    """True before the time at position ``floor(share * n)`` of the n distinct times, false from there on."""
    times = df.select(time).filter(F.col(time).isNotNull()).distinct()
    numbered = number_within(times, [], [time], "__pos", rows_per_chunk)
    n = times.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    at = F.floor(F.lit(share) * n) + 1
    start = numbered.agg(F.min(F.when(F.col("__pos") >= at, F.col(time))).alias("t")).select("t").scalar()
    return df.withColumn(out, F.coalesce(F.col(time) < start, F.lit(False)))


def hash_split(df: DataFrame, ids: Sequence[str], share: float, seed: str = "", out: str = "is_train") -> DataFrame:
    """Repeatable random split: rows whose id hash falls below ``share``."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(i).cast("string") for i in ids]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return df.withColumn(out, bucket < F.lit(int(share * 2**32)))


def stratified_split(
    df: DataFrame, stratum: str, ids: Sequence[str], share: float, seed: str = "", out: str = "is_validation"
) -> DataFrame:
    """Exactly ``round(share * n)`` rows of every stratum, chosen by id hash.

    A stratum may hold a large part of the table, so ranks of hot ones are taken per chunk and carried. Eager.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(i).cast("string") for i in ids]))
    hashed = df.withColumn("__h", F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"))
    ranked = number_within(hashed, [stratum], ["__h", *ids], "__pos")
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("__size"))
    sized = join_on(ranked, sizes, [stratum], "left", null_safe=True)
    return sized.withColumn(out, F.col("__pos") <= F.round(F.col("__size") * share)).drop("__h", "__pos", "__size")
