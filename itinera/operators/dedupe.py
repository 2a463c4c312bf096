"""Duplicate removal: inside a row, inside a booking, inside a run, against a target."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itinera.operators.grouped import attach_group
from itinera.operators.prune import key_filter, key_hash, may_contain

Key = Callable[[Column], Sequence[Column]]


def first_per(legs: Column, key: Key) -> Column:
    """Array elements whose key did not occur earlier in the array."""

    def fresh(leg: Column, i: Column) -> Column:
        def equal(other: Column) -> Column:
            return reduce(and_, [a.eqNullSafe(b) for a, b in zip(key(other), key(leg))])

        return ~F.exists(F.slice(legs, F.lit(1), i), equal)

    return F.filter(legs, fresh)


def dedupe_segments(legs: Column) -> Column:
    """First leg of each flight number and calendar day."""
    return first_per(legs, lambda leg: (leg["fn"], leg["dt"].cast("date")))


def dedupe_dates(legs: Column) -> Column:
    """First leg of each date value."""
    return first_per(legs, lambda leg: (leg["dt"],))


def dedupe_pairs(legs: Column) -> Column:
    """First leg of each pair of flight number and date value."""
    return first_per(legs, lambda leg: (leg["fn"], leg["dt"]))


def collapse_consecutive(legs: Column) -> Column:
    """Drop a leg equal to the one just before it."""

    def changed(leg: Column, i: Column) -> Column:
        before = F.get(legs, i - 1)
        return (i == 0) | ~(before["fn"].eqNullSafe(leg["fn"]) & before["dt"].eqNullSafe(leg["dt"]))

    return F.filter(legs, changed)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in order; null keys are equal.

    ``row_number() = 1`` is cut down on the map side before the shuffle, so copies of one key cost nothing.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    return df.withColumn("__first", F.row_number().over(w)).filter(F.col("__first") == 1).drop("__first")


def flag_repeats(df: DataFrame, keys: Sequence[str], ids: Sequence[str], out: str = "is_repeat") -> DataFrame:
    """Mark every row but the first (lowest ``ids``) of each key; null keys are equal. ``ids`` must be unique.

    The lowest id per key is a partial aggregate before its shuffle; the rows meet it in one join, which adaptive
    execution can split at a hot key. The input is read twice: store it first if it is costly.
    """
    identity = F.struct(*[F.col(i) for i in ids])
    joined = attach_group(df, keys, [F.min(identity).alias("__lowest")], null_safe=True)
    return joined.withColumn(out, F.col("__lowest") != identity).drop("__lowest")


def _key_match(df: DataFrame, side: DataFrame, keys: Sequence[str], trim_equal: Sequence[str]) -> Column:
    """Null-safe equality of the keys with ``__t_<key>`` columns; trimmed plain equality for ``trim_equal``."""

    def equal(k: str) -> Column:
        if k in trim_equal:
            return F.trim(df[k].cast("string")) == side[f"__t_{k}"]
        return df[k].eqNullSafe(side[f"__t_{k}"])

    return reduce(and_, [equal(k) for k in keys])


def _key_side(target: DataFrame, keys: Sequence[str], trim_equal: Sequence[str]) -> DataFrame:
    value = lambda k: F.trim(F.col(f"`{k}`").cast("string")) if k in trim_equal else F.col(f"`{k}`")
    return target.select(*[value(k).alias(f"__t_{k}") for k in keys])


def pruned_target(df: DataFrame, target: DataFrame, keys: Sequence[str], trim_equal: Sequence[str] = ()) -> DataFrame:
    """The target's rows that may hold a key of ``df``, by a Bloom filter of the run's keys (:mod:`itinera.operators.prune`).

    For a small run against a large target: the target is scanned, but only rows that pass are shuffled.
    """
    value = lambda k: F.trim(F.col(f"`{k}`").cast("string")) if k in trim_equal else F.col(f"`{k}`")
    h = key_hash([value(k) for k in keys])
    return may_contain(target, h, key_filter(df.select(h.alias("h")), "h"))


def match_target(
    df: DataFrame, target: DataFrame, keys: Sequence[str], trim_equal: Sequence[str] = (), how: str = "left_semi", prune: bool = False
) -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) in the target.

    Null matches null, except for the ``trim_equal`` columns, which compare trimmed text and never match on null.
    ``prune`` is for a target much larger than ``df`` (:func:`pruned_target`).
    """
    side = _key_side(pruned_target(df, target, keys, trim_equal) if prune else target, keys, trim_equal)
    return df.join(side, _key_match(df, side, keys, trim_equal), how)


def flag_known(
    df: DataFrame, target: DataFrame, keys: Sequence[str], out: str, trim_equal: Sequence[str] = (), prune: bool = False
) -> DataFrame:
    """All rows with a flag that tells whether their key is in the target; key comparison as in :func:`match_target`."""
    near = pruned_target(df, target, keys, trim_equal) if prune else target
    side = _key_side(near, keys, trim_equal).distinct().withColumn("__known_key", F.lit(True))
    flagged = df.join(side, _key_match(df, side, keys, trim_equal), "left")
    kept = flagged.withColumn(out, F.col("__known_key").isNotNull())
    return kept.drop("__known_key", *[f"__t_{k}" for k in keys])


def duplicate_diagnosis(df: DataFrame, identity: Sequence[str], *key_sets: Sequence[str]) -> DataFrame:
    """One row: excess rows by full identity, then by each key set; null-holding keys count like any other."""
    names = ["identical_rows", *[f"excess_key_{i}" for i in range(1, len(key_sets) + 1)]]
    parts = []
    for name, keys in zip(names, [identity, *key_sets]):
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).select(F.lit(name).alias("measure"), "n"))
    return reduce(DataFrame.unionByName, parts)
