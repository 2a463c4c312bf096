"""Dimension lookups, update joins, differences.

No join carries a hint: adaptive execution knows a side's bytes when it runs and broadcasts it, or shuffles both and splits
skewed keys. No job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def unique_dimension(dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key, so a lookup never multiplies rows; among duplicates the smallest values win."""
    picked = F.min(F.struct(*[F.col(c) for c in columns])).alias("__v")
    return (
        dim.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(picked)
        .select(key, *[F.col(f"__v.{c}").alias(c) for c in columns])
    )


def lookup(df: DataFrame, dim: DataFrame, value: Column | str, key: str, take: Mapping[str, str]) -> DataFrame:
    """Left join that adds ``{new column: dimension column}``; the dimension must be unique on ``key``."""
    value = F.col(value) if isinstance(value, str) else value
    side = dim.select(F.col(key).alias("__k"), *[F.col(c).alias(new) for new, c in take.items()])
    return df.withColumn("__v", value).join(side, F.col("__v") == F.col("__k"), "left").drop("__v", "__k")


def membership(df: DataFrame, members: DataFrame, value: Column | str, key: str, out: str) -> DataFrame:
    """Boolean flag: is the value in the set? Null values are not."""
    keys = members.select(F.col(key).alias("__m")).filter("__m IS NOT NULL").distinct().withColumn("__hit", F.lit(True))
    flagged = lookup(df, keys, value, "__m", {out: "__hit"})
    return flagged.withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def update_from(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """UPDATE … FROM: matched target rows take the new values (nulls included), the others stay.

    ``updates`` must be unique on the keys; ``where`` restricts which target rows may change.
    """
    side = updates.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.col(c).alias(f"__u_{c}") for c in columns],
        F.lit(True).alias("__matched"),
    )
    cond = reduce(and_, [target[k] == side[f"__k_{k}"] for k in keys])
    joined = target.join(side, cond, "left")
    hit = F.coalesce(F.col("__matched"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    new = {c: F.when(hit, F.col(f"__u_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(new).select(*target.columns)


def distinct_pairs(df: DataFrame, *pairs: tuple[Column, Column], names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """UNION of several two-column projections, made from one scan; pairs with a null are left out."""
    items = F.array(*[F.struct(a.alias(names[0]), b.alias(names[1])) for a, b in pairs])
    both = F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull()
    return df.select(F.inline(items)).filter(both).distinct()


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows without an equal right row on all common columns; nulls are equal, left duplicates stay."""
    common = [c for c in left.columns if c in set(right.columns)]
    side = right.select(*[F.col(c).alias(f"__r_{c}") for c in common])
    cond = reduce(and_, [left[c].eqNullSafe(side[f"__r_{c}"]) for c in common])
    return left.join(side, cond, "left_anti")


def literal_map(c: Column | str, mapping: Mapping[str, float], default: float | None = None) -> Column:
    """Value of a small fixed mapping."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), F.col(c) if isinstance(c, str) else c)
    return found if default is None else F.coalesce(found, F.lit(default))
