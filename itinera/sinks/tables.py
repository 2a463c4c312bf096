"""Table mutation: replace, append if absent, update, delete, rewrite.

Each is one read and one atomic write; there is no row-by-row update.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.operators.dedupe import keep_first, pruned_target
from itinera.operators.filters import delete_where


def replace_table(df: DataFrame, name: str) -> None:
    """DROP and CREATE AS. The frame must not read from the table it replaces."""
    df.write.mode("overwrite").option("overwriteSchema", True).saveAsTable(name)


def rows_to_append(
    df: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str], nulls_equal: bool = False, prune: bool = False
) -> DataFrame:
    """INSERT OR IGNORE: the rows whose key is new, the first in order per key.

    By default keys compare as in a SQL UNIQUE constraint: a key with a null is never a duplicate. ``prune`` is for a
    target much larger than ``df``: only its rows that may hold a new key are shuffled.
    """
    target = pruned_target(df, target, keys) if prune else target
    side = target.select(*[F.col(f"`{k}`").alias(f"__t{i}") for i, k in enumerate(keys)])
    if nulls_equal:
        fresh = keep_first(df, keys, order)
        cond = reduce(and_, [fresh[k].eqNullSafe(side[f"__t{i}"]) for i, k in enumerate(keys)])
        return fresh.join(side, cond, "left_anti")
    known = reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    fresh = keep_first(df.filter(known), keys, order)
    cond = reduce(and_, [fresh[k] == side[f"__t{i}"] for i, k in enumerate(keys)])
    return fresh.join(side, cond, "left_anti").unionByName(df.filter(~known))


def append_if_absent(df: DataFrame, name: str, keys: Sequence[str], order: Sequence[str], nulls_equal: bool = False) -> None:
    """Append the rows of :func:`rows_to_append` to a catalog table."""
    target = df.sparkSession.table(name)
    rows = rows_to_append(df, target, keys, order, nulls_equal)
    rows.select(*target.columns).write.mode("append").saveAsTable(name)


def replace_subset(df: DataFrame, predicate: Column, rewrite: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows that match are replaced by their rewritten form, all others stay: the new table content."""
    hit = F.coalesce(predicate, F.lit(False))
    return delete_where(df, predicate).unionByName(rewrite(df.filter(hit)).select(*df.columns))
