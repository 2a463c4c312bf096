"""Parquet and catalog tables."""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from itinera.operators.layout import empty_like


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def matching_tables(spark: SparkSession, like: str, database: str | None = None) -> list[str]:
    """Catalog tables and views whose name fits a SQL LIKE pattern, sorted."""
    pattern = like.replace("%", "*").replace("_", "?")
    names = {t.name for t in spark.catalog.listTables(database)}
    return sorted(n for n in names if fnmatch.fnmatchcase(n.lower(), pattern.lower()))


def union_tables(spark: SparkSession, like: str, database: str | None = None) -> DataFrame:
    """All matching tables under the first one's schema."""
    names = matching_tables(spark, like, database)
    if not names:
        raise ValueError(f"no table like {like!r}")
    qualified = [f"{database}.{n}" if database else n for n in names]
    merged = empty_like(spark.table(qualified[0]))
    columns = merged.columns
    for name in qualified:
        merged = merged.unionByName(spark.table(name).select(*columns))
    return merged
