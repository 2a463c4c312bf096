"""Column layout: names, order, types, row identity."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.functions.dates import try_timestamp


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def sanitize_name(name: str) -> str:
    """A table name: everything but letters, digits and underscore to ``_``; no leading digit."""
    clean = re.sub(r"[^a-zA-Z0-9_]", "_", name)
    return f"_{clean}" if clean[:1].isdigit() else clean


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case names with ``_`` for spaces and hyphens; an empty name becomes ``col_<position>``."""
    names = []
    for i, raw in enumerate(df.columns):
        name = re.sub(r"[ \-]", "_", (raw or "").strip().lower())
        names.append(name or f"col_{i}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns; unknown names are ignored."""
    return df.drop(*names)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every cell is null."""
    return df.dropna("all")


def align_schema(df: DataFrame, columns: Sequence[str], fill: str = "") -> DataFrame:
    """Exactly these columns in this order; missing ones are filled with a blank."""
    return df.select(*[_q(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes null."""

    def convert(name: str, kind: str) -> Column:
        if kind in ("date", "timestamp_ntz", "timestamp"):
            return try_timestamp(_q(name)).cast(kind)
        return _q(name).try_cast(kind)

    return df.withColumns({n: convert(n, k) for n, k in types.items() if n in df.columns})


def reorder_after(df: DataFrame, columns: Sequence[str], anchor: str) -> DataFrame:
    """Move the columns right behind the anchor; without the anchor nothing moves."""
    if anchor not in df.columns:
        return df
    rest = [c for c in df.columns if c not in columns]
    at = rest.index(anchor) + 1
    return df.select(*[_q(c) for c in [*rest[:at], *columns, *rest[at:]]])


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema; nothing is read."""
    return df.sparkSession.createDataFrame([], df.schema)


def add_row_uuid(df: DataFrame, columns: Sequence[str] | None = None, out: str = "Id", random: bool = False) -> DataFrame:
    """A surrogate id: hash of the given columns (repeatable), or a random UUID."""
    if random:
        return df.withColumn(out, F.uuid())
    cells = [F.coalesce(_q(c).cast("string"), F.lit("\u0000")) for c in (columns or df.columns)]
    return df.withColumn(out, F.sha2(F.concat_ws("\u0001", *cells), 256))


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, column_type string")


def split_flagged(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """The rows where the flag is true and the rest, without the flag."""
    hit = F.coalesce(F.col(flag), F.lit(False))
    return df.filter(hit).drop(flag), df.filter(~hit).drop(flag)


def concat_flagged(first: DataFrame, second: DataFrame, flag: str = "is_train") -> DataFrame:
    """Both frames under each other, with a flag that tells the first from the second."""
    return first.withColumn(flag, F.lit(True)).unionByName(
        second.withColumn(flag, F.lit(False)), allowMissingColumns=True
    )


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal table (fixed mappings)."""
    return spark.createDataFrame(list(rows), schema)
