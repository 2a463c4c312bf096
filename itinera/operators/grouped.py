"""Group results brought back to the rows, without ever holding a hot group in one task.

Window functions over a key put all its rows in one task. These helpers use two other shapes:

* unordered results: partial aggregation, then a join back. The summary goes through its own exchange so that the
  adaptive skew-join rule can split a hot key on the row side.
* ordered results: a sample of keys and order columns tells which groups are larger than a chunk (:func:`hot_splits`). If
  none is, plain windows do. Otherwise each hot group is cut where its sample says, whatever its key is, so its chunks
  hold about equally many rows: rows are exchanged once by group and chunk and windowed there, one summary row per
  chunk of the hot groups is windowed per group, and the carried values are joined back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUP, CHUNK, RN = "__group", "__chunk", "__rn"

# A chunk is an eighth of a task's share of the rows, but not less than so many rows; sampled rows per chunk.
CHUNKS_PER_TASK, LEAST_ROWS, SAMPLED = 8, 50_000, 16


def group_summary(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """One row per key. Grouping goes over a struct, so null keys group together and a later join on the plain key
    columns gets an exchange of its own."""
    out = df.groupBy(F.struct(*[F.col(k) for k in keys]).alias(GROUP)).agg(*aggs)
    return out.select(*[F.col(f"{GROUP}.{k}").alias(k) for k in keys], *[c for c in out.columns if c != GROUP])


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False) -> DataFrame:
    """Join on same-named key columns, keeping the left ones; ``null_safe`` lets null match null."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    pairs = [
        left[k].eqNullSafe(renamed[f"__r_{k}"]) if null_safe else left[k] == renamed[f"__r_{k}"] for k in keys
    ]
    cond = pairs[0]
    for p in pairs[1:]:
        cond = cond & p
    joined = left.join(renamed, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])


def attach_group(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], null_safe: bool = False
) -> DataFrame:
    """Add per-group aggregates to every row. With ``null_safe`` off, rows with a null key get nulls."""
    return join_on(df, group_summary(df, keys, aggs), keys, "left", null_safe)


def group_of(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(1).alias("all"))


def hot_splits(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_chunk: int | None = None) -> DataFrame | None:
    """(group, blocks) of the groups that fill more than a chunk, or None. Eager: a count and a sample of keys and order.

    The sample has about ``SAMPLED`` rows a chunk, so the driver sees at most a fixed number of rows a task. Every
    ``SAMPLED``-th of a group's sorted sample is a split; splits are nested in blocks of about the square root of their
    number, so that a row compares itself to few of them. Groups compare null-safe and order columns as structs do.
    """
    spark = df.sparkSession
    narrow = df.select(group_of(keys).alias(GROUP), F.struct(*[F.col(o) for o in order]).alias("__at"))
    total = narrow.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunk = rows_per_chunk or max(LEAST_ROWS, total // (CHUNKS_PER_TASK * tasks))
    if total <= chunk:
        return None
    sampled = narrow.where(F.rand(11) < min(1.0, SAMPLED / chunk))
    splits = F.transform(F.sequence(F.lit(SAMPLED - 1), F.size("__s") - 1, F.lit(SAMPLED)), lambda i: F.get("__s", i))
    hot = (
        sampled.groupBy(GROUP)
        .agg(F.array_sort(F.collect_list("__at")).alias("__s"))
        .where(F.size("__s") >= SAMPLED * 3 // 2)
        .select(GROUP, splits.alias("__splits"))
    )
    rows = []
    for group, found in hot.collect():  # a split a chunk at most
        side = max(1, math.isqrt(len(found)))
        rows.append((group, [(found[i], found[i + 1 : i + side]) for i in range(0, len(found), side)]))
    if not rows:
        return None
    at = narrow.schema["__at"].dataType
    block = T.StructType([T.StructField("first", at), T.StructField("more", T.ArrayType(at))])
    return spark.createDataFrame(rows, T.StructType([narrow.schema[GROUP], T.StructField("__blocks", T.ArrayType(block))]))


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], splits: DataFrame) -> DataFrame:
    """Rows with their group and chunk, a number that never decreases along the order; null for groups without splits."""
    at = F.struct(*[F.col(o) for o in order])
    below = F.size(F.filter("__blocks", lambda b: b["first"] <= at))
    inside = F.size(F.filter(F.get(F.col("__blocks"), below - 1)["more"], lambda s: s <= at))
    number = F.when(below > 0, below.cast("long") * 2**32 + inside).otherwise(F.lit(0))
    rows = df.withColumn(GROUP, group_of(keys)).join(F.broadcast(splits), GROUP, "left")  # a split a chunk at most
    return rows.withColumn(CHUNK, F.when(F.col("__blocks").isNotNull(), number)).drop("__blocks")


def plain_window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() for o in order])


def local_window(order: Sequence[str]):
    return Window.partitionBy(GROUP, CHUNK).orderBy(*[F.col(o).asc_nulls_first() for o in order])


def up_to_here(window):
    return window.rowsBetween(Window.unboundedPreceding, 0)


def across_chunks():
    return Window.partitionBy(GROUP).orderBy(CHUNK)


def chunk_summary(rows: DataFrame, aggs: Sequence[Column]) -> DataFrame:
    """One row per chunk of the hot groups; other groups have nothing to carry."""
    return rows.where(F.col(CHUNK).isNotNull()).groupBy(GROUP, CHUNK).agg(*aggs)


def attach_chunks(rows: DataFrame, summary: DataFrame) -> DataFrame:
    return rows.join(summary, [GROUP, CHUNK], "left").drop(GROUP, CHUNK)


def shift_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    shifts: dict[str, tuple[str, int]],
    rank: str | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """``lag`` / ``lead`` per group. ``shifts`` maps a new column to (column, offset): -1 is the previous row, 1 the
    next one. ``rank`` names a 1-based row number. ``order`` must be unique within a group for repeatable results. Eager.
    """
    moved = lambda w: {o: (F.lag(c, -n) if n < 0 else F.lead(c, n)).over(w) for o, (c, n) in shifts.items()}
    splits = hot_splits(df, keys, order, rows_per_chunk)
    if splits is None:
        w = plain_window(keys, order)
        return df.withColumns(moved(w) | ({rank: F.row_number().over(w).cast("long")} if rank else {}))

    span = max((abs(n) for _, n in shifts.values()), default=1)
    needed = sorted({c for c, _ in shifts.values()})
    w = local_window(order)
    rows = chunked(df, keys, order, splits)
    whole = Window.partitionBy(GROUP, CHUNK)
    marked = rows.withColumns({RN: F.row_number().over(w), "__n": F.count(F.lit(1)).over(whole)})

    edge = F.struct(F.col(RN).alias("rn"), *[F.col(c) for c in needed])
    summary = chunk_summary(
        marked,
        [
            F.count(F.lit(1)).alias("__rows"),
            F.array_sort(F.collect_list(F.when(F.col(RN) <= span, edge))).alias("__head"),
            F.array_sort(F.collect_list(F.when(F.col(RN) > F.col("__n") - span, edge))).alias("__tail"),
        ],
    )
    over = across_chunks()
    summary = summary.select(
        GROUP,
        CHUNK,
        F.coalesce(F.sum("__rows").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.flatten(F.collect_list("__tail").over(over.rowsBetween(-span, -1))).alias("__prev"),
        F.flatten(F.collect_list("__head").over(over.rowsBetween(1, span))).alias("__next"),
    )

    local = {f"__local_{out}": c for out, c in moved(w).items()}
    joined = attach_chunks(marked.withColumns(local), summary)
    final: dict[str, Column] = {}
    for out, (c, n) in shifts.items():
        if n < 0:
            at = F.size("__prev") - (F.lit(-n) - F.col(RN)) - 1
            outside, inside = F.when(at >= 0, F.get(F.col("__prev"), at)), F.col(RN) > -n
        else:
            at = F.lit(n) - (F.col("__n") - F.col(RN)) - 1
            outside, inside = F.get(F.col("__next"), at.cast("int")), F.col(RN) <= F.col("__n") - n
        final[out] = F.when(inside, F.col(f"__local_{out}")).otherwise(outside.getField(c))
    if rank:
        final[rank] = F.coalesce("__before", F.lit(0)) + F.col(RN)
    helpers = [RN, "__n", "__before", "__prev", "__next", *local]
    return joined.withColumns(final).drop(*helpers)


def number_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "row_no", rows_per_chunk: int | None = None
) -> DataFrame:
    """1-based row number per group (per table when ``keys`` is empty). Eager."""
    splits = hot_splits(df, keys, order, rows_per_chunk)
    if splits is None:
        return df.withColumn(out, F.row_number().over(plain_window(keys, order)).cast("long"))
    rows = chunked(df, keys, order, splits)
    counts = chunk_summary(rows, [F.count(F.lit(1)).alias("__rows")])
    before = counts.select(
        GROUP, CHUNK, F.sum("__rows").over(across_chunks().rowsBetween(Window.unboundedPreceding, -1)).alias("__before")
    )
    numbered = rows.withColumn(RN, F.row_number().over(local_window(order)))
    return attach_chunks(numbered, before).withColumn(out, F.coalesce("__before", F.lit(0)) + F.col(RN)).drop("__before", RN)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str], rows_per_chunk: int | None = None
) -> DataFrame:
    """Running totals per group in row order: ``{new column: summed column}``; nulls add nothing. Eager."""
    splits = hot_splits(df, keys, order, rows_per_chunk)
    if splits is None:
        w = up_to_here(plain_window(keys, order))
        return df.withColumns({out: F.sum(c).over(w) for out, c in columns.items()})
    rows = chunked(df, keys, order, splits)
    totals = chunk_summary(rows, [F.sum(c).alias(f"__sum_{out}") for out, c in columns.items()])
    earlier = across_chunks().rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(GROUP, CHUNK, *[F.sum(f"__sum_{out}").over(earlier).alias(f"__carry_{out}") for out in columns])
    running = up_to_here(local_window(order))
    summed = rows.withColumns({f"__run_{out}": F.sum(c).over(running) for out, c in columns.items()})
    both = lambda out: F.when(
        F.col(f"__run_{out}").isNotNull() | F.col(f"__carry_{out}").isNotNull(),
        F.coalesce(f"__run_{out}", F.lit(0)) + F.coalesce(f"__carry_{out}", F.lit(0)),
    )
    joined = attach_chunks(summed, carry).withColumns({out: both(out) for out in columns})
    return joined.drop(*[f"__{p}_{out}" for out in columns for p in ("run", "carry")])


def fill_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], rows_per_chunk: int | None = None
) -> DataFrame:
    """Replace nulls by the last earlier value of the same group (of the table when ``keys`` is empty). Eager."""
    splits = hot_splits(df, keys, order, rows_per_chunk)
    if splits is None:
        w = up_to_here(plain_window(keys, order))
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    rows = chunked(df, keys, order, splits).withColumn(RN, F.row_number().over(local_window(order)))
    last = chunk_summary(
        rows, [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(RN))).alias(f"__last_{c}") for c in columns]
    )
    earlier = across_chunks().rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(
        GROUP, CHUNK, *[F.last(f"__last_{c}", ignorenulls=True).over(earlier).alias(f"__carry_{c}") for c in columns]
    )
    running = up_to_here(local_window(order))
    filled = rows.withColumns({f"__fill_{c}": F.last(c, ignorenulls=True).over(running) for c in columns})
    joined = attach_chunks(filled, carry)
    return joined.withColumns({c: F.coalesce(f"__fill_{c}", f"__carry_{c}") for c in columns}).drop(
        RN, *[f"__fill_{c}" for c in columns], *[f"__carry_{c}" for c in columns]
    )


def ends_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first: dict[str, str], last: dict[str, str]
) -> DataFrame:
    """First and last values per group on every row: ``{new column: source column}``."""
    position = F.struct(*[F.col(o) for o in order])
    aggs = [F.min_by(c, position).alias(out) for out, c in first.items()]
    aggs += [F.max_by(c, position).alias(out) for out, c in last.items()]
    return attach_group(df, keys, aggs)
