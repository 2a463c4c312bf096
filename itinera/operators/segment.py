"""Journey segmentation: legs to routes (inside a row) and rows to trips (inside a booking)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itinera.functions.dates import micros_between
from itinera.operators.grouped import (
    CHUNK,
    GROUP,
    RN,
    across_chunks,
    attach_chunks,
    chunk_summary,
    chunked,
    hot_splits,
    local_window,
    up_to_here,
)

Same = Callable[[Column, Column, Column], Column]
HOUR = 3600
DAY_MICROS = 86_400_000_000


def fold_routes(legs: Column, same: Same) -> Column:
    """Cut an array of leg structs into an array of routes.

    ``same(first, previous, current)`` says whether a leg joins the open route; null counts as no.
    """
    none = F.slice(legs, 1, 0)
    zero = F.struct(F.slice(F.array(none), 1, 0).alias("done"), none.alias("open"))

    def step(acc: Column, leg: Column) -> Column:
        done, route = acc["done"], acc["open"]
        joins = F.coalesce(same(F.get(route, F.lit(0)), F.try_element_at(route, F.lit(-1)), leg), F.lit(False))
        empty = F.size(route) == 0
        return F.struct(
            F.when(empty | joins, done).otherwise(F.concat(done, F.array(route))).alias("done"),
            F.when(empty | ~joins, F.array(leg)).otherwise(F.concat(route, F.array(leg))).alias("open"),
        )

    return F.aggregate(
        legs,
        zero,
        step,
        lambda acc: F.when(F.size(acc["open"]) == 0, acc["done"]).otherwise(
            F.concat(acc["done"], F.array(acc["open"]))
        ),
    )


def by_time(legs: Column) -> Column:
    """Legs by date, slot order breaking ties. The structs must start with ``dt`` and ``slot``."""
    return F.sort_array(legs)  # as array_sort where no leg is null, without its comparator


def routes_anchored(legs: Column, max_seconds: int = 24 * HOUR) -> Column:
    """A leg joins while it lies within ``max_seconds`` of the route's first leg."""
    near = lambda first, leg: F.abs(micros_between(first["dt"], leg["dt"])) <= max_seconds * 1_000_000
    # most rows are one route, which needs no fold
    one = F.forall(legs, lambda leg: F.coalesce(near(F.get(legs, F.lit(0)), leg), F.lit(False)))
    folded = fold_routes(legs, lambda first, prev, leg: near(first, leg))
    return F.when((F.size(legs) > 0) & one, F.array(legs)).otherwise(folded)


def routes_gap(legs: Column, max_seconds: int = 36 * HOUR) -> Column:
    """A leg joins while it lies within ``max_seconds`` of the leg before it."""
    return fold_routes(
        legs, lambda first, prev, leg: F.abs(micros_between(prev["dt"], leg["dt"])) <= max_seconds * 1_000_000
    )


def routes_gap_days(legs: Column, max_days: int = 1) -> Column:
    """As :func:`routes_gap` in whole days rounded down (47:59 later joins, 24:01 earlier does not)."""
    return fold_routes(
        legs,
        lambda first, prev, leg: F.abs(F.floor(micros_between(prev["dt"], leg["dt"]) / F.lit(DAY_MICROS))) <= max_days,
    )


def _breaks(prev: Column, current: Column, gap_seconds: int, on_backward: bool) -> Column:
    """1 where a trip starts: no previous time, too long a gap or (optionally) a step back in time."""
    gap = micros_between(prev, current)
    start = F.when(prev.isNull(), 1).when(gap > gap_seconds * 1_000_000, 1)
    if on_backward:
        start = start.when(gap < 0, 1)
    return start.otherwise(0)


def trips_gap(
    df: DataFrame,
    keys: Sequence[str],
    when: str,
    order: Sequence[str],
    gap_seconds: int = 36 * HOUR,
    break_on_backward: bool = False,
    trip: str = "trip_id",
    leg: str | None = "leg_no",
    rows_per_chunk: int | None = None,
    bounded_keys: bool = False,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Number the trips of every key group, across all its rows.

    A new trip starts where the time since the row before exceeds the gap. ``order`` must be unique within a group.
    Hot groups are cut into chunks (see :mod:`itinera.operators.grouped`; eager), so a blank booking reference that
    holds a third of the rows still runs in parallel; without hot groups it is one shuffle and plain windows.
    ``bounded_keys=True`` is for data whose groups are known to be small and measures nothing. ``sizes_from`` may name rows
    that are cheaper to measure, with the same columns and no smaller groups. Select the columns you need first: they
    travel with the rows.
    """
    splits = None if bounded_keys else hot_splits(df if sizes_from is None else sizes_from, keys, order, rows_per_chunk)
    if splits is None:
        return _trips_plain(df, keys, when, order, gap_seconds, break_on_backward, trip, leg)

    w = local_window(order)
    running = up_to_here(w)
    rows = chunked(df, keys, order, splits).withColumn(RN, F.row_number().over(w))
    rows = rows.withColumn("__prev", F.lag(when).over(w)).withColumn(
        "__brk", F.when(F.col(RN) > 1, _breaks(F.col("__prev"), F.col(when), gap_seconds, break_on_backward)).otherwise(0)
    )
    at_break = F.when(F.col("__brk") == 1, F.col(RN))

    sums = chunk_summary(
        rows,
        [
            F.max(F.when(F.col(RN) == 1, F.col(when))).alias("__first"),
            F.max_by(when, RN).alias("__last"),
            F.sum("__brk").alias("__inner"),
            F.count(F.lit(1)).alias("__rows"),
            F.max(at_break).alias("__last_break"),
        ],
    )
    over = across_chunks()
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(
        "__head", _breaks(F.lag("__last").over(over), F.col("__first"), gap_seconds, break_on_backward)
    ).withColumn("__starts", F.col("__inner") + F.col("__head"))
    sums = sums.withColumns(
        {
            "__before": F.coalesce(F.sum("__starts").over(earlier), F.lit(0)),
            "__seg": F.sum(F.when(F.col("__starts") > 0, 1).otherwise(0)).over(
                over.rowsBetween(Window.unboundedPreceding, 0)
            ),
            # rows of this chunk that belong to the trip still open at its end
            "__tail": F.when(F.col("__inner") > 0, F.col("__rows") - F.col("__last_break") + 1).otherwise(
                F.col("__rows")
            ),
        }
    )
    per_seg = Window.partitionBy(GROUP, "__seg").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("__open", F.sum("__tail").over(per_seg))
    carry = sums.select(
        GROUP,
        CHUNK,
        (F.col("__before") + F.col("__head")).alias("__base"),
        F.when(F.col("__head") == 1, F.lit(0)).otherwise(F.coalesce(F.lag("__open").over(over), F.lit(0))).alias(
            "__carry"
        ),
    )

    rows = rows.withColumns(
        {"__runs": F.sum("__brk").over(running), "__since": F.max(at_break).over(running)}
    )
    # groups without chunks have no carry: their first row starts trip 1
    out = attach_chunks(rows, carry).withColumn(trip, F.coalesce("__base", F.lit(1)) + F.col("__runs"))
    if leg:
        out = out.withColumn(
            leg,
            F.when(F.col("__runs") == 0, F.coalesce("__carry", F.lit(0)) + F.col(RN)).otherwise(
                F.col(RN) - F.col("__since") + F.lit(1)
            ),
        )
    return out.drop(RN, "__prev", "__brk", "__runs", "__since", "__base", "__carry")


def _trips_plain(df, keys, when, order, gap_seconds, break_on_backward, trip, leg) -> DataFrame:
    ordering = [F.col(o).asc_nulls_first() for o in order]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    out = df.withColumn("__prev", F.lag(when).over(w)).withColumn(
        trip,
        F.sum(_breaks(F.col("__prev"), F.col(when), gap_seconds, break_on_backward)).over(
            w.rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    if leg:
        out = out.withColumn(leg, F.row_number().over(Window.partitionBy(*keys, trip).orderBy(*ordering)).cast("long"))
    return out.drop("__prev")
