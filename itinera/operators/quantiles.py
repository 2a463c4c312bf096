"""Exact quantiles of any number of ranks in three passes; no task sorts the column, and only answers leave.

1. A mergeable sketch brackets every rank: its error is known, so a bracket a little wider than it holds the rank.
2. Brackets and the gaps between them cut the values into segments. Their exact counts place each rank in its bracket, and a
   sketch per bracket cuts that into cells.
3. Of the cells that hold ranks the distinct values are counted, and running counts over them meet the ranks.

Exact counts check each bracket and cell; should a sketch have missed, the bracket is widened and counted again.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The sketches err by at most one in so many ranks; values that a sketch gives for each bracket.
ACCURACY, CELLS = 10_000, 2_000

Bracket = tuple[float, float]


def _sketch(value: str, accuracy: int, cells: int) -> Column:
    points = ",".join(f"{i / cells}D" for i in range(cells + 1))
    return F.expr(f"percentile_approx({value}, array({points}), {accuracy})")


def _around(ends: Sequence[float], rank: int, n: int, lo: float, hi: float, accuracy: int) -> Bracket:
    """Values between which the rank of n values lies, two errors of the sketch wide; everything if there are few."""
    if n <= accuracy or lo == hi:
        return lo, hi
    cells = len(ends) - 1
    at, slack = rank / n * cells, 2 * cells / accuracy + 1
    low, high = math.floor(at - slack), math.ceil(at + slack)
    return (lo if low <= 0 else ends[low]), (hi if high >= cells else ends[high])


def _disjoint(brackets: Sequence[Bracket]) -> list[Bracket]:
    out: list[Bracket] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _segment(brackets: Sequence[Bracket]) -> Column:
    """Number of a value's segment in value order: odd ones are brackets, even ones the gaps before and after."""
    begun = F.size(F.filter(F.lit([lo for lo, _ in brackets]), lambda e: e <= F.col("v")))
    ended = F.size(F.filter(F.lit([hi for _, hi in brackets]), lambda e: e < F.col("v")))
    return begun + ended


def exact_ranks(df: DataFrame, column: str, ranks_of: Callable[[int], Sequence[int]], accuracy: int = ACCURACY, cells: int = CELLS) -> dict[int, float]:
    """{rank: value} of the sorted non-null column; ``ranks_of`` names the 0-based ranks wanted of so many values. Eager."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    n, least, most, ends = values.agg(F.count(F.lit(1)), F.min("v"), F.max("v"), _sketch("v", accuracy, cells)).first()
    if not n:
        return {}
    ranks = sorted(set(ranks_of(n)))
    brackets = _disjoint([_around(ends, r, n, least, most, accuracy) for r in ranks])

    while True:
        inner = F.when(F.col("s") % 2 == 1, F.col("v")).alias("inner")
        counted = values.withColumn("s", _segment(brackets)).select("s", inner).groupBy("s")
        found = {r["s"]: r for r in counted.agg(F.count(F.lit(1)).alias("n"), _sketch("inner", accuracy, cells).alias("ends")).collect()}
        before = [0]  # rows before each segment
        for s in range(2 * len(brackets) + 1):
            before.append(before[-1] + (found[s]["n"] if s in found else 0))
        place = {r: bisect_right(before, r) - 1 for r in ranks}
        missed = [s for s in place.values() if s % 2 == 0]
        if not missed:
            break
        ends_of = [least, *[x for pair in brackets for x in pair], most]
        brackets = _disjoint([*brackets, *[(ends_of[s], ends_of[s + 1]) for s in missed]])

    inside = []
    for r, s in place.items():
        lo, hi = brackets[s // 2]
        inside.append(_around(found[s]["ends"], r - before[s], found[s]["n"], lo, hi, accuracy))
    picked = _picked(values, brackets, _disjoint(inside), before, ranks)
    if len(picked) < len(ranks):  # a cell missed: count all values of the brackets
        picked = _picked(values, brackets, brackets, before, ranks)
    return picked


def _picked(values: DataFrame, brackets: list[Bracket], cells: list[Bracket], before: list[int], ranks: list[int]) -> dict[int, float]:
    """Running counts over the distinct values of the cells; what lies between cells of a bracket counts as one value."""
    rows = values.withColumn("s", _segment(brackets)).where("s % 2 = 1").withColumn("t", _segment(cells))
    rows = rows.select("s", "t", F.when(F.col("t") % 2 == 1, F.col("v")).alias("v"))
    counts = rows.groupBy("s", "t", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("s").orderBy("t", "v").rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.withColumn("to", upto + F.get(F.lit(before), F.col("s")))
    hits = F.filter(F.lit(ranks), lambda r: (r >= F.col("to") - F.col("n")) & (r < F.col("to")))
    answers = counts.select("v", F.explode(hits).alias("rank")).where("v is not null")
    return {r["rank"]: r["v"] for r in answers.collect()}  # a row a rank


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = ACCURACY, cells: int = CELLS
) -> list[float | None]:
    """Linearly interpolated quantiles of the non-null values. Eager: three passes, however many there are."""
    total = 0

    def ranks_of(n: int) -> list[int]:
        nonlocal total
        total = n
        low = [math.floor(p * (n - 1)) for p in probabilities]
        return low + [min(x + 1, n - 1) for x in low]

    values = exact_ranks(df, column, ranks_of, accuracy, cells)
    if not values:
        return [None for _ in probabilities]
    out = []
    for p in probabilities:
        x = p * (total - 1)
        low = values[math.floor(x)]
        high = values[min(math.floor(x) + 1, total - 1)]
        out.append(low + (high - low) * (x - math.floor(x)))
    return out


def quantile_clip(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str, low: float = 0.001, high: float = 0.999,
    out: str | None = None,
) -> DataFrame:
    """Clip a column to two exact quantiles of another column; nulls stay null."""
    lo, hi = exact_quantiles(reference, reference_column, [low, high])
    if lo is None:
        return df.withColumn(out or column, F.col(column))
    clipped = F.when(F.col(column) < lo, F.lit(lo)).when(F.col(column) > hi, F.lit(hi)).otherwise(F.col(column).cast("double"))
    return df.withColumn(out or column, clipped)
