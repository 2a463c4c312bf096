"""Row predicates and group-level filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.functions.text import as_column
from itinera.operators.grouped import group_summary, join_on


def _bounds(year_min: int, year_max: int) -> tuple[Column, Column]:
    low = F.lit(f"{year_min}-01-01 00:00:00").cast("timestamp_ntz")
    high = F.lit(f"{year_max}-12-31 00:00:00").cast("timestamp_ntz")
    return low, high


def any_slot_in_range(dates: Sequence[Column], year_min: int, year_max: int) -> Column:
    """True when any slot date lies between January 1st and December 31st 00:00; false when none does."""
    low, high = _bounds(year_min, year_max)
    return reduce(or_, [F.coalesce(d.between(low, high), F.lit(False)) for d in dates])


def no_slot_in_range(dates: Sequence[Column], year_min: int, year_max: int, legacy_nulls: bool = False) -> Column:
    """The complement. ``legacy_nulls`` keeps three-valued logic, so an undecided row is in neither set."""
    if not legacy_nulls:
        return ~any_slot_in_range(dates, year_min, year_max)
    low, high = _bounds(year_min, year_max)
    return ~reduce(or_, [d.between(low, high) for d in dates])


def non_blank(c: Column | str) -> Column:
    return F.coalesce(F.trim(as_column(c)) != "", F.lit(False))


def usable_leg(number: Column | str, date: Column | str, placeholder: Column) -> Column:
    """Both values present and not a placeholder."""
    return as_column(number).isNotNull() & as_column(date).isNotNull() & ~F.coalesce(placeholder, F.lit(False))


def row_mask(numbers: Sequence[Column], dates: Sequence[Column]) -> Column:
    """Rows with at least one number and one date and no number that ends in ``000`` (drops the whole row)."""
    some_number = reduce(or_, [n.isNotNull() for n in numbers])
    some_date = reduce(or_, [d.isNotNull() for d in dates])
    no_zeros = reduce(and_, [~F.coalesce(n.endswith("000"), F.lit(False)) for n in numbers])
    return some_number & some_date & no_zeros


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.dropna("any", subset=list(columns) if columns else None)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Keep the rows where the predicate is not true (an undecided row stays)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def complete_groups(df: DataFrame, keys: Sequence[str], holds: Column) -> DataFrame:
    """Drop every group in which any row fails; rows with a null key go too, as they belong to no group."""
    known = df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    failing = known.filter(~F.coalesce(holds, F.lit(False)))
    bad = group_summary(failing, keys, [F.count(F.lit(1)).alias("__bad")]).select(*keys)
    return join_on(known, bad, keys, "left_anti")


def not_in_values(c: Column | str, values: Sequence[str]) -> Column:
    """``NOT IN`` with SQL nulls: a null value is excluded as well."""
    return ~as_column(c).isin(list(values))
