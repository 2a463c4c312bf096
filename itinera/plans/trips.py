"""Trip reconstruction across all rows of a booking."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.functions.dates import normalize_date
from itinera.functions.flights import is_placeholder_flight, normalize_flight_keep_digit
from itinera.operators.dedupe import collapse_consecutive, dedupe_dates, dedupe_pairs, keep_first
from itinera.operators.filters import non_blank, usable_leg
from itinera.operators.reshape import explode_routes, legs_past, pivot_route, unpivot_legs, widen_route, with_legs
from itinera.operators.segment import HOUR, routes_gap, trips_gap
from itinera.session import scratch_path
from itinera.spec import SourceSpec


def usable_legs(
    df: DataFrame, spec: SourceSpec, carry: Sequence[str], placeholder: str = "carrier_zeros"
) -> DataFrame:
    """Leg rows with a flight number, a date in range and no placeholder number (tested on the raw value)."""
    legs = unpivot_legs(df, spec, carry).filter(non_blank("fn"))
    legs = legs.withColumns(
        {
            "__raw": F.col("fn"),
            "fn": spec.normalize(F.col("fn")),
            "dt": normalize_date("dt", spec.year_min, spec.year_max),
        }
    )
    return legs.filter(usable_leg("fn", "dt", is_placeholder_flight("__raw", placeholder))).drop("__raw")


def clean_leg_rows(
    legs: DataFrame, year_min: int, year_max: int, placeholder: str = "carrier_zeros", number: str = "fn", date: str = "dt"
) -> DataFrame:
    """The same cleaning for input that is already one row per leg."""
    rows = legs.filter(non_blank(number)).withColumns(
        {
            "__raw": F.col(number),
            number: normalize_flight_keep_digit(number),
            date: normalize_date(date, year_min, year_max),
        }
    )
    return rows.filter(usable_leg(number, date, is_placeholder_flight("__raw", placeholder))).drop("__raw")


def trips_of_legs(
    legs: DataFrame,
    keys: Sequence[str],
    tie: Sequence[str],
    by: str = "date",
    gap_seconds: int = 36 * HOUR,
    break_on_backward: bool = False,
    bounded_keys: bool = False,
) -> DataFrame:
    """Legs (``fn, dt, dep, arr, slot``) deduplicated per (keys, dt) and numbered by trip and position.

    ``by`` orders legs by ``date`` or by ``slot`` (slot numbers of all rows of the booking side by side). ``tie``
    columns make the order total.
    """
    kept = keep_first(legs, [*keys, "dt"], ["slot", *tie])
    order = ("dt", "slot", *tie) if by == "date" else ("slot", "dt", *tie)
    # before duplicates go, groups are no smaller, and measuring them takes no shuffle of rows
    return trips_gap(kept, keys, "dt", order, gap_seconds, break_on_backward, bounded_keys=bounded_keys, sizes_from=legs)


def reconstruct_trips(
    legs: DataFrame,
    keys: Sequence[str],
    tie: Sequence[str],
    slots: int,
    any_value: Sequence[str] = (),
    null_columns: Sequence[str] = (),
    by: str = "date",
    gap_seconds: int = 36 * HOUR,
    break_on_backward: bool = False,
    bounded_keys: bool = False,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Cleaned leg rows to one wide row per trip. ``null_columns`` are text columns that always come out null."""
    trips = trips_of_legs(legs, keys, tie, by, gap_seconds, break_on_backward, bounded_keys)
    wide = pivot_route(trips, [*keys, "trip_id"], "leg_no", slots, any_value, **(names or {}))
    empty: dict[str, Column] = {c: F.lit(None).cast("string") for c in null_columns}
    return wide.withColumns(empty) if empty else wide


def reconstruct_trips_and_legs(
    legs: DataFrame,
    keys: Sequence[str],
    tie: Sequence[str],
    slots: int,
    any_value: Sequence[str] = (),
    names: dict[str, str] | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Wide trips as ``reconstruct_trips`` without arrays, and the legs past the last slot as rows of their own.

    For keys that may hold any number of legs: no row and no group's state grows with a trip. The second frame has the
    keys, ``trip_id`` and ``leg, fn, dt, dep, arr``. Eager: numbered legs are stored once, as both frames read them.
    """
    path = scratch_path(legs.sparkSession, "trips")
    numbered, by = trips_of_legs(legs, keys, tie, **options), [*keys, "trip_id"]
    numbered.write.parquet(path)
    trips = legs.sparkSession.read.schema(numbered.schema).parquet(path)
    return pivot_route(trips, by, "leg_no", slots, any_value, overflow=False, **(names or {})), legs_past(trips, by, "leg_no", slots)


def reconstruct_bookings(
    df: DataFrame, spec: SourceSpec, row_id: str, booking: str, pax: str, any_value: Sequence[str] = (),
    null_columns: Sequence[str] = (), placeholder: str = "carrier_zeros", **options,
) -> DataFrame:
    """Wide booking rows to wide trip rows."""
    legs = usable_legs(df, spec, [row_id, booking, pax, *any_value], placeholder)
    names = {"number": spec.number, "date": spec.date}
    return reconstruct_trips(
        legs, [booking, pax], [row_id], spec.slots, any_value, null_columns, names=names, **options
    )


# How equal legs of a row are found before its routes are cut.
ROW_DEDUPE: dict[str, Callable[[Column], Column]] = {"pairs": dedupe_pairs, "dates": dedupe_dates, "consecutive": collapse_consecutive}


def distinct_in_route(route: Column) -> Column:
    """A route's legs without later ones of the same flight number and date."""
    return dedupe_pairs(route)


def reconstruct_rowwise(
    df: DataFrame,
    spec: SourceSpec,
    row_id: str,
    carry: Sequence[str] = (),
    routes: Callable[[Column], Column] = routes_gap,
    dedupe: str = "pairs",
    departures_only: bool = True,
) -> DataFrame:
    """Trips inside each row: valid legs in slot order, equal ones out, routes by gap, one wide row a route.

    No shuffle. A route has at most as many legs as its row has slots, so nothing overflows. Columns: the row id, the
    carried columns, ``route_no``, ``leg_count`` and the slot columns of the spec.
    """
    legs = with_legs(df, spec, "__legs").withColumn("__legs", ROW_DEDUPE[dedupe]("__legs"))
    rows = explode_routes(legs, routes(F.col("__legs")), [row_id, *carry]).withColumn("route", distinct_in_route(F.col("route")))
    wide = widen_route(F.col("route"), spec.slots, spec.number, spec.date, spec.airport_names, departures_only)
    return rows.select(row_id, *carry, "route_no", F.size("route").alias("leg_count"), *[c.alias(n) for n, c in wide.items()])
