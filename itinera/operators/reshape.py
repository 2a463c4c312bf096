"""Wide bookings to legs and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.functions import flights as fl
from itinera.functions.dates import try_timestamp
from itinera.functions.text import NULL_TOKENS_NAN, first_present, null_tokens
from itinera.spec import SourceSpec


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def slot_array(spec: SourceSpec) -> Column:
    """The raw slots of a row: an array of ``dt, slot, fn, dep, arr`` (date first, so that structs sort by date)."""
    return F.array(
        *[
            F.struct(
                _q(spec.date_names[i]).alias("dt"),
                F.lit(i + 1).alias("slot"),
                _q(spec.number_names[i]).alias("fn"),
                _q(spec.airport_names[i]).alias("dep"),
                _q(spec.airport_names[i + 1]).alias("arr"),
            )
            for i in range(spec.slots)
        ]
    )


def with_slots(df: DataFrame, spec: SourceSpec, out: str = "slots") -> DataFrame:
    """Add the array of normalised slots, each with its reject ``reason`` (null when valid).

    Normalised values are columns of their own before the checks read them: a rule text appears once in the plan
    however many checks use it.
    """
    rng = range(1, spec.slots + 1)
    values: dict[str, Column] = {}
    for i in rng:
        values[f"__fn{i}"] = spec.normalize(_q(spec.number_names[i - 1]))
        values[f"__dt{i}"] = try_timestamp(_q(spec.date_names[i - 1]))
    staged = df.withColumns(values)
    structs = [
        F.struct(
            F.col(f"__dt{i}").alias("dt"),
            F.lit(i).alias("slot"),
            F.col(f"__fn{i}").alias("fn"),
            _q(spec.airport_names[i - 1]).alias("dep"),
            _q(spec.airport_names[i]).alias("arr"),
            fl.flight_reject_reason(f"__fn{i}", f"__dt{i}", spec.rules).alias("reason"),
        )
        for i in rng
    ]
    return staged.withColumn(out, F.array(*structs)).drop(*values)


def legs_of(slots: Column | str) -> Column:
    """The valid slots without their reason, in slot order."""
    slots = F.col(slots) if isinstance(slots, str) else slots
    kept = F.filter(slots, lambda s: s["reason"].isNull())
    return F.transform(kept, lambda s: F.struct(*[s[f].alias(f) for f in ("dt", "slot", "fn", "dep", "arr")]))


def with_legs(df: DataFrame, spec: SourceSpec, out: str = "legs") -> DataFrame:
    """Add the array of the row's valid legs, normalised, in slot order."""
    return with_slots(df, spec, "__slots").withColumn(out, legs_of("__slots")).drop("__slots")


def unpivot_legs(df: DataFrame, spec: SourceSpec, carry: Sequence[str]) -> DataFrame:
    """One row per slot from a single scan: the carried columns plus the raw ``slot, fn, dt, dep, arr``."""
    rows = df.select(*[_q(c) for c in carry], F.inline(slot_array(spec)))
    return rows.select(*[_q(c) for c in carry], "slot", "fn", "dt", "dep", "arr")


def explode_routes(df: DataFrame, routes: Column, carry: Sequence[str]) -> DataFrame:
    """One row per route: the carried columns, ``route_no`` from 1 and ``route`` (array of leg structs)."""
    return df.select(*[_q(c) for c in carry], F.posexplode(routes).alias("__pos", "route")).select(
        *[_q(c) for c in carry], (F.col("__pos") + 1).alias("route_no"), "route"
    )


def route_legs(df: DataFrame, carry: Sequence[str], route: str = "route") -> DataFrame:
    """Leg rows of exploded routes with their position ``leg_no`` from 1."""
    return df.select(*[_q(c) for c in carry], F.posexplode(route).alias("__pos", "__leg")).select(
        *[_q(c) for c in carry],
        (F.col("__pos") + 1).alias("leg_no"),
        *[F.col(f"__leg.{f}").alias(f) for f in ("slot", "fn", "dt", "dep", "arr")],
    )


def widen_route(
    route: Column, n: int, number: str = "FlightNumber{}", date: str = "FlightDate{}",
    airports: Sequence[str] = (), departures_only: bool = False,
) -> dict[str, Column]:
    """A leg array to wide columns, truncated to ``n`` legs.

    The departure of leg k+1 takes the place of the arrival of leg k, even when it is null. ``departures_only``
    leaves the arrivals out, so the last airport column stays null.
    """
    names = list(airports) or [f"Airport{i}" for i in range(1, n + 2)]
    leg = lambda k: F.get(route, F.lit(k))
    out: dict[str, Column] = {}
    for k in range(n):
        out[number.format(k + 1)] = leg(k)["fn"]
    for k in range(n):
        out[date.format(k + 1)] = leg(k)["dt"]
    for k in range(n + 1):
        own = leg(k)["dep"] if k < n else F.lit(None).cast("string")
        if departures_only or k == 0:
            out[names[k]] = own
        elif k < n:
            out[names[k]] = F.when(F.size(route) > k, own).otherwise(leg(k - 1)["arr"])
        else:
            out[names[k]] = leg(k - 1)["arr"]
    return out


def pivot_route(
    df: DataFrame, keys: Sequence[str], seq: str, n: int, any_value: Sequence[str] = (),
    number: str = "FlightNumber{}", date: str = "DepartureDateLocal{}", airport: str = "Airport{}", overflow: bool = True,
) -> DataFrame:
    """Leg rows (``fn, dt, dep, arr`` and a position) to one wide row per key, without losing a leg.

    Airport 1 is the first departure, airport k+1 the arrival of leg k. ``any_value`` columns take the first
    non-null value in leg order, from all legs. ``leg_count`` counts all legs, and ``overflow_legs`` holds those past
    ``n`` in order, as an array of ``leg, fn, dt, dep, arr``. Without ``overflow`` there is no array, every state has a
    fixed width, and ``legs_past`` gives those legs as rows: the form for keys of any number of legs.
    """
    at = lambda k, c: F.max(F.when(F.col(seq) == k, F.col(c)))
    aggs = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in any_value]
    aggs += [at(k, "fn").alias(number.format(k)) for k in range(1, n + 1)]
    aggs += [at(k, "dt").alias(date.format(k)) for k in range(1, n + 1)]
    aggs.append(at(1, "dep").alias(airport.format(1)))
    aggs += [at(k, "arr").alias(airport.format(k + 1)) for k in range(1, n + 1)]
    aggs.append(F.count(F.lit(1)).alias("leg_count"))
    if overflow:
        past = F.when(F.col(seq) > n, F.struct(F.col(seq).alias("leg"), "fn", "dt", "dep", "arr"))  # nulls are not collected
        aggs.append(F.array_sort(F.collect_list(past)).alias("overflow_legs"))
    return df.groupBy(*keys).agg(*aggs)


def legs_past(df: DataFrame, keys: Sequence[str], seq: str, n: int) -> DataFrame:
    """The leg rows past position ``n``: the keys and ``leg, fn, dt, dep, arr``. No shuffle; a null position is no leg."""
    return df.filter(F.col(seq) > n).select(*[_q(c) for c in keys], F.col(seq).alias("leg"), "fn", "dt", "dep", "arr")


def legs_to_standard(
    df: DataFrame,
    slots: dict[int, tuple[str, str | None]],
    row_id: str,
    pax: Sequence[str] = ("PaxName", "PassengerName", "Name"),
    ticket: Sequence[str] = ("TicketNo", "TicketNumber", "ETicketNo"),
    booking: Sequence[str] = ("PNRNo", "PNR", "BookingRef"),
    carrier: Sequence[str] = ("IATA", "AirlineCode", "Airline"),
    airport: str = "Airport{}",
    file_name: Column | None = None,
    random_ids: bool = False,
) -> DataFrame:
    """Wide rows to the standard leg table.

    A slot becomes a leg when its flight number is present, its date parses and both airports are present. Legs of a
    row share a ConnectionID: by default a hash of ``row_id`` (repeatable), with ``random_ids`` a UUID.
    """
    have = {c.lower(): c for c in df.columns}
    column = lambda name: _q(have[name.lower()]) if name.lower() in have else F.lit(None).cast("string")
    structs = []
    for i, (number, date) in slots.items():
        raw = null_tokens(_q(number), NULL_TOKENS_NAN)
        structs.append(
            F.struct(
                F.lit(i).alias("slot"),
                F.upper(F.replace(raw, F.lit(" "), F.lit(""))).alias("fn"),
                (try_timestamp(_q(date)) if date else F.lit(None).cast("timestamp_ntz")).alias("dt"),
                F.upper(null_tokens(column(airport.format(i)), NULL_TOKENS_NAN)).alias("dep"),
                F.upper(null_tokens(column(airport.format(i + 1)), NULL_TOKENS_NAN)).alias("arr"),
            )
        )
    legs = F.filter(
        F.array(*structs), lambda s: reduce(and_, [s[f].isNotNull() for f in ("fn", "dt", "dep", "arr")])
    )
    connection = F.uuid() if random_ids else F.sha2(F.col(row_id).cast("string"), 256)
    head = df.select(
        connection.alias("ConnectionID"),
        F.coalesce(first_present(df, *pax), F.lit("")).alias("PaxName"),
        F.coalesce(first_present(df, *ticket), F.lit("")).alias("ETicketNo"),
        first_present(df, *booking).alias("BookingRef"),
        F.upper(first_present(df, *carrier)).alias("__carrier"),
        (file_name if file_name is not None else F.lit(None).cast("string")).alias("FileName"),
        legs.alias("__legs"),
    )
    rows = head.select("*", F.try_element_at("__legs", F.lit(-1))["arr"].alias("LastLegAirport"), F.inline("__legs"))
    leg_id = F.uuid() if random_ids else F.sha2(F.concat_ws("-", "ConnectionID", F.col("slot").cast("string")), 256)
    nothing = F.lit(None).cast("string")
    return rows.select(
        leg_id.alias("Id"),
        "ConnectionID",
        "PaxName",
        nothing.alias("AgencyRefNumber"),
        "ETicketNo",
        F.col("fn").alias("FlightNumber"),
        F.col("dt").alias("DepartureDate"),
        "FileName",
        "BookingRef",
        F.coalesce("__carrier", fl.carrier_of("fn")).alias("AirlineCode"),
        F.col("dep").alias("FromAirport"),
        F.col("arr").alias("ToAirport"),
        "LastLegAirport",
        F.lit(0).alias("EUEligibleDuration"),
        nothing.alias("ExtraNote"),
        F.lit(False).alias("FlightFound"),
        F.col("slot").alias("LegNo"),
    )


def parse_counters(df: DataFrame, slots: dict[int, tuple[str, str | None]], airport: str = "Airport{}") -> DataFrame:
    """One row of counts over all slots: rows, no flight number, bad date, missing airport, good legs."""
    have = {c.lower(): c for c in df.columns}
    column = lambda name: _q(have[name.lower()]) if name.lower() in have else F.lit(None).cast("string")
    tests = []
    for i, (number, date) in slots.items():
        no_number = null_tokens(_q(number), NULL_TOKENS_NAN).isNull()
        bad_date = try_timestamp(_q(date)).isNull() if date else F.lit(True)
        gap = (
            null_tokens(column(airport.format(i)), NULL_TOKENS_NAN).isNull()
            | null_tokens(column(airport.format(i + 1)), NULL_TOKENS_NAN).isNull()
        )
        tests.append(
            F.when(no_number, "no_flight_number")
            .when(bad_date, "invalid_date")
            .when(gap, "missing_airport")
            .otherwise("successful_legs")
        )
    outcome = F.array(*tests)
    count = lambda label: F.sum(F.size(F.filter(outcome, lambda o: o == label))).alias(label)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[count(x) for x in ("no_flight_number", "invalid_date", "missing_airport", "successful_legs")],
    )


def _split_rows(df: DataFrame, matches: Column, variants: Sequence[dict[str, Column]]) -> DataFrame:
    """Replace matching rows by one row per variant and keep the others, in one pass over the input."""
    full = lambda change: F.struct(*[change.get(c, _q(c)).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    same = F.array(full({}))
    split = F.array(*[full(v) for v in variants])
    return df.select(F.inline(F.when(F.coalesce(matches, F.lit(False)), split).otherwise(same)))


def _single_leg(spec: SourceSpec, leg: int) -> dict[str, Column]:
    """Column changes that leave only one leg, moved to slot 1."""
    out: dict[str, Column] = {}
    for i in range(spec.slots):
        out[spec.number_names[i]] = _q(spec.number_names[leg - 1]) if i == 0 else F.lit(None)
        out[spec.date_names[i]] = _q(spec.date_names[leg - 1]) if i == 0 else F.lit(None)
    for i in range(spec.slots + 1):
        out[spec.airport_names[i]] = _q(spec.airport_names[leg - 1 + i]) if i < 2 else F.lit(None)
    return out


def is_round_trip(spec: SourceSpec) -> Column:
    a = [_q(n) for n in spec.airport_names]
    return (a[0] == a[2]) & a[3].isNull() & a[4].isNull()


def split_round_trip(df: DataFrame, spec: SourceSpec, direction: str) -> DataFrame:
    """Two-leg returns become an OUTBOUND and an INBOUND row; other rows stay."""
    return _split_rows(
        df,
        is_round_trip(spec),
        [
            {**_single_leg(spec, 1), direction: F.lit("OUTBOUND")},
            {**_single_leg(spec, 2), direction: F.lit("INBOUND")},
        ],
    )


def split_connections(df: DataFrame, spec: SourceSpec, first_two: bool = False, dropped: str | None = None) -> DataFrame:
    """Rows with three airports become one row for each leg, moved to slot 1; other rows stay.

    A later slot is a leg if it has a flight number, a date or an airport behind it; the first two always are.
    ``first_two`` keeps only those two; ``dropped`` names a column with the number of legs that this leaves out.
    """
    a = [_q(n) for n in spec.airport_names]
    matches = F.coalesce(a[0].isNotNull() & a[1].isNotNull() & a[2].isNotNull(), F.lit(False))
    full = lambda change: F.struct(*[change.get(c, _q(c)).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    present = [
        reduce(or_, [_q(spec.number_names[i]).isNotNull(), _q(spec.date_names[i]).isNotNull(), a[i + 1].isNotNull()])
        for i in range(spec.slots)
    ]
    legs = F.array(*[full(_single_leg(spec, i + 1)) if i < 2 else F.when(present[i], full(_single_leg(spec, i + 1))) for i in range(spec.slots)])
    legs = F.filter(legs, lambda leg: leg.isNotNull())
    split = F.slice(legs, 1, 2) if first_two else legs
    gone = F.when(matches, F.size(legs) - F.size(split)).otherwise(0)
    rows = F.inline(F.when(matches, split).otherwise(F.array(full({}))))
    return df.select(*([gone.alias(dropped)] if dropped else []), rows)
