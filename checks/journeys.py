"""Reshape, segmentation and deduplication queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import ANCHORED, LEGS, oracle, sql_c4, sql_date, sql_fold, sql_ts
from checks.registry import Data, plain, query
from itinera.functions.dates import try_timestamp
from itinera.functions.flights import STRICT, is_placeholder_flight
from itinera.functions.chains import explode_list
from itinera.operators import dedupe, filters
from itinera.operators.grouped import number_within, shift_within
from itinera.operators.layout import concat_flagged, split_flagged
from itinera.operators.reshape import (
    explode_routes,
    legs_to_standard,
    parse_counters,
    legs_past,
    pivot_route,
    route_legs,
    split_connections,
    split_round_trip,
    unpivot_legs,
    widen_route,
    with_legs,
)
from itinera.operators.segment import by_time, routes_anchored, routes_gap, routes_gap_days, trips_gap
from itinera.plans.trips import clean_leg_rows, reconstruct_bookings, reconstruct_rowwise, reconstruct_trips, reconstruct_trips_and_legs, trips_of_legs
from itinera.spec import SourceSpec, letters

# The booking view as a six-slot source; order dates run 1995-2001, so the range leaves rows out on both sides.
BOOKING = SourceSpec(
    "booking_view",
    ("booking_ref", "pax_name"),
    6,
    number="flight{}",
    date="date{}",
    airport="airport{}",
    normalize=letters,
    rules=STRICT,
    year_min=1996,
    year_max=2000,
    key=("booking_ref", "flight1", "airport1"),
    target_key=("booking_ref", "pax_name", "flight1", "date1", "airport1", "airport2", "flight2", "date2"),
)
SIX = range(1, 7)
LEG_COLUMNS = "row_id, route_no, leg_no, slot, fn, CAST(dt AS VARCHAR) AS dt, dep, arr"


def _legs(d: Data, sort: bool = False) -> DataFrame:
    rows = with_legs(d.view("v_booking"), BOOKING)
    return rows.withColumn("legs", by_time(F.col("legs"))) if sort else rows


def _routes(d: Data, routes, sort: bool = False) -> DataFrame:
    rows = explode_routes(_legs(d, sort), routes(F.col("legs")), ["row_id"])
    return plain(route_legs(rows, ["row_id", "route_no"]))


@query(
    "r1_unpivot_legs",
    oracle(
        "v_booking",
        " UNION ALL ".join(
            f"SELECT row_id, booking_ref, CAST({i} AS BIGINT) AS slot, flight{i} AS fn, date{i} AS dt, airport{i} AS dep, "
            f"airport{i + 1} AS arr FROM v_booking WHERE trim(flight{i}) <> ''"
            for i in SIX
        ),
    ),
)
def r1(d: Data) -> DataFrame:
    legs = unpivot_legs(d.view("v_booking"), BOOKING, ["row_id", "booking_ref"])
    return plain(legs.filter(filters.non_blank("fn")))


@query(
    "j1_routes_anchored",
    oracle("v_booking", f"WITH {LEGS}, {sql_fold('legs', 'dt, slot', ANCHORED)} SELECT {LEG_COLUMNS} FROM routed", True),
)
def j1(d: Data) -> DataFrame:
    return _routes(d, routes_anchored, True)


@query(
    "j3_routes_gap_row",
    oracle(
        "v_booking",
        f"WITH {LEGS}, {sql_fold('legs', 'slot', 'abs(epoch(o.dt) - epoch(f.dt)) <= 129600')} SELECT {LEG_COLUMNS} FROM routed",
        True,
    ),
)
def j3(d: Data) -> DataFrame:
    return _routes(d, routes_gap)


@query(
    "j4_routes_gap_days",
    oracle(
        "v_booking",
        f"WITH {LEGS}, {sql_fold('legs', 'slot', 'abs(floor((epoch(o.dt) - epoch(f.dt)) / 86400)) <= 1')} "
        f"SELECT {LEG_COLUMNS} FROM routed",
        True,
    ),
)
def j4(d: Data) -> DataFrame:
    return _routes(d, routes_gap_days)


def _dedupe_sql(key: str, order: str) -> str:
    return oracle(
        "v_booking",
        f"WITH {LEGS}, r AS (SELECT *, row_number() OVER (PARTITION BY row_id, {key} ORDER BY {order}) AS rn FROM legs) "
        "SELECT row_id, CAST(slot AS BIGINT) AS slot, fn, CAST(dt AS VARCHAR) AS dt FROM r WHERE rn = 1",
    )


def _leg_rows(d: Data, keep, sort: bool = False) -> DataFrame:
    rows = _legs(d, sort).select("row_id", F.inline(keep(F.col("legs"))))
    return plain(rows.select("row_id", "slot", "fn", "dt"))


@query("d1_dedupe_segments_row", _dedupe_sql("fn, CAST(dt AS DATE)", "dt, slot"))
def d1(d: Data) -> DataFrame:
    return _leg_rows(d, dedupe.dedupe_segments, True)


@query("d3_dedupe_dates_row", _dedupe_sql("dt", "slot"))
def d3(d: Data) -> DataFrame:
    return _leg_rows(d, dedupe.dedupe_dates)


@query("d4_dedupe_raw_pairs", _dedupe_sql("fn, dt", "slot"))
def d4(d: Data) -> DataFrame:
    return _leg_rows(d, dedupe.dedupe_pairs)


@query(
    "d5_collapse_consecutive",
    oracle(
        "v_booking",
        f"""WITH {LEGS}, c AS (SELECT *, lag(fn) OVER w AS pf, lag(dt) OVER w AS pd, row_number() OVER w AS n FROM legs
  WINDOW w AS (PARTITION BY row_id ORDER BY slot))
SELECT row_id, CAST(slot AS BIGINT) AS slot, fn, CAST(dt AS VARCHAR) AS dt FROM c
WHERE n = 1 OR NOT (pf IS NOT DISTINCT FROM fn AND pd IS NOT DISTINCT FROM dt)""",
    ),
)
def d5(d: Data) -> DataFrame:
    return _leg_rows(d, dedupe.collapse_consecutive)


def _rowwise_sql(dedupe: str, same: str) -> str:
    """Legs in slot order, equal ones out, routes by gap, equal ones of a route out, departures only."""
    wide = ", ".join(
        [f"max(CASE WHEN k = {k} THEN fn END) AS flight{k}" for k in SIX]
        + [f"CAST(max(CASE WHEN k = {k} THEN dt END) AS VARCHAR) AS date{k}" for k in SIX]
        + [f"max(CASE WHEN k = {k} THEN dep END) AS airport{k}" for k in SIX]
    )
    return oracle(
        "v_booking",
        f"""WITH {LEGS}, {dedupe}, {sql_fold('kept', 'slot', same)},
again AS (SELECT *, row_number() OVER (PARTITION BY row_id, route_no, fn, dt ORDER BY leg_no) AS copy FROM routed),
numbered AS (SELECT *, row_number() OVER (PARTITION BY row_id, route_no ORDER BY leg_no) AS k FROM again WHERE copy = 1)
SELECT row_id, CAST(route_no AS BIGINT) AS route_no, count(*) AS leg_count, {wide}, CAST(NULL AS VARCHAR) AS airport7 FROM numbered GROUP BY row_id, route_no""",
        True,
    )


_KEPT_PAIRS = "r AS (SELECT *, row_number() OVER (PARTITION BY row_id, fn, dt ORDER BY slot) AS rn FROM legs), kept AS (SELECT * FROM r WHERE rn = 1)"
_KEPT_DATES = "r AS (SELECT *, row_number() OVER (PARTITION BY row_id, dt ORDER BY slot) AS rn FROM legs), kept AS (SELECT * FROM r WHERE rn = 1)"
_KEPT_CONSECUTIVE = """r AS (SELECT *, lag(fn) OVER w AS pf, lag(dt) OVER w AS pd, row_number() OVER w AS rn FROM legs WINDOW w AS (PARTITION BY row_id ORDER BY slot)),
kept AS (SELECT * FROM r WHERE rn = 1 OR NOT (pf IS NOT DISTINCT FROM fn AND pd IS NOT DISTINCT FROM dt))"""
_GAP, _GAP_DAYS = "abs(epoch(o.dt) - epoch(f.dt)) <= 129600", "abs(floor((epoch(o.dt) - epoch(f.dt)) / 86400)) <= 1"


@query("b2_reconstruct_rowwise_gap", _rowwise_sql(_KEPT_PAIRS, _GAP))
def b2_rowwise_gap(d: Data) -> DataFrame:
    return plain(reconstruct_rowwise(d.view("v_booking"), BOOKING, "row_id"))


@query("b2_reconstruct_rowwise_days", _rowwise_sql(_KEPT_DATES, _GAP_DAYS))
def b2_rowwise_days(d: Data) -> DataFrame:
    return plain(reconstruct_rowwise(d.view("v_booking"), BOOKING, "row_id", routes=routes_gap_days, dedupe="dates"))


@query("d5_route_distinct", _rowwise_sql(_KEPT_CONSECUTIVE, _GAP))
def d5_route(d: Data) -> DataFrame:
    return plain(reconstruct_rowwise(d.view("v_booking"), BOOKING, "row_id", dedupe="consecutive"))


_WIDE = ",\n".join(
    [f"max(CASE WHEN leg_no = {k} THEN fn END) AS flight{k}" for k in SIX]
    + [f"CAST(max(CASE WHEN leg_no = {k} THEN dt END) AS VARCHAR) AS date{k}" for k in SIX]
    + ["max(CASE WHEN leg_no = 1 THEN dep END) AS airport1"]
    + [
        f"CASE WHEN count(*) >= {k} THEN max(CASE WHEN leg_no = {k} THEN dep END) "
        f"ELSE max(CASE WHEN leg_no = {k - 1} THEN arr END) END AS airport{k}"
        for k in range(2, 7)
    ]
    + ["max(CASE WHEN leg_no = 6 THEN arr END) AS airport7"]
)


@query(
    "r3_widen_route",
    oracle(
        "v_booking",
        f"WITH {LEGS}, {sql_fold('legs', 'dt, slot', ANCHORED)} SELECT row_id, route_no, {_WIDE} FROM routed GROUP BY row_id, route_no",
        True,
    ),
)
def r3(d: Data) -> DataFrame:
    rows = explode_routes(_legs(d, True), routes_anchored(F.col("legs")), ["row_id"])
    wide = widen_route(F.col("route"), 6, "flight{}", "date{}", BOOKING.airport_names)
    return plain(rows.select("row_id", "route_no", *[c.alias(n) for n, c in wide.items()]))


@query(
    "r4_widen_route_dep_only",
    oracle(
        "v_booking",
        f"WITH {LEGS}, {sql_fold('legs', 'dt, slot', ANCHORED)} SELECT row_id, route_no, "
        + ", ".join(
            [f"max(CASE WHEN leg_no = {k} THEN fn END) AS flight{k}" for k in SIX]
            + [f"max(CASE WHEN leg_no = {k} THEN dep END) AS airport{k}" for k in SIX]
            + ["CAST(NULL AS VARCHAR) AS airport7"]
        )
        + " FROM routed GROUP BY row_id, route_no",
        True,
    ),
)
def r4(d: Data) -> DataFrame:
    rows = explode_routes(_legs(d, True), routes_anchored(F.col("legs")), ["row_id"])
    wide = widen_route(F.col("route"), 6, "flight{}", "date{}", BOOKING.airport_names, departures_only=True)
    return plain(
        rows.select("row_id", "route_no", *[c.alias(n) for n, c in wide.items() if not n.startswith("date")])
    )


_CLEAN = f"""cleaned AS (SELECT row_id, booking_ref, pax_name, leg AS slot, fn_raw, {sql_c4('fn_raw')} AS fn, {sql_date('dt_raw')} AS dt, dep, arr
  FROM v_leg WHERE trim(fn_raw) <> ''),
usable AS (SELECT * FROM cleaned WHERE fn IS NOT NULL AND dt IS NOT NULL AND NOT regexp_full_match(upper(trim(fn_raw)), '[A-Z]{{2,3}}0+')),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY booking_ref, pax_name, dt ORDER BY slot, row_id) AS rn FROM usable) WHERE rn = 1)"""


def _trip_sql(source: str, keys: str, when: str, order: str, gap: int, backward: bool) -> str:
    back = f" WHEN epoch({when}) - epoch(prev) < 0 THEN 1" if backward else ""
    return f"""prevs AS (SELECT *, lag({when}) OVER (PARTITION BY {keys} ORDER BY {order}) AS prev FROM {source}),
trips AS (SELECT *, CAST(sum(CASE WHEN prev IS NULL THEN 1 WHEN epoch({when}) - epoch(prev) > {gap} THEN 1{back} ELSE 0 END)
  OVER (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS trip_id FROM prevs),
seqs AS (SELECT *, row_number() OVER (PARTITION BY {keys}, trip_id ORDER BY {order}) AS leg_no FROM trips)"""


def _usable(d: Data) -> DataFrame:
    legs = d.view("v_leg").withColumnsRenamed({"fn_raw": "fn", "dt_raw": "dt", "leg": "slot"})
    return clean_leg_rows(legs, 1996, 2000)


PAIR = ["booking_ref", "pax_name"]


@query(
    "d2_dedupe_by_timestamp",
    oracle(
        "v_leg",
        f"WITH {_CLEAN} SELECT row_id, booking_ref, pax_name, CAST(slot AS BIGINT) AS slot, fn, CAST(dt AS VARCHAR) AS dt FROM kept",
    ),
)
def d2(d: Data) -> DataFrame:
    kept = dedupe.keep_first(_usable(d), [*PAIR, "dt"], ["slot", "row_id"])
    return plain(kept.select("row_id", *PAIR, "slot", "fn", "dt"))


_TRIP_COLUMNS = "row_id, booking_ref, pax_name, CAST(slot AS BIGINT) AS slot, CAST(dt AS VARCHAR) AS dt, trip_id, leg_no"


@query(
    "j2_trips_gap_by_date",
    oracle(
        "v_leg",
        f"WITH {_CLEAN}, {_trip_sql('kept', 'booking_ref, pax_name', 'dt', 'dt, slot, row_id', 129600, True)} SELECT {_TRIP_COLUMNS} FROM seqs",
    ),
)
def j2_date(d: Data) -> DataFrame:
    trips = trips_of_legs(_usable(d), PAIR, ["row_id"], "date", break_on_backward=True)
    return plain(trips.select("row_id", *PAIR, "slot", "dt", "trip_id", "leg_no"))


@query(
    "j2_trips_gap_by_slot",
    oracle(
        "v_leg",
        f"WITH {_CLEAN}, {_trip_sql('kept', 'booking_ref, pax_name', 'dt', 'slot, dt, row_id', 129600, True)} SELECT {_TRIP_COLUMNS} FROM seqs",
    ),
)
def j2_slot(d: Data) -> DataFrame:
    trips = trips_of_legs(_usable(d), PAIR, ["row_id"], "slot", break_on_backward=True)
    return plain(trips.select("row_id", *PAIR, "slot", "dt", "trip_id", "leg_no"))


@query(
    "j2_trips_gap_events",
    f"WITH {_trip_sql('events', 'user_id', 'ts', 'ts, event_id', 21600, False)} SELECT event_id, user_id, trip_id FROM seqs",
)
def j2_events(d: Data) -> DataFrame:
    out = trips_gap(d.table("events").select("event_id", "user_id", "ts"), ["user_id"], "ts", ["ts", "event_id"], 6 * 3600)
    return plain(out.select("event_id", "user_id", "trip_id"))


@query(
    "j5_leg_sequence",
    f"WITH {_trip_sql('events', 'user_id', 'ts', 'ts, event_id', 129600, False)} SELECT event_id, trip_id, leg_no FROM seqs",
)
def j5(d: Data) -> DataFrame:
    out = trips_gap(d.table("events").select("event_id", "user_id", "ts"), ["user_id"], "ts", ["ts", "event_id"])
    return plain(out.select("event_id", "trip_id", "leg_no"))


def _overflow_sql(n: int) -> str:
    cells = ", ".join(["CAST(leg_no AS VARCHAR)", *[f"coalesce(CAST({c} AS VARCHAR), '-')" for c in ("fn", "dt", "dep", "arr")]])
    return f"coalesce(string_agg(concat_ws('|', {cells}), ';' ORDER BY leg_no) FILTER (WHERE leg_no > {n}), '') AS overflow"


_PIVOT = ",\n".join(
    [f"max(CASE WHEN leg_no = {k} THEN fn END) AS FlightNumber{k}" for k in range(1, 8)]
    + [f"CAST(max(CASE WHEN leg_no = {k} THEN dt END) AS VARCHAR) AS DepartureDateLocal{k}" for k in range(1, 8)]
    + ["max(CASE WHEN leg_no = 1 THEN dep END) AS Airport1"]
    + [f"max(CASE WHEN leg_no = {k} THEN arr END) AS Airport{k + 1}" for k in range(1, 8)]
    + ["count(*) AS leg_count"]
    + [_overflow_sql(7)]
)


def _with_overflow(df: DataFrame) -> DataFrame:
    """The legs past the seventh as text, so that both engines print them alike."""
    cell = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    legs = F.transform("overflow_legs", lambda x: F.concat_ws("|", *[cell(x[f]) for f in ("leg", "fn", "dt", "dep", "arr")]))
    return df.withColumn("overflow", F.array_join(legs, ";")).drop("overflow_legs")



@query(
    "r2_pivot_route",
    oracle("v_leg", f"WITH seqs AS (SELECT row_id, booking_ref, leg AS leg_no, fn_raw AS fn, dt_raw AS dt, dep, arr FROM v_leg) SELECT row_id, booking_ref, {_PIVOT} FROM seqs GROUP BY row_id, booking_ref"),
)
def r2(d: Data) -> DataFrame:
    legs = d.view("v_leg").withColumnsRenamed({"fn_raw": "fn", "dt_raw": "dt"})
    return plain(_with_overflow(pivot_route(legs, ["row_id", "booking_ref"], "leg", 7)))


@query(
    "r2_legs_past",
    oracle("v_leg", "SELECT row_id, booking_ref, leg, fn_raw AS fn, dt_raw AS dt, dep, arr FROM v_leg WHERE leg > 2"),
)
def r2_past(d: Data) -> DataFrame:
    legs = d.view("v_leg").withColumnsRenamed({"fn_raw": "fn", "dt_raw": "dt"})
    return plain(legs_past(legs, ["row_id", "booking_ref"], "leg", 2))


@query(
    "b2_trips_with_leg_rows",
    oracle(
        "v_leg",
        f"""WITH {_CLEAN}, {_trip_sql('kept', 'booking_ref, pax_name', 'dt', 'dt, slot, row_id', 129600, False)}
SELECT pax_name, booking_ref, trip_id, leg_no AS leg, fn, CAST(dt AS VARCHAR) AS dt, dep, arr FROM seqs WHERE leg_no > 1""",
    ),
)
def b2_leg_rows(d: Data) -> DataFrame:
    legs = _usable(d).withColumn("tie", F.col("row_id"))
    return plain(reconstruct_trips_and_legs(legs, PAIR, ["tie"], 1)[1])


@query(
    "b2_reconstruct_trips",
    oracle(
        "v_leg",
        f"""WITH {_CLEAN}, {_trip_sql('kept', 'booking_ref, pax_name', 'dt', 'dt, slot, row_id', 129600, False)}
SELECT pax_name, booking_ref, trip_id, arg_min(row_id, leg_no) AS row_id, CAST(NULL AS VARCHAR) AS e_ticket, {_PIVOT}
FROM seqs GROUP BY pax_name, booking_ref, trip_id""",
    ),
)
def b2(d: Data) -> DataFrame:
    legs = _usable(d).withColumn("tie", F.col("row_id"))
    return plain(_with_overflow(reconstruct_trips(legs, PAIR, ["tie"], 7, ["row_id"], ["e_ticket"])))


@query(
    "b2_reconstruct_from_wide",
    oracle(
        "v_booking",
        "WITH unp AS ("
        + " UNION ALL ".join(
            f"SELECT row_id, booking_ref, pax_name, {i} AS slot, flight{i} AS raw, {sql_c4(f'flight{i}')} AS fn, {sql_date(f'date{i}')} AS dt, "
            f"airport{i} AS dep, airport{i + 1} AS arr FROM v_booking WHERE trim(flight{i}) <> ''"
            for i in SIX
        )
        + f"""), usable AS (SELECT * FROM unp WHERE fn IS NOT NULL AND dt IS NOT NULL AND NOT regexp_full_match(upper(trim(raw)), '[A-Z]{{2,3}}0+')),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY booking_ref, pax_name, dt ORDER BY slot, row_id) AS rn FROM usable) WHERE rn = 1),
{_trip_sql('kept', 'booking_ref, pax_name', 'dt', 'slot, dt, row_id', 129600, True)}
SELECT pax_name, booking_ref, trip_id, """
        + ", ".join(
            [f"max(CASE WHEN leg_no = {k} THEN fn END) AS flight{k}" for k in SIX]
            + [f"CAST(max(CASE WHEN leg_no = {k} THEN dt END) AS VARCHAR) AS date{k}" for k in SIX]
            + ["max(CASE WHEN leg_no = 1 THEN dep END) AS Airport1"]
            + [f"max(CASE WHEN leg_no = {k} THEN arr END) AS Airport{k + 1}" for k in SIX]
            + ["count(*) AS leg_count", _overflow_sql(6)]
        )
        + " FROM seqs GROUP BY pax_name, booking_ref, trip_id",
    ),
)
def b2_wide(d: Data) -> DataFrame:
    from dataclasses import replace

    from itinera.functions.flights import normalize_flight_keep_digit

    spec = replace(BOOKING, normalize=normalize_flight_keep_digit)
    trips = reconstruct_bookings(
        d.view("v_booking"), spec, "row_id", "booking_ref", "pax_name", by="slot", break_on_backward=True
    )
    return plain(_with_overflow(trips))


def _std_slots() -> dict[int, tuple[str, str]]:
    return {i: (f"flight{i}", f"date{i}") for i in SIX}


_STD_TEST = "trim(flight{i}) NOT IN ('', 'nan', 'None') AND {ts} IS NOT NULL AND trim(airport{i}) NOT IN ('', 'nan', 'None') AND trim(airport{j}) NOT IN ('', 'nan', 'None')"


@query(
    "r5_legs_to_standard",
    oracle(
        "v_booking",
        "WITH s AS ("
        + " UNION ALL ".join(
            f"SELECT row_id, pax_name, booking_ref, {i} AS slot, upper(replace({'trim(flight%d)' % i}, ' ', '')) AS fn, {sql_ts(f'date{i}')} AS dt, "
            f"airport{i} AS dep, airport{i + 1} AS arr FROM v_booking WHERE "
            + _STD_TEST.format(i=i, j=i + 1, ts=sql_ts(f"date{i}"))
            for i in SIX
        )
        + """) SELECT sha256(concat(sha256(CAST(row_id AS VARCHAR)), '-', CAST(slot AS VARCHAR))) AS "Id", sha256(CAST(row_id AS VARCHAR)) AS "ConnectionID",
  pax_name AS "PaxName", CAST(NULL AS VARCHAR) AS "AgencyRefNumber", '' AS "ETicketNo", fn AS "FlightNumber", CAST(dt AS VARCHAR) AS "DepartureDate",
  CAST(NULL AS VARCHAR) AS "FileName", booking_ref AS "BookingRef", CASE WHEN regexp_matches(fn, '^[A-Z0-9]{2}') THEN substr(fn, 1, 2) ELSE '' END AS "AirlineCode",
  upper(dep) AS "FromAirport", upper(arr) AS "ToAirport", last_value(upper(arr)) OVER (PARTITION BY row_id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS "LastLegAirport",
  CAST(0 AS BIGINT) AS "EUEligibleDuration", CAST(NULL AS VARCHAR) AS "ExtraNote", FALSE AS "FlightFound", CAST(slot AS BIGINT) AS "LegNo" FROM s""",
    ),
)
def r5(d: Data) -> DataFrame:
    return plain(
        legs_to_standard(
            d.view("v_booking"), _std_slots(), "row_id", pax=["pax_name"], booking=["booking_ref"], airport="airport{}"
        )
    )


@query(
    "a8_parse_counters",
    oracle(
        "v_booking",
        "WITH s AS ("
        + " UNION ALL ".join(
            f"SELECT CASE WHEN coalesce(trim(flight{i}), '') IN ('', 'nan', 'None') THEN 'n' WHEN {sql_ts(f'date{i}')} IS NULL THEN 'd' "
            f"WHEN coalesce(trim(airport{i}), '') IN ('', 'nan', 'None') OR coalesce(trim(airport{i + 1}), '') IN ('', 'nan', 'None') THEN 'a' ELSE 'ok' END AS o FROM v_booking"
            for i in SIX
        )
        + """) SELECT CAST(count(*) / 6 AS BIGINT) AS total_rows, count(CASE WHEN o = 'n' THEN 1 END) AS no_flight_number,
  count(CASE WHEN o = 'd' THEN 1 END) AS invalid_date, count(CASE WHEN o = 'a' THEN 1 END) AS missing_airport, count(CASE WHEN o = 'ok' THEN 1 END) AS successful_legs FROM s""",
    ),
)
def a8(d: Data) -> DataFrame:
    return plain(parse_counters(d.view("v_booking"), _std_slots(), "airport{}"))


def _one_leg(i: int) -> str:
    return ", ".join(
        [f"flight{i} AS flight1", *[f"NULL AS flight{k}" for k in range(2, 7)], f"date{i} AS date1"]
        + [f"NULL AS date{k}" for k in range(2, 7)]
        + [f"airport{i} AS airport1", f"airport{i + 1} AS airport2", *[f"NULL AS airport{k}" for k in range(3, 8)]]
    )


_ALL = ", ".join([f"flight{k}" for k in SIX] + [f"date{k}" for k in SIX] + [f"airport{k}" for k in range(1, 8)])
_ROUND = "airport1 = airport3 AND airport4 IS NULL AND airport5 IS NULL"


@query(
    "r6_round_trip",
    oracle(
        "v_booking",
        f"""WITH b AS (SELECT *, 'ONEWAY' AS bucket FROM v_booking)
SELECT row_id, booking_ref, pax_name, bucket, {_ALL} FROM b WHERE NOT coalesce({_ROUND}, FALSE)
UNION ALL SELECT row_id, booking_ref, pax_name, 'OUTBOUND', {_one_leg(1)} FROM b WHERE {_ROUND}
UNION ALL SELECT row_id, booking_ref, pax_name, 'INBOUND', {_one_leg(2)} FROM b WHERE {_ROUND}""",
    ),
)
def r6(d: Data) -> DataFrame:
    return plain(split_round_trip(d.view("v_booking").withColumn("bucket", F.lit("ONEWAY")), BOOKING, "bucket"))


_THREE = "airport1 IS NOT NULL AND airport2 IS NOT NULL AND airport3 IS NOT NULL"


@query(
    "r7_split_connections",
    oracle(
        "v_booking",
        f"SELECT row_id, booking_ref, pax_name, {_ALL} FROM v_booking WHERE NOT ({_THREE})"
        + "".join(
            f" UNION ALL SELECT row_id, booking_ref, pax_name, {_one_leg(k)} FROM v_booking WHERE {_THREE}"
            + (f" AND coalesce(flight{k}, date{k}, airport{k + 1}) IS NOT NULL" if k > 2 else "")
            for k in SIX
        ),
    ),
)
def r7(d: Data) -> DataFrame:
    return plain(split_connections(d.view("v_booking"), BOOKING))


@query(
    "r7_split_connections_first_two",
    oracle(
        "v_booking",
        f"""WITH n AS (SELECT *, CAST(CASE WHEN {_THREE} THEN {" + ".join(f"CASE WHEN coalesce(flight{k}, date{k}, airport{k + 1}) IS NOT NULL THEN 1 ELSE 0 END" for k in range(3, 7))} ELSE 0 END AS BIGINT) AS dropped FROM v_booking)
SELECT row_id, booking_ref, pax_name, dropped, {_ALL} FROM n WHERE NOT ({_THREE})
UNION ALL SELECT row_id, booking_ref, pax_name, dropped, {_one_leg(1)} FROM n WHERE {_THREE}
UNION ALL SELECT row_id, booking_ref, pax_name, dropped, {_one_leg(2)} FROM n WHERE {_THREE}""",
    ),
)
def r7_two(d: Data) -> DataFrame:
    return plain(split_connections(d.view("v_booking"), BOOKING, first_two=True, dropped="dropped"))


@query(
    "r8_explode_list",
    "WITH w AS (SELECT unnest(string_split(text, ',')) AS part FROM conversations) "
    "SELECT part, count(*) AS cnt FROM w GROUP BY part",
)
def r8(d: Data) -> DataFrame:
    rows = explode_list(d.table("conversations").select("text"), "text", ",", "part")
    return plain(rows.groupBy("part").agg(F.count(F.lit(1)).alias("cnt")))


@query(
    "r9_concat_split",
    "SELECT o_orderkey, o_totalprice, o_orderstatus = 'F' AS is_train FROM orders WHERE o_orderstatus IS NOT NULL",
)
def r9(d: Data) -> DataFrame:
    orders = d.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus").filter("o_orderstatus IS NOT NULL")
    done, open_ = split_flagged(orders.withColumn("f", F.col("o_orderstatus") == "F"), "f")
    return plain(concat_flagged(done, open_).drop("o_orderstatus"))


@query(
    "w1_row_number",
    "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n, row_number() OVER (ORDER BY ts, event_id) AS overall FROM events",
)
def w1(d: Data) -> DataFrame:
    rows = number_within(d.table("events"), ["event_type"], ["ts", "event_id"], "n")
    rows = number_within(rows, [], ["ts", "event_id"], "overall")
    return plain(rows.select("event_id", "n", "overall"))


@query(
    "w2_lag_lead",
    """SELECT event_id, lag(value, 1) OVER w AS prev1, lag(value, 3) OVER w AS prev3, lead(value, 2) OVER w AS next2, row_number() OVER w AS n
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
)
def w2(d: Data) -> DataFrame:
    rows = shift_within(
        d.table("events"),
        ["event_type"],
        ["ts", "event_id"],
        {"prev1": ("value", -1), "prev3": ("value", -3), "next2": ("value", 2)},
        rank="n",
    )
    return plain(rows.select("event_id", "prev1", "prev3", "next2", "n"))


@query(
    "f4_usable_legs",
    oracle("v_leg", f"WITH {_CLEAN} SELECT row_id, CAST(slot AS BIGINT) AS slot, fn, CAST(dt AS VARCHAR) AS dt FROM usable"),
)
def f4(d: Data) -> DataFrame:
    return plain(_usable(d).select("row_id", "slot", "fn", "dt"))


def _dates() -> list:
    return [try_timestamp(F.col(f"date{i}")) for i in SIX]


_BETWEEN = " OR ".join(
    f"coalesce({sql_ts(f'date{i}')} BETWEEN '1996-01-01' AND '2000-12-31', FALSE)" for i in SIX
)


@query("f1_any_slot_in_range", oracle("v_booking", f"SELECT row_id, date1 FROM v_booking WHERE {_BETWEEN}"))
def f1(d: Data) -> DataFrame:
    return d.view("v_booking").filter(filters.any_slot_in_range(_dates(), 1996, 2000)).select("row_id", "date1")


@query("f2_no_slot_in_range", oracle("v_booking", f"SELECT row_id, date1 FROM v_booking WHERE NOT ({_BETWEEN})"))
def f2(d: Data) -> DataFrame:
    return d.view("v_booking").filter(filters.no_slot_in_range(_dates(), 1996, 2000)).select("row_id", "date1")


@query(
    "f2_no_slot_in_range_legacy",
    oracle("v_booking", "SELECT row_id, date1 FROM v_booking WHERE NOT (" + " OR ".join(f"{sql_ts(f'date{i}')} BETWEEN '1996-01-01' AND '2000-12-31'" for i in SIX) + ")"),
)
def f2_legacy(d: Data) -> DataFrame:
    kept = d.view("v_booking").filter(filters.no_slot_in_range(_dates(), 1996, 2000, legacy_nulls=True))
    return kept.select("row_id", "date1")


@query("f3_non_blank", oracle("v_leg", "SELECT row_id, CAST(leg AS BIGINT) AS leg, fn_raw FROM v_leg WHERE trim(fn_raw) <> ''"))
def f3(d: Data) -> DataFrame:
    return plain(d.view("v_leg").filter(filters.non_blank("fn_raw")).select("row_id", "leg", "fn_raw"))


@query(
    "f5_row_mask",
    oracle(
        "v_booking",
        f"SELECT row_id FROM v_booking WHERE coalesce({', '.join(f'flight{i}' for i in SIX)}) IS NOT NULL "
        f"AND coalesce({', '.join(f'date{i}' for i in SIX)}) IS NOT NULL AND NOT ("
        + " OR ".join(f"coalesce(flight{i} LIKE '%000', FALSE)" for i in SIX)
        + ")",
    ),
)
def f5(d: Data) -> DataFrame:
    mask = filters.row_mask([F.col(f"flight{i}") for i in SIX], [F.col(f"date{i}") for i in SIX])
    return d.view("v_booking").filter(mask).select("row_id")


@query("f6_dropna", oracle("v_leg", "SELECT row_id, CAST(leg AS BIGINT) AS leg, fn_raw, dt_raw FROM v_leg WHERE fn_raw IS NOT NULL AND dt_raw IS NOT NULL"))
def f6(d: Data) -> DataFrame:
    return plain(filters.drop_incomplete(d.view("v_leg").select("row_id", "leg", "fn_raw", "dt_raw")))


@query(
    "f7_complete_groups",
    oracle(
        "v_status",
        "SELECT id FROM v_status WHERE connection_id NOT IN (SELECT connection_id FROM v_status WHERE sched_arr IS NULL OR (revised_arr IS NULL AND runway_arr IS NULL))",
    ),
)
def f7(d: Data) -> DataFrame:
    holds = F.col("sched_arr").isNotNull() & (F.col("revised_arr").isNotNull() | F.col("runway_arr").isNotNull())
    return filters.complete_groups(d.view("v_status"), ["connection_id"], holds).select("id")


@query("f8_exclude_countries", oracle("v_airports", "SELECT code FROM v_airports WHERE country NOT IN ('NATION_3', 'NATION_7')"))
def f8(d: Data) -> DataFrame:
    return d.view("v_airports").filter(filters.not_in_values("country", ["NATION_3", "NATION_7"])).select("code")


@query("f9_is_true", oracle("v_airports", "SELECT code FROM v_airports WHERE is_eu IS TRUE"))
def f9(d: Data) -> DataFrame:
    return d.view("v_airports").filter("is_eu").select("code")


@query("k4_delete_where", oracle("v_leg", "SELECT row_id, CAST(leg AS BIGINT) AS leg, fn_raw FROM v_leg WHERE NOT coalesce(fn_raw LIKE '%000', FALSE)"))
def k4(d: Data) -> DataFrame:
    return plain(filters.delete_where(d.view("v_leg"), F.col("fn_raw").endswith("000")).select("row_id", "leg", "fn_raw"))


@query(
    "c9_is_placeholder_flight",
    oracle(
        "v_leg",
        """SELECT row_id, CAST(leg AS BIGINT) AS leg, coalesce(regexp_full_match(upper(trim(fn_raw)), '[A-Z]{2,3}0+'), FALSE) AS carrier_zeros,
  coalesce(upper(trim(fn_raw)) LIKE '%000', FALSE) AS ends_000, coalesce(regexp_full_match(upper(trim(fn_raw)), '[A-Z]{1,2}'), FALSE) AS letters_only FROM v_leg""",
    ),
)
def c9(d: Data) -> DataFrame:
    rules = ("carrier_zeros", "ends_000", "letters_only")
    return plain(d.view("v_leg").select("row_id", "leg", *[is_placeholder_flight("fn_raw", r).alias(r) for r in rules]))
