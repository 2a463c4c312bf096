"""The cleaner and the connection rules on edge rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from itinera.functions import flights as fl
from itinera.operators.reshape import explode_routes, widen_route, with_legs
from itinera.operators.segment import by_time, routes_anchored
from itinera.plans import delay, eligibility
from itinera.plans.clean import clean_bookings
from itinera.plans.trips import reconstruct_bookings
from itinera.spec import SPECS, SourceSpec

SPEC = SourceSpec("t", ("Ref",), 3, key=("Ref", "FlightNumber1", "FlightDate1"))
COLUMNS = ["id", *SPEC.columns]


def table(spark, *rows):
    full = [(i, *r, *([None] * (len(COLUMNS) - 1 - len(r)))) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, ", ".join(f"{c} {'int' if c == 'id' else 'string'}" for c in COLUMNS))


def row(ref, flights=(), dates=(), airports=("A", "B", "C", "D")):
    pad = lambda x, n: [*x, *[None] * (n - len(x))]
    return (ref, *pad(flights, 3), *pad(dates, 3), *pad(airports, 4))


def test_routes_follow_the_anchor(spark):
    df = table(
        spark,
        row("r", ["TK1", "TK2", "TK3"], ["2024-01-02 10:00", "2024-01-01 10:00", "2024-01-01 12:00"]),
        row("r", ["TK1", "TK2", "TK3"], ["2024-01-01 00:00", "2024-01-01 20:00", "2024-01-02 10:00"]),
    )
    legs = with_legs(df, SPEC).withColumn("legs", by_time(F.col("legs")))
    got = explode_routes(legs, routes_anchored(F.col("legs")), ["id"])
    got = {(r["id"], r["route_no"]): [x["fn"] for x in r["route"]] for r in got.collect()}
    # 24 hours after the anchor joins; 34 hours does not, although it is within 24 hours of its neighbour
    assert got == {(0, 1): ["TK2", "TK3", "TK1"], (1, 1): ["TK1", "TK2"], (1, 2): ["TK3"]}


def test_later_departure_replaces_arrival(spark):
    df = table(spark, row("r", ["TK1", None, "TK3"], ["2024-01-01", None, "2024-01-01 05:00"]))
    legs = with_legs(df, SPEC)
    wide = widen_route(F.col("route"), 3)
    out = explode_routes(legs, routes_anchored(F.col("legs")), ["id"]).select(*[c.alias(n) for n, c in wide.items()]).first()
    assert [out[f"Airport{i}"] for i in range(1, 5)] == ["A", "C", "D", None]


def test_every_row_is_accounted_for(spark):
    df = table(
        spark,
        row("a", ["TK1"], ["2024-01-01"]),
        row("a", ["TK 001"], ["2024-01-01 00:00:00"]),
        row("b", ["TK1"], ["1990-01-01"]),
        row("c", [None], [None]),
        row("d", ["60000"], ["2024-01-01"]),
        row("e", [None, "G8"], ["2024-01-01", "2024-01-01"]),
        row("f", ["TK1", "TK2"], ["2024-01-01", "2024-05-01"]),
        row("g", ["TK7"], ["2030-12-31 10:00"]),
        row("h", ["TK9"], ["2024-01-01"]),
        row("i", ["TK1", "TK1"], ["2024-01-01 10:00", "2024-01-01 12:00"]),
    )
    target = table(spark, row("h", ["TK9"], ["2024-01-01"])).withColumn("FlightDate1", F.col("FlightDate1").cast("timestamp_ntz"))
    result = clean_bookings(df, SPEC, "id", target)
    accepted = {(r["Ref"], r["route_no"], r["FlightNumber1"], r["FlightNumber2"]) for r in result.accepted.collect()}
    assert accepted == {("a", 1, "TK1", None), ("f", 1, "TK1", None), ("f", 2, "TK2", None), ("i", 1, "TK1", None)}
    rejected = {r["id"]: r for r in result.rejected.collect()}
    assert {i: r["RejectionReason"] for i, r in rejected.items()} == {
        1: fl.BATCH_DUPLICATE, 2: fl.INVALID_DATE_RANGE, 3: fl.INVALID_DATE_RANGE, 4: fl.PURELY_NUMERIC,
        5: fl.NUMBER_NULL, 7: fl.INVALID_DATE_RANGE, 8: fl.TARGET_CONFLICT,
    }
    assert rejected[5]["RejectionDetail"] == "No valid segments. Slots: FltNo1(FlightNumber NULL), FltNo2(FlightNumber BAD_FORMAT)"
    assert rejected[1]["FlightNumber1"] == "TK 001"
    one = result.reconciliation().first()
    assert (one["source_rows"], one["target_rows"], one["rejected_rows"], one["delta_rows"]) == (10, 4, 7, -1)


def test_trimmed_keys_never_match_on_null(spark):
    df = table(spark, row("h ", ["TK9"], ["2024-01-01"]), row(None, ["TK9"], ["2024-01-01"]))
    target = df.withColumns({"FlightDate1": F.col("FlightDate1").cast("timestamp_ntz"), "Ref": F.trim("Ref")})
    strict = clean_bookings(df, SPEC, "id", target)
    assert strict.accepted.count() == 0
    loose = clean_bookings(df, SPEC, "id", target, trim_equal=["Ref"])
    assert [r["Ref"] for r in loose.accepted.collect()] == [None]


@pytest.mark.parametrize("name", list(SPECS))
def test_every_source_layout_runs(spark, name):
    spec = SPECS[name]
    values = {c: "x" for c in spec.columns}
    values |= {c: f"TK00{i}1" for i, c in enumerate(spec.number_names)}
    values |= {c: f"2024-03-0{i + 1} 08:00:00" for i, c in enumerate(spec.date_names)}
    df = spark.createDataFrame([(0, *values.values())], "id int, " + ", ".join(f"`{c}` string" for c in values))
    result = clean_bookings(df, spec, "id")
    assert result.rejected.count() == 0
    assert result.accepted.count() == (spec.slots + 1) // 2


def test_trips_of_a_booking_span_rows(spark):
    spec = replace(SPECS["seven_slot_trips"], slots=2)
    schema = "id int, " + ", ".join(f"`{c}` string" for c in spec.columns)
    base = lambda i, *slots: (i, "P", "B", "e", "c", "TK", "j", *slots)
    df = spark.createDataFrame(
        [
            base(1, "TK0001", "TK0002", "2024-01-01 08:00", "2024-01-02 20:00", "A", "B", "C"),
            base(2, "TK000", "TK0003", "2024-01-02 21:00", "2024-01-09 08:00", "C", "D", "E"),
            base(3, "TK0001", None, "2024-01-01 08:00", None, "A", "B", None),
        ],
        schema,
    )
    out = reconstruct_bookings(df, spec, "id", "BookingRef", "PaxName", ["Airline"], ["ETicketNo"]).orderBy("trip_id").collect()
    assert [(r["FlightNumber1"], r["FlightNumber2"], r["Airport1"], r["Airport3"], r["Airline"], r["ETicketNo"]) for r in out] == [
        ("TK1", "TK2", "A", "C", "TK", None),
        ("TK3", None, "D", None, "TK", None),
    ]


def _legs(spark, rows):
    return spark.createDataFrame(rows, "ConnectionID string, LegNo int, FromAirport string, ToAirport string, AirlineCode string")


def test_eligibility_cases(spark):
    legs = _legs(
        spark,
        [
            ("eu departure", 1, "CDG", "JFK", "DL"),
            ("outside", 1, "JFK", "DXB", "EK"), ("special", 1, "JFK", "DXB", "TK"),
            ("inbound eu carrier", 1, "JFK", "CDG", "AF"), ("inbound other", 1, "JFK", "CDG", "DL"),
            ("eu in the middle", 1, "JFK", "CDG", "DL"), ("eu in the middle", 2, "CDG", "FRA", "DL"),
            ("through eu", 1, "JFK", "CDG", "AF"), ("through eu", 2, "CDG", "DXB", "AF"),
        ],
    )
    airports = spark.createDataFrame([("CDG",), ("FRA",)], "c string").select(F.col("c").alias("__m"), F.lit(True).alias("__hit"))
    carriers = spark.createDataFrame([("AF",)], "c string").select(F.col("c").alias("__m"), F.lit(True).alias("__hit"))
    got = {r["ConnectionID"]: r["EUEligible"] for r in eligibility.eligibility_by_connection(legs, airports, carriers).collect()}
    assert got == {
        "eu departure": True, "outside": False, "special": True, "inbound eu carrier": True, "inbound other": False,
        "eu in the middle": True, "through eu": False,
    }


def test_limits_and_strict(spark):
    legs = _legs(
        spark,
        [("limit", 1, "A", "X", "DL"), ("none", 1, "X", "X", "DL"), ("special", 1, "X", "X", "BA"), ("text", 1, "T", "X", "DL"), ("future", 1, "X", "X", "DL")],
    ).withColumns(
        {"EUEligible": F.lit(True), "DepartureDate": F.when(F.col("ConnectionID") == "future", F.lit("2027-01-01")).otherwise(F.lit("2023-01-01")).cast("timestamp_ntz")}
    )
    airports = spark.createDataFrame([("A", "AA"), ("A", "ZZ"), ("T", "TT")], "code string, country string")
    limits = spark.createDataFrame([("AA", "5", "1"), ("TT", "n/a", "2")], "c string, a string, b string")
    side = eligibility.airport_limits(airports, limits, "code", "country", "c", "a", "b")
    read = lambda strict: {r["ConnectionID"]: (r["IsTimeLimitL1"], r["IsTimeLimitL2"]) for r in eligibility.time_limits(legs, side, strict=strict).collect()}
    loose = {"limit": (True, False), "none": (False, False), "special": (True, True), "text": (False, False), "future": (True, True)}
    assert read(False) == loose
    assert read(True) == {**loose, "future": (False, False)}


def _status(spark, rows):
    """(connection, leg, scheduled departure, scheduled arrival, revised arrival) in minutes."""
    base = dt.datetime(2024, 1, 1)
    at = lambda m: None if m is None else base + dt.timedelta(minutes=m)
    data = [(f"{c}-{n}", c, n, at(d), at(a), at(r), None, None, None) for c, n, d, a, r in rows]
    names = "Id string, ConnectionID string, LegNo int, " + ", ".join(
        f"{c} timestamp_ntz"
        for c in ("DepartureScheduledTimeLocal", "ArrivalScheduledTimeLocal", "ArrivalRevisedTimeLocal", "ArrivalRunwayTimeLocal", "DepartureRevisedTimeLocal", "DepartureRunwayTimeLocal")
    )
    return spark.createDataFrame(data, names)


def test_delay_cases(spark):
    df = _status(
        spark,
        [
            ("one164", 1, 0, 100, 264), ("one165", 1, 0, 100, 265),
            ("lay45", 1, 0, 100, 155), ("lay45", 2, 200, 300, 300), ("lay46", 1, 0, 100, 154), ("lay46", 2, 200, 300, 300),
            ("gap", 1, 0, 100, None), ("gap", 2, 200, 300, 900),
            ("two", 1, 0, 100, 300), ("two", 2, 200, 300, 500), ("two", 3, 400, 500, 900),
        ],
    )
    got = {r["Id"]: (r["IsDelayEligible"], r["DelayTime"], r["LayOverTime"], r["LayOverLeg"]) for r in delay.delay_eligibility(df).collect()}
    marked = {k: v for k, v in got.items() if v[0]}
    assert marked == {"one165-1": (1, 9900, None, None), "lay45-1": (1, None, 2700, 1), "two-1": (1, None, -6000, 1)}
    per_leg_chunks = delay.delay_eligibility(df, rows_per_chunk=1)
    assert {r["Id"]: (r["IsDelayEligible"], r["DelayTime"], r["LayOverTime"], r["LayOverLeg"]) for r in per_leg_chunks.collect()} == got
    whole = delay.delay_eligibility(df, mark="connection", layover_as_delay=True)
    assert {r["Id"]: r["DelayTime"] for r in whole.collect() if r["IsDelayEligible"]} == {
        "one165-1": 9900, "lay45-1": 2700, "lay45-2": 2700, "two-1": -6000, "two-2": -6000, "two-3": -6000,
    }
    assert [r["Id"] for r in delay.incomplete_legs(df).collect()] == ["gap-1"]


def test_routes_of_one_piece_equal_the_fold(spark):
    """Routes that need no fold, next to ones that do: gaps, missing dates, a single leg, no leg, no array."""
    from itinera.functions.dates import micros_between
    from itinera.operators.segment import fold_routes

    texts = [["01 00", "01 10", "02 00"], ["01 00", "02 01", "02 20"], ["01 00", "01 00"], ["01 00"], [], None, [None, "01 00"], ["01 00", None], [None], ["03 00", "01 00", "03 05"]]
    legs = [None if t is None else [(f"2024-01-{x}:00:00" if x else None, i) for i, x in enumerate(t)] for t in texts]
    df = spark.createDataFrame(list(enumerate(legs)), "id int, raw array<struct<dt:string,slot:int>>")
    df = df.select("id", F.transform("raw", lambda s: F.struct(s["dt"].cast("timestamp_ntz").alias("dt"), s["slot"].alias("slot"))).alias("legs"))
    fold = fold_routes(F.col("legs"), lambda first, prev, leg: F.abs(micros_between(first["dt"], leg["dt"])) <= 24 * 3_600_000_000)
    got = df.select("id", routes_anchored(F.col("legs")).alias("a"), fold.alias("b"), by_time(F.col("legs")).alias("c"), F.array_sort("legs").alias("d")).collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in got)
    assert [None if r["a"] is None else len(r["a"]) for r in sorted(got)] == [1, 2, 1, 1, 0, None, 2, 2, 1, 3]
