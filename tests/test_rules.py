"""Scalar rules on hand-made values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from itinera.functions import chains, dates, flights, text
from itinera.spec import SPECS, classify_columns, detect_slots


def apply(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", column.alias("y")).orderBy("i").collect()]


NORMALISERS = lambda: [
    (flights.normalize_flight("x"), {"tk 0012": "TK12", " TK000 ": "TK000", "6E0123": "6E0123", "": None, None: None, "BA0": "BA0"}),
    (flights.normalize_flight("x", flights.LETTERS_OR_DIGIT_LETTER), {"6E0123": "6E123", "TK0012": "TK12"}),
    (flights.normalize_flight_alnum("x"), {"A-F 007": "AF7", "tk/0012": "TK12", "--": None}),
    (flights.extract_flight("x"), {"BA119/BA12": "BA119", "119": None, "TK 0012X": "TK0012"}),
    (flights.normalize_flight_keep_digit("x"), {"TK000": "TK0", "TK0012": "TK12", "TK 0012": "TK 0012", "x1": "X1"}),
    (flights.normalize_flight_keep_digit("x", inner_spaces=True), {"TK 0012": "TK12", "TK  0 0": "TK  0 0"}),
    (flights.normalize_flight_integer("x"), {"TK000": "TK0", "tk0120": "TK120", "6E01": "6E01", "\tBA07\n": "BA7"}),
    (flights.normalize_flight_hyphen("x"), {"JL-0062": "JL62", "JL0062": "JL062", "DL-9698": "DL9698", "NULL": None, "abc": "abc", "JL 0062": "JL 0062"}),
    (flights.normalize_flight_hyphen("x", allow_space=True), {"LH 9448": "LH9448", "None": None}),
    (flights.first_flight_of_pair("x"), {"BA 119 / BA 198": "BA119", "EK 506": "EK506", "NULL": None, "": None}),
    (flights.strip_prefix_zeros("x"), {"TK000": "TK", "tk012": "TK12"}),
    (flights.carrier_of("x"), {"6e123": "6E", "T": "", None: ""}),
    (flights.is_placeholder_flight("x"), {"TK000": True, "TK100": False, None: False}),
    (flights.is_placeholder_flight("x", "ends_000"), {"TK1000": True, "TK100": False}),
    (flights.is_placeholder_flight("x", "letters_only"), {"tk": True, "TKX": False}),
    (text.first_of_list("x"), {" 235-1, 235-2": "235-1", ",a": None}),
    (text.unwrap_literal("x"), {'["hi \\"you\\""]': 'hi "you\\', "[a": "[a", "'q'": "q"}),
    (text.blank_to_null("x"), {"\t a \n": "a", "  ": None}),
    (dates.parse_format("x", dates.DAY_FIRST_SLASH), {"32/12/2024": None}),
    (dates.parse_any_date("x"), {
        "2024-01-05": "2024-01-05", "25-Jan-25": "2025-01-25", "5-jan-2025": "2025-01-05", "NULL": None, "None": None,
        "2024-13-01 00:00": None, "31/12/2024": "2024-12-31", "03/04/2024": "2024-04-03", "12/31/2024": "2024-12-31", "what": None,
    }),
    (dates.parse_any_date("x", day_first=False, keep_text=True), {"03/04/2024": "2024-03-04", "what": "what", "31/12/2024": "2024-12-31"}),
    (dates.parse_short_date("x", F.lit(2025)).cast("string"), {"06JUN": "2025-06-06", "6jun": "2025-06-06", "31FEB": None, "JUN": None}),
    (dates.try_timestamp("x").cast("string"), {
        "2024-01-05": "2024-01-05 00:00:00", "2024/1/5 10:30": "2024-01-05 10:30:00", "2024": None, "10:30": None, "NULL": None, "2024-02-30": None,
    }),
]


@pytest.mark.parametrize("n", range(23))
def test_rule_table(spark, n):
    rules = NORMALISERS()
    assert len(rules) == 23
    column, cases = rules[n]
    assert apply(spark, column, list(cases)) == list(cases.values())


def test_reject_reasons(spark):
    cases = [
        (None, None, flights.NUMBER_NULL),
        (None, "2024-01-01", flights.NUMBER_NULL),
        ("TK1", None, flights.DATE_NULL),
        ("", "2024-01-01", flights.NUMBER_EMPTY),
        ("123456", "2024-01-01", flights.PURELY_NUMERIC),
        ("LH1234567890", "2024-01-01", flights.TOO_LONG),
        ("0000", "2024-01-01", flights.PURELY_NUMERIC),
        ("TK00", "2024-01-01", flights.ALL_ALPHA),
        ("G8", "2024-01-01", flights.BAD_FORMAT),
        ("TK12", "2024-01-01", None),
    ]
    df = spark.createDataFrame([(i, f, d) for i, (f, d, _) in enumerate(cases)], "i int, f string, d string")
    df = df.withColumn("t", dates.try_timestamp("d"))
    got = df.select("i", flights.flight_reject_reason("f", "t").alias("r")).orderBy("i").collect()
    assert [r["r"] for r in got] == [c[2] for c in cases]
    joined = df.select("i", flights.flight_reject_reason("f", "t", flights.STRICT_JOINED).alias("r")).orderBy("i").first()
    assert joined["r"] == flights.BOTH_NULL
    lenient = df.select(flights.is_valid_flight("f", "t", flights.MINIMAL).alias("v"), "f").collect()
    assert {r["f"] for r in lenient if r["v"]} == {"123456", "LH1234567890", "G8", "TK12"}
    digits = df.select(flights.is_valid_flight("f", "t", flights.DIGITS_ALLOWED).alias("v"), "f").collect()
    assert {r["f"] for r in digits if r["v"]} == {"123456", "TK12"}


def test_chains(spark):
    assert apply(spark, F.array_join(chains.airport_chain_unique("x"), ">"), ["YYZ/AMS AMS/DXB", "LHR/DXB DXB/LHR", "NULL"]) == [
        "YYZ>AMS>DXB", "LHR>DXB", "",
    ]
    parts = F.split("x", " ")
    joined = lambda compact: F.array_join(chains.airport_chain_destinations(parts, 5, compact), ">")
    assert apply(spark, joined(True), ["yyz/ams VOID ams/dxb"]) == ["YYZ>AMS>DXB>>"]
    assert apply(spark, joined(False), ["yyz/ams VOID ams/dxb"]) == ["YYZ>AMS>>DXB>"]
    a, b = chains.sector_pair("x")
    assert apply(spark, F.concat_ws("|", a, b), ["LHR - BLR / BOM - LHR", "DXB", ""]) == ["LHR|BLR", "DXB", ""]
    assert apply(spark, F.array_join(chains.hyphenless_flights("x"), " "), ["DL-9698 DL-9320   "]) == ["DL9698 DL9320"]


def test_offsets(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-15", "Europe/London"), (2, "2024-07-15", "Europe/London"), (3, "2024-07-15", "Asia/Kolkata"),
         (4, "2024-07-15", None), (5, "2024-07-15", "Mars/Base"), (6, "2024-01-15", "America/New_York")],
        "i int, d string, z string",
    )
    df = df.withColumn("v", dates.valid_zone("z")).orderBy("i")
    assert [r[0] for r in df.select(dates.utc_offset_label("d", "v")).collect()] == ["+0", "+1", "+5.5", None, None, "-5"]
    assert [r[0] for r in df.select(dates.utc_offset_label("d", "v", True)).collect()][2] == "+5"


def test_every_known_zone_converts(spark):
    zones = spark.createDataFrame([(z,) for z in dates.known_zones()], "z string")
    assert zones.select(dates.utc_offset_hours(F.lit("2024-07-01"), "z").alias("h")).filter("h IS NULL").count() == 0


def test_column_detection():
    assert detect_slots(["FlitNo1", "fltdate1", "FlightNumber2", "Date3", "x"]) == {1: ("FlitNo1", "fltdate1"), 2: ("FlightNumber2", None)}
    assert classify_columns(["FlightNumber1", " DepartureDateLocal2", "Name"], {"f": r"flightnumber\d+", "d": r"departuredatelocal\d+"}) == {
        "f": ["FlightNumber1"], "d": [" DepartureDateLocal2"], "other": ["Name"],
    }


def test_specs_are_consistent():
    widths = {n: len(s.target_key_columns) for n, s in SPECS.items()}
    assert widths["six_slot"] == 22 and widths["five_slot"] == 18 and widths["four_slot_billed"] == 16
    assert len(SPECS["four_slot_billed"].key_columns) == 7 and widths["four_slot_plain"] == 16
    for s in SPECS.values():
        assert len(s.airport_names) == s.slots + 1
        assert set(s.key_columns) <= set(s.columns)
