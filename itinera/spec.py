"""Source specifications: everything that differs between booking extracts, as data."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column

from itinera.functions import flights as fl

Normalizer = Callable[[Column], Column]


def letters(c: Column) -> Column:
    return fl.normalize_flight(c, fl.LETTERS)


def letters_or_digit(c: Column) -> Column:
    return fl.normalize_flight(c, fl.LETTERS_OR_DIGIT_LETTER)


@dataclass(frozen=True)
class SourceSpec:
    """Layout and rules of one wide booking extract.

    ``number``, ``date`` and ``airport`` are column-name patterns with ``{}`` for the slot; ``airports`` names the
    airport columns outright where they are not numbered.
    """

    name: str
    base: tuple[str, ...]
    slots: int
    number: str = "FlightNumber{}"
    date: str = "FlightDate{}"
    airport: str = "Airport{}"
    airports: tuple[str, ...] = ()
    normalize: Normalizer = letters
    rules: fl.FlightRules = fl.STRICT
    year_min: int = 2010
    year_max: int = 2030
    route_hours: int = 24
    key: tuple[str, ...] = ()
    target_key: tuple[str, ...] = ()

    @property
    def number_names(self) -> list[str]:
        return [self.number.format(i) for i in range(1, self.slots + 1)]

    @property
    def date_names(self) -> list[str]:
        return [self.date.format(i) for i in range(1, self.slots + 1)]

    @property
    def airport_names(self) -> list[str]:
        return list(self.airports) or [self.airport.format(i) for i in range(1, self.slots + 2)]

    @property
    def columns(self) -> list[str]:
        return [*self.base, *self.number_names, *self.date_names, *self.airport_names]

    @property
    def key_columns(self) -> list[str]:
        """The duplicate key; by default every slot column after the base columns."""
        return list(self.key) or self.columns

    @property
    def target_key_columns(self) -> list[str]:
        """The key that must be unique in the target table; by default the duplicate key."""
        return list(self.target_key) or self.key_columns


def _slots(base: Sequence[str], n: int, number: str, date: str) -> tuple[str, ...]:
    rng = range(1, n + 1)
    return (
        *base,
        *(number.format(i) for i in rng),
        *(date.format(i) for i in rng),
        *(f"Airport{i}" for i in range(1, n + 2)),
    )


def _spec(name: str, base: str, slots: int, key: str, run_key: str = "", **more) -> SourceSpec:
    """``key`` plus all slot columns is the target's key; ``run_key`` is the key inside a run where it is narrower."""
    number, date = more.get("number", "FlightNumber{}"), more.get("date", "FlightDate{}")
    full = _slots(key.split(), slots, number, date)
    return SourceSpec(name, tuple(base.split()), slots, key=tuple(run_key.split()) or full, target_key=full, **more)


# One entry per extract layout, named after its shape. Column names, slot counts and key columns.
SPECS: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        _spec("six_slot", "PaxName PNRCRS PNRAirline Airlines AirlineCode TktNo", 6, "PNRCRS AirlineCode TktNo"),
        _spec(
            "five_slot",
            "BookingId PaxName JourneyBucket BookingRef_PNR Airline ETicketNo",
            5,
            "BookingId PaxName",
            date="DepartureDateLocal{}",
            normalize=letters_or_digit,
            rules=fl.STRICT_JOINED,
        ),
        # the earlier cleaner of the same extract: a narrower key, which is the target's as well
        SourceSpec(
            "five_slot_narrow_key",
            ("BookingId", "PaxName", "JourneyBucket", "BookingRef_PNR", "Airline", "ETicketNo"),
            5,
            date="DepartureDateLocal{}",
            normalize=letters_or_digit,
            rules=fl.STRICT_JOINED,
            year_min=2010,
            year_max=2030,
            key=("BookingId", "PaxName", "FlightNumber1", "DepartureDateLocal1", "Airport1", "Airport2"),
        ),
        # the earlier cleaner of six slots: a slot needs a number that is not made up and a date, nothing else
        _spec(
            "six_slot_minimal", "PaxName PNRCRS PNRAirline Airlines AirlineCode TktNo", 6, "PNRCRS AirlineCode TktNo", rules=fl.MINIMAL
        ),
        _spec(
            "four_slot_billed",
            "BillDate PaxName PNRNo AirlineName TicketNo SupplierName PaxType",
            4,
            "PNRNo AirlineName TicketNo",
            run_key="PNRNo AirlineName TicketNo FltNo1 FltDate1 Airport1 Airport2",
            number="FltNo{}",
            date="FltDate{}",
            normalize=letters_or_digit,
            rules=fl.STRICT_JOINED,
        ),
        _spec(
            "four_slot_plain",
            "BillDate PNRNo AirlineName TicketNo",
            4,
            "PNRNo AirlineName TicketNo",
            number="FltNo{}",
            date="FltDate{}",
            rules=fl.STRICT_JOINED,
        ),
        _spec(
            "four_slot_settlement",
            "DAIS TRNN TDNR AIRCODE AIRNAME TRNC STAT PNRR FirstSectordate LastSectordate PXNM ORIT OriginalTktNo",
            4,
            "PNRR AIRCODE OriginalTktNo",
            rules=fl.MINIMAL,
        ),
        _spec(
            "four_slot_ticket",
            "IATA TicketNumber TicketDate PNR PaxName AirlineName",
            4,
            "AirlineName TicketNumber",
            normalize=fl.normalize_flight_alnum,
            rules=fl.DIGITS_ALLOWED,
        ),
        _spec(
            "two_slot",
            "PaxName AirlineBooking Airline ETicketNo Direction TpackRef",
            2,
            "AirlineBooking Airline ETicketNo",
            normalize=fl.extract_flight,
            rules=fl.MINIMAL,
        ),
        SourceSpec(
            "one_slot",
            tuple("BookingRef BookingDate SuperPNR PaxName PNRNo AirlineName TicketNo ArrivalDate".split()),
            1,
            number="FlightNumber",
            date="DepartureDate",
            airports=("DepartureAirport", "ArrivalAirport"),
            rules=fl.MINIMAL_NO_NUMERIC,
            key=tuple(
                "BookingRef SuperPNR PaxName PNRNo AirlineName TicketNo FlightNumber DepartureDate "
                "DepartureAirport ArrivalAirport".split()
            ),
        ),
        SourceSpec(
            "seven_slot_trips",
            tuple("PaxName BookingRef ETicketNo ClientCode Airline JourneyType".split()),
            7,
            date="DepartureDateLocal{}",
            normalize=fl.normalize_flight_keep_digit,
            year_min=1990,
            year_max=2100,
        ),
        SourceSpec(
            "seven_slot_rowwise",
            ("PaxName", "BookingRef", "ETicketNo", "ClientCode", "Airline", "JourneyType"),
            7,
            date="DepartureDateLocal{}",
            normalize=fl.normalize_flight_keep_digit,
            rules=fl.MINIMAL,
            year_min=2010,
            year_max=2030,
        ),
        SourceSpec(
            "six_slot_trips",
            ("Pax Name", "PNR CRS", "PNR Airline", "Airlines", "Ticket Number"),
            6,
            number="S{}FltNo",
            date="S{}Date",
            airport="Airport {}",
            normalize=lambda c: fl.normalize_flight_keep_digit(c, inner_spaces=True),
            year_min=1990,
            year_max=2027,
        ),
    )
}

# The spellings of slot columns.
_NUMBER = re.compile(r"^(?:Flit|Flt|Flight)(?:No|Number)?(\d+)$", re.IGNORECASE)
_DATE = re.compile(r"^(?:Flt|Flight)?(?:Date|Dt)(\d+)$", re.IGNORECASE)


def detect_slots(columns: Sequence[str]) -> dict[int, tuple[str, str | None]]:
    """Slot number to (flight column, date column or None), found by the column names alone."""
    numbers = {int(m.group(1)): c for c in columns if (m := _NUMBER.match(c))}
    dates = {int(m.group(1)): c for c in columns if (m := _DATE.match(c))}
    return {i: (numbers[i], dates.get(i)) for i in sorted(numbers)}


def classify_columns(columns: Sequence[str], rules: dict[str, str]) -> dict[str, list[str]]:
    """Column names by role; ``rules`` maps a role to a pattern, the first match wins, the rest is ``other``."""
    roles: dict[str, list[str]] = {role: [] for role in rules} | {"other": []}
    for name in columns:
        low = name.strip().lower()
        roles[next((r for r, p in rules.items() if re.match(p, low)), "other")].append(name)
    return roles
