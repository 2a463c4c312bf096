"""Raw extracts to clean all-text columns, one function per layout family."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.functions.chains import (
    airport_chain_destinations,
    airport_chain_unique,
    hyphenless_flights,
    numbered,
    sector_pair,
    split_tokens,
    tokens,
    widest,
)
from itinera.functions.dates import parse_any_date, parse_short_date, try_timestamp
from itinera.functions.flights import first_flight_of_pair, normalize_flight_hyphen
from itinera.functions.text import null_tokens
from itinera.operators.layout import add_row_uuid, drop_columns, reorder_after, sanitize_columns
from itinera.spec import classify_columns

# Column-name patterns that give a column its role.
DEPARTURE_ROLES = {"date": r"departuredatelocal\d+", "flight": r"flightnumber\d+"}
MIXED_ROLES = {
    "date": r"(flightdate|departuredatelocal|flightdatelocal)\d*$|bill_date$|tk_acmadm$",
    "flight": r"flightnumber\d*$",
}


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def normalise_by_role(
    df: DataFrame, roles: Mapping[str, str] = DEPARTURE_ROLES, day_first: bool = True, space_in_number: bool = False
) -> DataFrame:
    """Dates to ISO text (unreadable text stays), flight numbers without hyphen and zeros, null tokens to null."""
    by_role = classify_columns(df.columns, dict(roles))
    out: dict[str, Column] = {}
    for name in df.columns:
        if name in by_role["date"]:
            out[name] = parse_any_date(_q(name), day_first=day_first, keep_text=True)
        elif name in by_role["flight"]:
            out[name] = normalize_flight_hyphen(_q(name), allow_space=space_in_number)
        else:
            out[name] = null_tokens(_q(name))
    return df.select(*[c.alias(n) for n, c in out.items()])


def normalise_token_lists(
    df: DataFrame,
    flights: str = "FlightNo",
    sector: str = "Sector",
    dates: str = "FTDA",
    year_from: str = "FirstSectordate",
    date_columns: Sequence[str] = ("DAIS", "FirstSectordate", "LastSectordate"),
    widths: tuple[int, int, int] | None = None,
) -> DataFrame:
    """Space-separated flights, sectors and short dates to numbered columns.

    The year of short dates comes from ``year_from``. Widths (flights, airports, dates) are the maxima over the
    whole table unless given. Unreadable dates become null and leave no gap.
    """
    year = F.substring(parse_any_date(_q(year_from)), 1, 4)
    flight_items = hyphenless_flights(null_tokens(_q(flights)))
    airport_items = airport_chain_unique(_q(sector))
    date_items = F.filter(
        F.transform(tokens(null_tokens(_q(dates))), lambda t: parse_any_date(t, fallback_year=year)),
        lambda d: d.isNotNull(),
    )
    staged = df.withColumns({"__f": flight_items, "__a": airport_items, "__d": date_items})
    if widths is None:
        sizes = staged.agg(*[F.max(F.size(c)).alias(c) for c in ("__f", "__a", "__d")]).first()
        widths = tuple(int(sizes[c] or 0) for c in ("__f", "__a", "__d"))
    keep = [c for c in df.columns if c not in (flights, sector, dates)]
    columns = {c: parse_any_date(_q(c)) if c in date_columns else _q(c) for c in keep}
    columns |= numbered(F.col("__d"), widths[2], dates)
    columns |= numbered(F.col("__f"), widths[0], flights)
    columns |= numbered(F.col("__a"), widths[1], "Airport")
    return staged.select(*[c.alias(n) for n, c in columns.items()])


def normalise_pairs(df: DataFrame, flight: str = "FLIGHTNO", sector: str = "SECTOR") -> DataFrame:
    """First flight and first sector of ``A / B`` cells; the sector column gives way to two airports, plus an id."""
    first, second = sector_pair(_q(sector))
    kept = [c for c in df.columns if c != sector]
    cells = [(first_flight_of_pair(_q(c)) if c == flight else null_tokens(_q(c))).alias(c) for c in kept]
    return add_row_uuid(df.select(*cells, first.alias("Airport1"), second.alias("Airport2")))


def normalise_settlement(
    df: DataFrame,
    drop: Sequence[str] = (),
    flights: str = "FlightNo",
    sector: str = "Sector",
    dates: str = "FTDA",
    year_from: str = "DAIS",
    anchor: str = "LastSectordate",
    widths: tuple[int, int, int] | None = None,
) -> DataFrame:
    """Settlement lines: short dates with the year of the issue date, numbered flights, airports by position.

    There are five airport columns, or more where a line has more sectors.
    """
    df = drop_columns(df.toDF(*[c.strip() for c in df.columns]), drop)
    year = F.year(try_timestamp(_q(year_from)))
    if widths is None:
        sizes = df.agg(*[F.max(F.size(tokens(_q(c)))).alias(c) for c in (dates, flights, sector)]).first()
        widths = tuple(int(sizes[c] or 0) for c in (dates, flights, sector))
    df = df.withColumn("__year", year)
    df = split_tokens(df, dates, "FlightDate", widths[0])
    df = df.withColumns({f"FlightDate{i}": parse_short_date(f"FlightDate{i}", "__year") for i in range(1, widths[0] + 1)})
    df = split_tokens(df, flights, "FlightNumber", widths[1])
    df = split_tokens(df.drop("__year"), sector, "__sector", widths[2])
    parts = [f"__sector{i}" for i in range(1, widths[2] + 1)]
    chain = airport_chain_destinations(F.array(*[_q(p) for p in parts]) if parts else F.array(F.lit(None).cast("string")), 5, compact=False)
    names = [f"Airport{i}" for i in range(1, max(5, widths[2] + 1) + 1)]
    df = df.withColumn("__chain", chain)
    df = df.withColumns({n: F.get("__chain", F.lit(i)) for i, n in enumerate(names)})
    df = df.drop("__chain", *[f"__sector{i}" for i in range(1, widths[2] + 1)])
    return reorder_after(df, names, anchor)


def normalise_tickets(df: DataFrame, date_columns: Sequence[str]) -> DataFrame:
    """Ticket sheets: safe column names, dates parsed, everything else text, plus an id."""
    dates = {d.lower() for d in date_columns}
    cells = [
        (try_timestamp(_q(c)) if c.lower() in dates else _q(c).cast("string")).alias(c) for c in df.columns
    ]
    return add_row_uuid(sanitize_columns(df.select(*cells)), out="id")


def measured_width(df: DataFrame, column: str) -> int:
    return widest(df, tokens(_q(column)))
