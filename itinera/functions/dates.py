"""Date parsing and time arithmetic on zone-less timestamps."""

from __future__ import annotations

import zoneinfo
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from itinera.functions.text import NULL_TOKENS, as_column, null_tokens

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), as_column(c))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("SECOND", as_column(start), as_column(end))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))


def later_of(a: Column | str, b: Column | str) -> Column:
    """The later of two times; the other one when one is null."""
    return F.greatest(as_column(a), as_column(b))


# Texts that hold at least a full date: year, month and day with hyphens, or with slashes.
HYPHENED = r"^[0-9]{1,4}-[0-9]{1,2}-[0-9]{1,2}([ T]|$)"
SLASHED = r"^([0-9]{1,4})/([0-9]{1,2})/([0-9]{1,2})(?=[ T]|$)"


def timestamp_sql(text: str) -> str:
    """The rule of :func:`try_timestamp` as SQL over an expression of type string."""
    return (
        f"CASE WHEN rlike(trim({text}), '{HYPHENED}') THEN try_cast(trim({text}) AS TIMESTAMP_NTZ) "
        f"WHEN rlike(trim({text}), '{SLASHED}') THEN try_cast(regexp_replace(trim({text}), '{SLASHED}', '$1-$2-$3') AS TIMESTAMP_NTZ) END"
    )


def try_timestamp(c: Column | str) -> Column:
    """Text to a zone-less timestamp; anything that is not at least a full date becomes null."""
    text = F.trim(as_column(c).cast("string"))
    return F.when(text.rlike(HYPHENED), text.try_cast("timestamp_ntz")).when(
        text.rlike(SLASHED), F.regexp_replace(text, SLASHED, "$1-$2-$3").try_cast("timestamp_ntz")
    )


def normalize_date(c: Column | str, year_min: int, year_max: int, truncate: bool = False) -> Column:
    """:func:`try_timestamp`, null outside the year range; ``truncate`` keeps the date only."""
    ts = try_timestamp(c)
    kept = F.when(F.year(ts).between(year_min, year_max), ts)
    return kept.cast("date") if truncate else kept


def parse_format(c: Column | str, pattern: str) -> Column:
    """Parse with one Spark datetime pattern; bad text becomes null."""
    return F.try_to_timestamp(F.trim(as_column(c)), F.lit(pattern)).cast("timestamp_ntz")


# The layouts of the delimited extracts.
DAY_FIRST_SLASH = "dd/MM/yyyy"
DAY_MONTH_NAME = "d MMM yyyy"
DAY_FIRST_CLOCK = "dd-MM-yyyy hh:mm a"


def parse_short_date(token: Column | str, year: Column | str) -> Column:
    """``06JUN`` plus a year from elsewhere to a date."""
    joined = F.concat(F.upper(F.trim(as_column(token))), as_column(year).cast("string"))
    ok = joined.rlike(r"^\d{1,2}[A-Z]{3}\d{4}$")
    return F.when(ok, F.try_to_timestamp(joined, F.lit("dMMMyyyy"))).cast("date")


# Closed lists tried after the ISO and month-name layouts.
_DAY_FIRST = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d MMM yyyy", "d/M/yyyy H:m", "d-M-yyyy H:m", "d MMM yyyy H:m")
_MONTH_FIRST = ("M/d/yyyy", "M-d-yyyy", "M.d.yyyy", "d MMM yyyy", "M/d/yyyy H:m", "M-d-yyyy H:m", "d MMM yyyy H:m")


def parse_any_date(
    c: Column | str,
    day_first: bool = True,
    keep_text: bool = False,
    fallback_year: Column | None = None,
    formats: Sequence[str] | None = None,
) -> Column:
    """Best-effort date text to ``yyyy-MM-dd`` text.

    ISO text passes unchanged, then ``d-MMM-yy[yy]``, then ``ddMMM`` with ``fallback_year``, then ISO date-times and
    a closed list of day-first or month-first layouts (with the order swapped as last resort). Text that fits none
    becomes null, or stays when ``keep_text``.
    """
    text = null_tokens(c, NULL_TOKENS)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text)
    named4 = F.when(text.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"), F.try_to_timestamp(text, F.lit("d-MMM-yyyy")))
    named2 = F.when(text.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{2}$"), F.try_to_timestamp(text, F.lit("d-MMM-yy")))
    layouts = tuple(formats) if formats else (
        _DAY_FIRST + _MONTH_FIRST if day_first else _MONTH_FIRST + _DAY_FIRST
    )
    tries = [named4, named2]
    if fallback_year is not None:
        tries.append(parse_short_date(text, fallback_year).cast("timestamp"))
    tries.append(try_timestamp(text).cast("timestamp"))
    tries += [F.try_to_timestamp(text, F.lit(p)) for p in layouts]
    parsed = F.date_format(F.coalesce(*tries), "yyyy-MM-dd")
    return F.coalesce(iso, parsed, text) if keep_text else F.coalesce(iso, parsed)


def known_zones() -> list[str]:
    """Zone ids that both the driver's and the JVM's zone tables carry (region ids and UTC)."""
    return sorted(
        z for z in zoneinfo.available_timezones() if ("/" in z and not z.startswith("SystemV/")) or z in ("UTC", "GMT")
    )


def valid_zone(c: Column | str) -> Column:
    """The zone id, or null when it is not a known one (an unknown zone would fail the query)."""
    return F.when(as_column(c).isin(known_zones()), as_column(c))


def utc_offset_hours(day: Column | str, zone: Column | str) -> Column:
    """Offset from UTC in hours at local noon of the day (noon is never inside a clock change).

    ``zone`` must hold valid ids; the session time zone must be UTC.
    """
    noon = F.timestamp_add("HOUR", F.lit(12), as_column(day).cast("date").cast("timestamp"))
    seconds = F.unix_seconds(noon) - F.unix_seconds(F.to_utc_timestamp(noon, as_column(zone)))
    return seconds / F.lit(3600.0)


def utc_offset_label(day: Column | str, zone: Column | str, truncate: bool = False) -> Column:
    """``+2``, ``-3``, ``+5.5``; ``truncate`` drops the fraction toward zero."""
    hours = utc_offset_hours(day, zone)
    whole = F.format_string("%+d", hours.cast("int"))
    if truncate:
        return F.when(hours.isNotNull(), whole)
    return F.when(hours == hours.cast("int"), whole).when(hours.isNotNull(), F.format_string("%+.1f", hours))
