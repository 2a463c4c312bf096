"""Passenger-rights eligibility and limitation periods, per connection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.operators.grouped import group_summary, join_on
from itinera.operators.joins import literal_map, lookup, unique_dimension, update_from

# Carriers with rules of their own, and their limits in years (L1, L2).
SPECIAL_CARRIERS = ("BA", "TK", "PC", "JU", "FH", "VF", "VS")
SPECIAL_LIMITS: dict[str, tuple[float, float]] = {
    "BA": (6.0, 6.0),
    "VS": (6.0, 6.0),
    "TK": (2.0, 2.0),
    "PC": (2.0, 2.0),
    "JU": (2.0, 2.0),
    "FH": (2.0, 2.0),
    "VF": (2.0, 2.0),
}
DAYS_PER_YEAR = 365.25


def member_set(dim: DataFrame, key: str, holds: Column, excluded: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """Distinct keys of the dimension rows for which the condition holds; ``excluded`` drops listed countries."""
    rows = dim.filter(holds & F.col(key).isNotNull())
    if excluded:
        column, values = excluded
        rows = rows.filter(~F.col(column).isin(list(values)))
    return rows.select(F.col(key).alias("__m")).distinct().withColumn("__hit", F.lit(True))


def eligibility_by_connection(
    legs: DataFrame,
    eu_airports: DataFrame,
    eu_carriers: DataFrame,
    special: Sequence[str] = SPECIAL_CARRIERS,
    connection: str = "ConnectionID",
    leg_no: str = "LegNo",
) -> DataFrame:
    """One row per connection with ``EUEligible``.

    Eligible when the first departure is in the EU, or any leg is flown by a special carrier, or the last arrival is
    in the EU and some leg departs in the EU or arrives there with an EU carrier. The sets come from
    :func:`member_set`. Needs ``FromAirport``, ``ToAirport``, ``AirlineCode``.
    """
    airports, carriers = eu_airports, eu_carriers
    rows = legs.select(connection, leg_no, "FromAirport", "ToAirport", "AirlineCode")
    rows = lookup(rows, airports, "FromAirport", "__m", {"__dep": "__hit"})
    rows = lookup(rows, airports, "ToAirport", "__m", {"__arr": "__hit"})
    rows = lookup(rows, carriers, "AirlineCode", "__m", {"__eu_carrier": "__hit"})
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    summary = group_summary(
        rows.withColumns({c: no(c) for c in ("__dep", "__arr", "__eu_carrier")}),
        [connection],
        [
            F.min_by("__dep", leg_no).alias("__first_dep"),
            F.max_by("__arr", leg_no).alias("__last_arr"),
            F.bool_or(F.coalesce(F.col("AirlineCode").isin(list(special)), F.lit(False))).alias("__special"),
            F.bool_or(F.col("__dep") | (F.col("__arr") & F.col("__eu_carrier"))).alias("__touches"),
        ],
    )
    eligible = F.col("__first_dep") | F.col("__special") | (F.col("__last_arr") & F.col("__touches"))
    return summary.select(connection, eligible.alias("EUEligible"))


def eu_eligible(
    legs: DataFrame,
    eu_airports: DataFrame,
    eu_carriers: DataFrame,
    special: Sequence[str] = SPECIAL_CARRIERS,
    connection: str = "ConnectionID",
    leg_no: str = "LegNo",
) -> DataFrame:
    """Leg rows with ``EUEligible`` of their connection."""
    flags = eligibility_by_connection(legs, eu_airports, eu_carriers, special, connection, leg_no)
    joined = join_on(legs, flags, [connection], "left")
    return joined.withColumn("EUEligible", F.coalesce("EUEligible", F.lit(False)))


def airport_limits(
    airports: DataFrame, limits: DataFrame, code: str, country: str, limit_country: str, l1: str, l2: str
) -> DataFrame:
    """Airport code to country and limits in years; limit text that is no number counts as 0."""
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    per_country = (
        limits.filter(F.col(limit_country).isNotNull())
        .groupBy(F.col(limit_country).alias("__country"))
        .agg(F.max(number(l1)).alias("l1"), F.max(number(l2)).alias("l2"))
    )
    plain = unique_dimension(airports, code, [country])
    joined = plain.join(per_country, plain[country] == per_country["__country"], "left")
    return joined.select(
        F.col(code).alias("code"),
        F.col(country).alias("country"),
        F.coalesce("l1", F.lit(0.0)).alias("l1"),
        F.coalesce("l2", F.lit(0.0)).alias("l2"),
    )


def time_limits(
    legs: DataFrame,
    limits_by_airport: DataFrame,
    as_of: dt.date = dt.date(2026, 4, 1),
    special: Mapping[str, tuple[float, float]] = SPECIAL_LIMITS,
    strict: bool = False,
    connection: str = "ConnectionID",
    eligible: str | None = "EUEligible",
) -> DataFrame:
    """One row per connection with ``IsTimeLimitL1`` and ``IsTimeLimitL2``.

    The connection's limit is the highest of its departure and arrival countries; where neither period is set, the
    highest of its special carriers. It is met while the limit is at least the years since the first departure.
    ``strict`` makes a connection without any limit fail even when it departs after ``as_of``.
    """
    rows = legs.filter(F.col(eligible)) if eligible else legs
    side = limits_by_airport
    rows = rows.select(connection, "FromAirport", "ToAirport", "AirlineCode", "DepartureDate")
    rows = lookup(rows, side, "FromAirport", "code", {"__d1": "l1", "__d2": "l2"})
    rows = lookup(rows, side, "ToAirport", "code", {"__a1": "l1", "__a2": "l2"})
    own = lambda i: literal_map("AirlineCode", {k: v[i] for k, v in special.items()})
    per = rows.filter(F.col(connection).isNotNull()).groupBy(connection).agg(
        F.max(F.greatest("__d1", "__a1")).alias("__c1"),
        F.max(F.greatest("__d2", "__a2")).alias("__c2"),
        F.max(own(0)).alias("__s1"),
        F.max(own(1)).alias("__s2"),
        F.min(F.col("DepartureDate").cast("date")).alias("__first"),
    )
    c1, c2 = F.coalesce("__c1", F.lit(0.0)), F.coalesce("__c2", F.lit(0.0))
    use_special = (c1 == 0) & (c2 == 0)
    years = F.datediff(F.lit(as_of), F.col("__first")) / F.lit(DAYS_PER_YEAR)
    no_limit = use_special & F.col("__s1").isNull() & F.col("__s2").isNull() if strict else F.lit(False)

    def met(country: Column, carrier: str) -> Column:
        limit = F.when(use_special, F.coalesce(F.col(carrier), F.lit(0.0))).otherwise(country)
        return F.coalesce(~no_limit & (limit >= years), F.lit(False))

    return per.select(
        connection, met(c1, "__s1").alias("IsTimeLimitL1"), met(c2, "__s2").alias("IsTimeLimitL2")
    )


def connection_facts(
    legs: DataFrame,
    eu_airports: DataFrame,
    eu_carriers: DataFrame,
    limits_by_airport: DataFrame,
    special: Sequence[str] = SPECIAL_CARRIERS,
    special_limits: Mapping[str, tuple[float, float]] = SPECIAL_LIMITS,
    connection: str = "ConnectionID",
    leg_no: str = "LegNo",
) -> DataFrame:
    """One mergeable aggregate per connection that eligibility and both limits are read from.

    The airports' membership and limits are one dimension, met once by departure and once by arrival. Every state is of
    fixed width (flags, maxima, the first date), so legs are read once and only partial states are shuffled.
    """
    sides = [eu_airports.select(F.col("__m").alias("code"), F.lit(True).alias("eu"), F.lit(None).cast("double").alias("l1"), F.lit(None).cast("double").alias("l2"))]
    sides.append(limits_by_airport.select("code", F.lit(False).alias("eu"), "l1", "l2"))
    airports = sides[0].unionByName(sides[1]).groupBy("code").agg(F.bool_or("eu").alias("eu"), F.max("l1").alias("l1"), F.max("l2").alias("l2"))
    rows = legs.where(F.col(connection).isNotNull()).select(connection, leg_no, "FromAirport", "ToAirport", "AirlineCode", "DepartureDate")
    rows = lookup(rows, airports, "FromAirport", "code", {"__dep": "eu", "__d1": "l1", "__d2": "l2"})
    rows = lookup(rows, airports, "ToAirport", "code", {"__arr": "eu", "__a1": "l1", "__a2": "l2"})
    rows = lookup(rows, eu_carriers, "AirlineCode", "__m", {"__eu_carrier": "__hit"})
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("__dep", "__arr", "__eu_carrier")})
    own = lambda i: literal_map("AirlineCode", {k: v[i] for k, v in special_limits.items()})
    return rows.groupBy(connection).agg(
        F.min_by("__dep", leg_no).alias("first_departs_eu"),
        F.max_by("__arr", leg_no).alias("last_arrives_eu"),
        F.bool_or(F.coalesce(F.col("AirlineCode").isin(list(special)), F.lit(False))).alias("special_carrier"),
        F.bool_or(F.col("__dep") | (F.col("__arr") & F.col("__eu_carrier"))).alias("touches_eu"),
        F.max(F.greatest("__d1", "__a1")).alias("country_l1"),
        F.max(F.greatest("__d2", "__a2")).alias("country_l2"),
        F.max(own(0)).alias("carrier_l1"),
        F.max(own(1)).alias("carrier_l2"),
        F.min(F.col("DepartureDate").cast("date")).alias("first_date"),
    )


def connection_flags(facts: DataFrame, as_of: dt.date = dt.date(2026, 4, 1), connection: str = "ConnectionID") -> DataFrame:
    """``EUEligible``, ``IsTimeLimitL1``, ``IsTimeLimitL2`` and the strict forms of both, as :func:`eligibility_by_connection` and
    :func:`time_limits` define them; the limits are null for connections that are not eligible."""
    eligible = F.col("first_departs_eu") | F.col("special_carrier") | (F.col("last_arrives_eu") & F.col("touches_eu"))
    c1, c2 = F.coalesce("country_l1", F.lit(0.0)), F.coalesce("country_l2", F.lit(0.0))
    use_carrier = (c1 == 0) & (c2 == 0)
    years = F.datediff(F.lit(as_of), F.col("first_date")) / F.lit(DAYS_PER_YEAR)
    unlimited = use_carrier & F.col("carrier_l1").isNull() & F.col("carrier_l2").isNull()

    def met(country: Column, carrier: str) -> Column:
        limit = F.when(use_carrier, F.coalesce(F.col(carrier), F.lit(0.0))).otherwise(country)
        return F.when(eligible, F.coalesce(limit >= years, F.lit(False)))

    loose = {"IsTimeLimitL1": met(c1, "carrier_l1"), "IsTimeLimitL2": met(c2, "carrier_l2")}
    strict = {f"{n}Strict": c & ~unlimited for n, c in loose.items()}
    return facts.select(connection, eligible.alias("EUEligible"), *[c.alias(n) for n, c in (loose | strict).items()])


def apply_time_limits(legs: DataFrame, flags: DataFrame, connection: str = "ConnectionID") -> DataFrame:
    """Write the flags of :func:`time_limits` to the leg rows; other connections keep what they have."""
    missing = {c: F.lit(None).cast("boolean") for c in ("IsTimeLimitL1", "IsTimeLimitL2") if c not in legs.columns}
    legs = legs.withColumns(missing) if missing else legs
    return update_from(legs, flags, [connection], ["IsTimeLimitL1", "IsTimeLimitL2"])
