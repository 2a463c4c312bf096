"""UTC offsets of departures and arrivals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.functions.dates import utc_offset_hours, utc_offset_label, valid_zone
from itinera.operators.joins import distinct_pairs, lookup


def airport_key(c: Column | str) -> Column:
    return F.upper(F.trim(F.col(c) if isinstance(c, str) else c))


def zone_dimension(zones: DataFrame, code: str, zone: str) -> DataFrame:
    """One known time zone per airport code; unknown zone ids are dropped."""
    rows = zones.select(airport_key(code).alias("code"), valid_zone(zone).alias("zone"))
    return rows.filter("code IS NOT NULL AND zone IS NOT NULL").groupBy("code").agg(F.min("zone").alias("zone"))


def enrich_utc_offset(
    df: DataFrame, day: str, airports: Mapping[str, str], zones: DataFrame, kind: str = "label"
) -> DataFrame:
    """Add an offset per airport column: ``{airport column: new column}``.

    The offset is an inlined expression over a zone lookup, so there is no pass for distinct (airport, day) pairs.
    ``kind``: ``label`` (``+5.5``), ``whole`` (``+5``) or ``hours`` (5.5).
    """
    side = zones
    for airport, out in airports.items():
        df = lookup(df, side, airport_key(airport), "code", {f"__zone_{out}": "zone"})
        zone = F.col(f"__zone_{out}")
        value = utc_offset_hours(day, zone) if kind == "hours" else utc_offset_label(day, zone, kind == "whole")
        df = df.withColumn(out, value).drop(f"__zone_{out}")
    return df


def offset_lookup(
    df: DataFrame, day: str, departure: str, arrival: str, zones: DataFrame, kind: str = "label"
) -> DataFrame:
    """The distinct (airport, day) pairs of both columns with their offset: the lookup table as a result."""
    date = F.col(day).cast("date")
    pairs = distinct_pairs(
        df, (airport_key(departure), date), (airport_key(arrival), date), names=("airport", "day")
    )
    return enrich_utc_offset(pairs, "day", {"airport": "utc_offset"}, zones, kind)
