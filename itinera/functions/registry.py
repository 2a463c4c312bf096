"""SQL functions: the four scalar rules under their SQL names.

They are plain SQL expressions, so Catalyst inlines them and no Python worker runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from itinera.functions import flights as fl
from itinera.functions.dates import timestamp_sql


# The public names of the functions.
IS_RNK, IS_VO, NORMALIZE_FLIGHT, NORMALIZE_DATE = "is_rnk", "is_vo", "normalize_flight", "normalize_date"


def register_sql_functions(spark: SparkSession, year_min: int = 1990, year_max: int = 2100) -> list[str]:
    """Create the four functions as temporary ones, from the patterns that the column rules use."""
    upper = "upper(trim(flight))"
    date = timestamp_sql("dt")
    bodies = {
        f"{IS_RNK}(flight STRING) RETURNS BOOLEAN": f"coalesce(rlike({upper}, '{fl.PLACEHOLDERS['carrier_zeros']}'), false)",
        f"{IS_VO}(flight STRING) RETURNS BOOLEAN": f"coalesce(rlike({upper}, '{fl.PLACEHOLDERS['letters_only']}'), false)",
        f"{NORMALIZE_FLIGHT}(flight STRING) RETURNS STRING": f"regexp_replace({upper}, '{fl.ZEROS_AFTER_CARRIER}', '$1$2')",
        f"{NORMALIZE_DATE}(dt STRING) RETURNS TIMESTAMP_NTZ": (
            f"CASE WHEN year({date}) BETWEEN {int(year_min)} AND {int(year_max)} THEN {date} END"
        ),
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in bodies]
