"""The booking cleaner and its parts: duplicates, target conflicts, mutation, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import ANCHORED, SLOTS, oracle, sql_fold, sql_reason, sql_ts
from checks.journeys import BOOKING, SIX
from checks.registry import Data, plain, query
from itinera.operators import dedupe
from itinera.operators.joins import difference, update_from
from itinera.plans.clean import CleanResult, clean_bookings
from itinera.sinks.tables import replace_subset, rows_to_append

# Bookings that were loaded before: the target of this run.
LOADED = "booking_ref < 'R3'"

_RANGE = " OR ".join(
    f"coalesce({sql_ts(f'date{i}')} BETWEEN '1996-01-01' AND '2000-12-31', FALSE)" for i in SIX
)
_WIDE = ", ".join(
    [f"max(CASE WHEN leg_no = {k} THEN fn END) AS flight{k}" for k in SIX]
    + [f"max(CASE WHEN leg_no = {k} THEN dt END) AS date{k}" for k in SIX]
    + ["max(CASE WHEN leg_no = 1 THEN dep END) AS airport1"]
    + [
        f"CASE WHEN count(*) >= {k} THEN max(CASE WHEN leg_no = {k} THEN dep END) "
        f"ELSE max(CASE WHEN leg_no = {k - 1} THEN arr END) END AS airport{k}"
        for k in range(2, 7)
    ]
    + ["max(CASE WHEN leg_no = 6 THEN arr END) AS airport7"]
)
_TARGET_KEY = BOOKING.target_key_columns
_PIPELINE = f"""ranged AS (SELECT row_id, {_RANGE} AS in_range FROM v_booking),
{SLOTS},
tagged AS (SELECT slots.*, {sql_reason('fn', 'dt')} AS reason, in_range FROM slots JOIN ranged ON slots.row_id = ranged.row_id),
deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id, fn, CAST(dt AS DATE) ORDER BY dt, slot) AS dn
  FROM tagged WHERE reason IS NULL AND in_range) WHERE dn = 1),
{sql_fold('deduped', 'dt, slot', ANCHORED)},
wide AS (SELECT row_id, CAST(route_no AS BIGINT) AS route_no, {_WIDE} FROM routed GROUP BY row_id, route_no),
full_rows AS (SELECT wide.*, booking_ref, pax_name FROM wide JOIN v_booking ON wide.row_id = v_booking.row_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(BOOKING.key_columns)} ORDER BY row_id, route_no) AS kn FROM full_rows)"""
_WITH_TARGET = f"""{_PIPELINE},
target_ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(BOOKING.key_columns)} ORDER BY row_id, route_no) AS tn FROM full_rows WHERE {LOADED}),
target AS (SELECT * FROM target_ranked WHERE tn = 1),
matched AS (SELECT r.*, EXISTS (SELECT 1 FROM target t WHERE {' AND '.join(f't.{k} IS NOT DISTINCT FROM r.{k}' for k in _TARGET_KEY)}) AS known FROM ranked r WHERE kn = 1)"""
_FAILED = """failed AS (SELECT row_id, NULL AS route_no, 'INVALID_DATE_RANGE' AS reason, 'All dates outside 1996-2000' AS detail FROM ranged WHERE NOT in_range
UNION ALL SELECT t.row_id, NULL, max(CASE WHEN slot = 1 THEN reason END),
  concat('No valid segments. Slots: ', string_agg(concat('FltNo', slot, '(', reason, ')'), ', ' ORDER BY slot)
    FILTER (NOT (slot > 1 AND reason IN ('FlightNumber NULL', 'FlightDate NULL', 'FlightNumber EMPTY'))))
  FROM tagged t WHERE in_range GROUP BY t.row_id HAVING count(*) = count(reason))"""
_OUT = ", ".join(
    ["row_id", "route_no", "booking_ref", "pax_name"]
    + [f"flight{k}" for k in SIX]
    + [f"CAST(date{k} AS VARCHAR) AS date{k}" for k in SIX]
    + [f"airport{k}" for k in range(1, 8)]
)


def _clean(d: Data, with_target: bool = True) -> CleanResult:
    rows = d.view("v_booking")
    target = clean_bookings(rows.filter(LOADED), BOOKING, "row_id").accepted if with_target else None
    return clean_bookings(rows, BOOKING, "row_id", target)


@query("b1_accepted", oracle("v_booking", f"WITH {_PIPELINE} SELECT {_OUT} FROM ranked WHERE kn = 1", True))
def b1_accepted(d: Data) -> DataFrame:
    return plain(_clean(d, with_target=False).accepted)


@query(
    "b1_accepted_new",
    oracle("v_booking", f"WITH {_WITH_TARGET} SELECT {_OUT} FROM matched WHERE NOT known", True),
)
def b1_accepted_new(d: Data) -> DataFrame:
    return plain(_clean(d).accepted)


_REJECTS = f"""{_WITH_TARGET}, {_FAILED},
rejects AS (SELECT row_id, CAST(route_no AS BIGINT) AS route_no, reason, detail FROM failed
  UNION ALL SELECT row_id, route_no, 'BATCH DUPLICATE', 'Duplicate within batch' FROM ranked WHERE kn > 1
  UNION ALL SELECT row_id, route_no, 'DB UNIQUE VIOLATION', 'Composite key already in target' FROM matched WHERE known)"""


@query(
    "b1_rejected",
    oracle(
        "v_booking",
        f"""WITH {_REJECTS} SELECT r.row_id, route_no, reason AS "RejectionReason", detail AS "RejectionDetail", {', '.join(BOOKING.columns)}
FROM rejects r JOIN v_booking b ON r.row_id = b.row_id""",
        True,
    ),
)
def b1_rejected(d: Data) -> DataFrame:
    return plain(_clean(d).rejected.drop("RejectedAt"))


@query(
    "a4_rejection_summary",
    oracle("v_booking", f'WITH {_REJECTS} SELECT reason AS "RejectionReason", count(*) AS cnt FROM rejects GROUP BY reason', True),
)
def a4(d: Data) -> DataFrame:
    return plain(_clean(d).summary())


@query(
    "a5_reconcile",
    oracle(
        "v_booking",
        f"""WITH {_REJECTS}, c AS (SELECT (SELECT count(*) FROM v_booking) AS s, (SELECT count(*) FROM matched WHERE NOT known) AS t, (SELECT count(*) FROM rejects) AS r)
SELECT s AS source_rows, t AS target_rows, r AS rejected_rows, t + r AS accounted_rows, s - t - r AS delta_rows FROM c""",
        True,
    ),
)
def a5(d: Data) -> DataFrame:
    return plain(_clean(d).reconciliation())


_KEY = ["booking_ref", "flight1", "airport1"]


@query(
    "d6_dedupe_batch",
    oracle(
        "v_booking",
        "SELECT row_id, row_number() OVER (PARTITION BY booking_ref, flight1, airport1 ORDER BY row_id) > 1 AS is_repeat FROM v_booking",
    ),
)
def d6(d: Data) -> DataFrame:
    return dedupe.flag_repeats(d.view("v_booking"), _KEY, ["row_id"]).select("row_id", "is_repeat")


def _conflict_sql(condition: str) -> str:
    return oracle(
        "v_booking",
        f"""WITH t AS (SELECT * FROM v_booking WHERE {LOADED})
SELECT row_id FROM v_booking s WHERE EXISTS (SELECT 1 FROM t WHERE {condition})""",
    )


@query("d7_conflicts", _conflict_sql(" AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in _KEY)))
def d7(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    return dedupe.match_target(rows, rows.filter(LOADED), _KEY).select("row_id")


@query(
    "d7_conflicts_trimmed",
    _conflict_sql(
        "trim(t.booking_ref) = trim(s.booking_ref) AND trim(t.flight1) = trim(s.flight1) AND t.airport1 IS NOT DISTINCT FROM s.airport1"
    ),
)
def d7_trimmed(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    return dedupe.match_target(rows, rows.filter(LOADED), _KEY, ["booking_ref", "flight1"]).select("row_id")


@query("n7_semi_join", _conflict_sql("t.pax_name = s.pax_name"))
def n7(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    return dedupe.match_target(rows, rows.filter(LOADED), ["pax_name"], ["pax_name"]).select("row_id")


@query("d8_drop_duplicates", oracle("v_leg", "SELECT DISTINCT booking_ref, dep, arr FROM v_leg"))
def d8(d: Data) -> DataFrame:
    return d.view("v_leg").select("booking_ref", "dep", "arr").dropDuplicates()


@query(
    "d9_duplicate_diagnosis",
    oracle(
        "v_booking",
        """WITH a AS (SELECT count(*) AS n FROM v_booking GROUP BY booking_ref, flight1, date1, airport1, airport2),
b AS (SELECT count(*) AS n FROM v_booking GROUP BY booking_ref, flight1), c AS (SELECT count(*) AS n FROM v_booking GROUP BY booking_ref, flight1, airport1)
SELECT 'identical_rows' AS measure, CAST(sum(n - 1) AS BIGINT) AS n FROM a UNION ALL SELECT 'excess_key_1', CAST(sum(n - 1) AS BIGINT) FROM b
UNION ALL SELECT 'excess_key_2', CAST(sum(n - 1) AS BIGINT) FROM c""",
    ),
)
def d9(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    return plain(
        dedupe.duplicate_diagnosis(
            rows, ["booking_ref", "flight1", "date1", "airport1", "airport2"], ["booking_ref", "flight1"], _KEY
        )
    )


@query(
    "n6_difference",
    oracle(
        "v_booking",
        f"""WITH t AS (SELECT * FROM v_booking WHERE {LOADED})
SELECT row_id, booking_ref, flight1 FROM v_booking s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.booking_ref IS NOT DISTINCT FROM s.booking_ref
  AND t.flight1 IS NOT DISTINCT FROM s.flight1 AND t.date1 IS NOT DISTINCT FROM s.date1)""",
    ),
)
def n6(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    done = rows.filter(LOADED).select("booking_ref", "flight1", "date1")
    return difference(rows, done).select("row_id", "booking_ref", "flight1")


@query(
    "k2_append_if_absent",
    oracle(
        "v_booking",
        f"""WITH t AS (SELECT * FROM v_booking WHERE {LOADED}),
r AS (SELECT *, row_number() OVER (PARTITION BY booking_ref, flight1, airport1 ORDER BY row_id) AS rn FROM v_booking)
SELECT row_id FROM r WHERE (booking_ref IS NULL OR flight1 IS NULL OR airport1 IS NULL) OR
  (rn = 1 AND NOT EXISTS (SELECT 1 FROM t WHERE t.booking_ref = r.booking_ref AND t.flight1 = r.flight1 AND t.airport1 = r.airport1))""",
    ),
)
def k2(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    return rows_to_append(rows, rows.filter(LOADED), _KEY, ["row_id"]).select("row_id")


@query(
    "k2_append_if_absent_nulls_equal",
    oracle(
        "v_booking",
        f"""WITH t AS (SELECT * FROM v_booking WHERE {LOADED}),
r AS (SELECT *, row_number() OVER (PARTITION BY booking_ref, flight1, airport1 ORDER BY row_id) AS rn FROM v_booking)
SELECT row_id FROM r WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM t WHERE t.booking_ref IS NOT DISTINCT FROM r.booking_ref
  AND t.flight1 IS NOT DISTINCT FROM r.flight1 AND t.airport1 IS NOT DISTINCT FROM r.airport1)""",
    ),
)
def k2_nulls(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    return rows_to_append(rows, rows.filter(LOADED), _KEY, ["row_id"], nulls_equal=True).select("row_id")


@query(
    "k3_update_from",
    """SELECT c_custkey, CASE WHEN m.n IS NOT NULL AND c_nationkey > 5 THEN m.top ELSE c_mktsegment END AS c_mktsegment, c_nationkey AS c_nationkey FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS top FROM orders GROUP BY o_custkey) m ON o_custkey = c_custkey""",
)
def k3(d: Data) -> DataFrame:
    top = d.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_mktsegment"))
    rows = d.table("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return plain(update_from(rows, top, ["c_custkey"], ["c_mktsegment"], F.col("c_nationkey") > 5))


@query(
    "k5_replace_subset",
    oracle(
        "v_booking",
        "SELECT row_id, booking_ref, CASE WHEN airport1 = airport3 THEN 'RETURN' ELSE pax_name END AS pax_name FROM v_booking",
    ),
)
def k5(d: Data) -> DataFrame:
    rows = d.view("v_booking").select("row_id", "booking_ref", "pax_name", "airport1", "airport3")
    new = replace_subset(rows, F.col("airport1") == F.col("airport3"), lambda x: x.withColumn("pax_name", F.lit("RETURN")))
    return new.select("row_id", "booking_ref", "pax_name")
