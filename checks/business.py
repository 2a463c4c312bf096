"""Dimension joins, eligibility, limits, delay, offsets, normalisers, exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import oracle
from checks.registry import Data, plain, query
from itinera.functions.dates import try_timestamp, utc_offset_hours, utc_offset_label
from itinera.operators.grouped import ends_within, shift_within
from itinera.operators.joins import (
    distinct_pairs,
    literal_map,
    lookup,
    membership,
    unique_dimension,
    update_from,
)
from itinera.operators.layout import sanitize_columns
from itinera.plans import delay, eligibility, normalise, offsets
from itinera.sinks.files import bulk_update_statements

SPECIAL = ("TK", "BA")
LIMITS = {"TK": (2.0, 2.0), "BA": (6.0, 6.0)}
AS_OF = dt.date(2001, 4, 1)

STATUS = delay.StatusColumns(
    "connection_id", "leg_no", "sched_dep", "sched_arr", "revised_arr", "runway_arr", "revised_dep", "runway_dep"
)


def _standard(d: Data) -> DataFrame:
    """The standard leg table of the booking data."""
    return (
        d.view("v_std")
        .withColumnsRenamed(
            {
                "connection_id": "ConnectionID", "leg_no": "LegNo", "fn": "FlightNumber", "carrier": "AirlineCode",
                "dep": "FromAirport", "arr": "ToAirport",
            }
        )
        .withColumn("DepartureDate", try_timestamp("dt_raw"))
        .drop("dt_raw")
    )


_CHAIN = """SELECT l.row_id, CAST(l.leg AS BIGINT) AS leg, a.country AS dep_country, b.country AS arr_country, coalesce(TRY_CAST(m.limit_l1 AS DOUBLE), 0) AS dep_l1, coalesce(TRY_CAST(n.limit_l2 AS DOUBLE), 0) AS arr_l2
FROM v_leg l LEFT JOIN v_airports a ON l.dep = a.code LEFT JOIN v_airports b ON l.arr = b.code LEFT JOIN v_limits m ON a.country = m.country LEFT JOIN v_limits n ON b.country = n.country"""


def _limit_dim(d: Data) -> DataFrame:
    return eligibility.airport_limits(
        d.view("v_airports"), d.view("v_limits"), "code", "country", "country", "limit_l1", "limit_l2"
    )


@query("n1_join_chain", oracle("v_leg v_airports v_limits", _CHAIN))
def n1(d: Data) -> DataFrame:
    dim = _limit_dim(d)
    rows = lookup(d.view("v_leg"), dim, "dep", "code", {"dep_country": "country", "dep_l1": "l1"})
    rows = lookup(rows, dim, "arr", "code", {"arr_country": "country", "arr_l2": "l2"})
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return plain(rows.select("row_id", "leg", "dep_country", "arr_country", zero("dep_l1"), zero("arr_l2")))


@query(
    "n2_membership",
    oracle("v_leg v_airports", "SELECT row_id, CAST(leg AS BIGINT) AS leg, dep IN (SELECT code FROM v_airports WHERE is_eu) AS eu FROM v_leg"),
)
def n2(d: Data) -> DataFrame:
    members = d.view("v_airports").filter("is_eu")
    return plain(membership(d.view("v_leg"), members, "dep", "code", "eu").select("row_id", "leg", "eu"))


@query(
    "n3_update_join",
    oracle(
        "v_leg v_airports",
        "SELECT l.row_id, CAST(l.leg AS BIGINT) AS leg, coalesce(a.country, l.booking_ref) AS booking_ref FROM v_leg l LEFT JOIN v_airports a ON l.dep = a.code AND a.is_eu",
    ),
)
def n3(d: Data) -> DataFrame:
    legs = d.view("v_leg").select("row_id", "leg", "booking_ref", "dep")
    new = unique_dimension(d.view("v_airports").filter("is_eu"), "code", ["country"])
    new = new.select(F.col("code").alias("dep"), F.col("country").alias("booking_ref"))
    return plain(update_from(legs, new, ["dep"], ["booking_ref"]).select("row_id", "leg", "booking_ref"))


_PAIRS = """pairs AS (SELECT upper(trim(dep)) AS airport, CAST(TRY_CAST(dt_raw AS TIMESTAMP) AS DATE) AS day FROM v_leg
UNION SELECT upper(trim(arr)), CAST(TRY_CAST(dt_raw AS TIMESTAMP) AS DATE) FROM v_leg)"""


@query("n5_distinct_pairs", oracle("v_leg", f"WITH {_PAIRS} SELECT airport, CAST(day AS VARCHAR) AS day FROM pairs WHERE airport IS NOT NULL AND day IS NOT NULL"))
def n5(d: Data) -> DataFrame:
    day = try_timestamp("dt_raw").cast("date")
    key = offsets.airport_key
    return plain(distinct_pairs(d.view("v_leg"), (key("dep"), day), (key("arr"), day), names=("airport", "day")))


@query("n8_union_all", "SELECT c_custkey AS k, c_mktsegment AS s FROM customer UNION ALL SELECT o_orderkey, o_orderstatus FROM orders")
def n8(d: Data) -> DataFrame:
    a = d.table("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("s"))
    return a.unionByName(d.table("orders").select(F.col("o_orderstatus").alias("s"), F.col("o_orderkey").alias("k")))


@query("n9_map_lookup", oracle("v_std", "SELECT connection_id, CAST(leg_no AS BIGINT) AS leg_no, CASE carrier WHEN 'TK' THEN 2.0 WHEN 'BA' THEN 6.0 ELSE 0.0 END::DOUBLE AS years FROM v_std"))
def n9(d: Data) -> DataFrame:
    years = literal_map("carrier", {k: v[0] for k, v in LIMITS.items()}, 0.0)
    return plain(d.view("v_std").select("connection_id", "leg_no", years.alias("years")))


@query(
    "w5_first_last_in_group",
    oracle(
        "v_std",
        """SELECT connection_id, CAST(leg_no AS BIGINT) AS leg_no, first_value(dep) OVER w AS first_dep, last_value(arr) OVER w AS last_arr FROM v_std
WINDOW w AS (PARTITION BY connection_id ORDER BY leg_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    ),
)
def w5(d: Data) -> DataFrame:
    rows = ends_within(d.view("v_std"), ["connection_id"], ["leg_no"], {"first_dep": "dep"}, {"last_arr": "arr"})
    return plain(rows.select("connection_id", "leg_no", "first_dep", "last_arr"))


_EU = """f AS (SELECT s.*, coalesce(a.is_eu, FALSE) AS de, coalesce(b.is_eu, FALSE) AS ae, coalesce(c.is_in_union = 1, FALSE) AS ce FROM v_std s
  LEFT JOIN v_airports a ON s.dep = a.code LEFT JOIN v_airports b ON s.arr = b.code LEFT JOIN v_airlines c ON s.carrier = c.code),
e AS (SELECT connection_id, arg_min(de, leg_no) OR bool_or(carrier IN ('TK', 'BA')) OR (arg_max(ae, leg_no) AND bool_or(de OR (ae AND ce))) AS eligible FROM f GROUP BY connection_id)"""
_EU_VIEWS = "v_std v_airports v_airlines"


def _eu_sets(d: Data) -> tuple[DataFrame, DataFrame]:
    airports = eligibility.member_set(d.view("v_airports"), "code", F.col("is_eu"))
    return airports, eligibility.member_set(d.view("v_airlines"), "code", F.col("is_in_union") == 1)


def _eligible(d: Data) -> DataFrame:
    return eligibility.eu_eligible(_standard(d), *_eu_sets(d), SPECIAL)


@query(
    "b3_eu_eligible",
    oracle(_EU_VIEWS, f'WITH {_EU} SELECT s.connection_id AS "ConnectionID", CAST(leg_no AS BIGINT) AS "LegNo", eligible AS "EUEligible" FROM v_std s JOIN e ON s.connection_id = e.connection_id'),
)
def b3(d: Data) -> DataFrame:
    return plain(_eligible(d).select("ConnectionID", "LegNo", "EUEligible"))


def _limit_sql(strict: bool) -> str:
    guard = "NOT (c1 = 0 AND c2 = 0 AND s1 IS NULL) AND " if strict else ""
    return f"""{_EU},
al AS (SELECT code, coalesce(TRY_CAST(limit_l1 AS DOUBLE), 0) AS l1, coalesce(TRY_CAST(limit_l2 AS DOUBLE), 0) AS l2 FROM v_airports a LEFT JOIN v_limits l ON a.country = l.country),
g AS (SELECT s.connection_id, max(greatest(coalesce(x.l1, 0), coalesce(y.l1, 0))) AS c1, max(greatest(coalesce(x.l2, 0), coalesce(y.l2, 0))) AS c2,
  max(CASE carrier WHEN 'TK' THEN 2.0 WHEN 'BA' THEN 6.0 END) AS s1, date_diff('day', CAST(min(TRY_CAST(dt_raw AS TIMESTAMP)) AS DATE), DATE '2001-04-01') / 365.25 AS years
  FROM v_std s JOIN e ON s.connection_id = e.connection_id AND eligible LEFT JOIN al x ON s.dep = x.code LEFT JOIN al y ON s.arr = y.code GROUP BY s.connection_id),
t AS (SELECT connection_id, {guard}(CASE WHEN c1 = 0 AND c2 = 0 THEN coalesce(s1, 0) ELSE c1 END) >= years AS l1,
  {guard}(CASE WHEN c1 = 0 AND c2 = 0 THEN coalesce(s1, 0) ELSE c2 END) >= years AS l2 FROM g)"""


_LIMIT_VIEWS = "v_std v_airports v_airlines v_limits"


def _flags(d: Data) -> DataFrame:
    """Eligibility and limits of every connection, from one aggregate over the legs."""
    airports, airlines = _eu_sets(d)
    return eligibility.connection_flags(eligibility.connection_facts(_standard(d), airports, airlines, _limit_dim(d), SPECIAL, LIMITS), AS_OF)


@query("b4_time_limits", oracle(_LIMIT_VIEWS, f'WITH {_limit_sql(False)} SELECT connection_id AS "ConnectionID", l1 AS "IsTimeLimitL1", l2 AS "IsTimeLimitL2" FROM t'))
def b4(d: Data) -> DataFrame:
    return _flags(d).where("EUEligible").select("ConnectionID", "IsTimeLimitL1", "IsTimeLimitL2")


@query(
    "b4_time_limits_applied",
    oracle(_LIMIT_VIEWS, f'WITH {_limit_sql(False)} SELECT s.connection_id AS "ConnectionID", CAST(leg_no AS BIGINT) AS "LegNo", l1 AS "IsTimeLimitL1", l2 AS "IsTimeLimitL2" FROM v_std s LEFT JOIN t ON s.connection_id = t.connection_id'),
)
def b4_applied(d: Data) -> DataFrame:
    legs = eligibility.apply_time_limits(_standard(d), _flags(d).where("EUEligible"))
    return plain(legs.select("ConnectionID", "LegNo", "IsTimeLimitL1", "IsTimeLimitL2"))


@query("b5_time_limits_strict", oracle(_LIMIT_VIEWS, f'WITH {_limit_sql(True)} SELECT connection_id AS "ConnectionID", l1 AS "IsTimeLimitL1", l2 AS "IsTimeLimitL2" FROM t'))
def b5(d: Data) -> DataFrame:
    found = _flags(d).where("EUEligible")
    return found.select("ConnectionID", F.col("IsTimeLimitL1Strict").alias("IsTimeLimitL1"), F.col("IsTimeLimitL2Strict").alias("IsTimeLimitL2"))


@query(
    "b4_time_limits_of_flagged_legs",
    oracle(_LIMIT_VIEWS, f'WITH {_limit_sql(True)} SELECT connection_id AS "ConnectionID", l1 AS "IsTimeLimitL1", l2 AS "IsTimeLimitL2" FROM t'),
)
def b4_flagged(d: Data) -> DataFrame:
    """The same over legs that carry their eligibility already, as a stored standard table does."""
    return eligibility.time_limits(_eligible(d), _limit_dim(d), AS_OF, LIMITS, strict=True)


@query(
    "a1_group_max_min",
    oracle("v_std", "SELECT connection_id, max(dep) AS last_dep, min(CAST(TRY_CAST(dt_raw AS TIMESTAMP) AS VARCHAR)) AS first_dt, CAST(max(leg_no) AS BIGINT) AS legs FROM v_std GROUP BY connection_id"),
)
def a1(d: Data) -> DataFrame:
    rows = d.view("v_std").withColumn("t", try_timestamp("dt_raw"))
    return plain(
        rows.groupBy("connection_id").agg(
            F.max("dep").alias("last_dep"), F.min("t").alias("first_dt"), F.max("leg_no").alias("legs")
        )
    )


@query(
    "a2_any_value",
    oracle("v_leg", "SELECT row_id, arg_min(arr, leg) FILTER (arr IS NOT NULL) AS arr FROM v_leg GROUP BY row_id"),
)
def a2(d: Data) -> DataFrame:
    first = F.min_by("arr", F.when(F.col("arr").isNotNull(), F.col("leg")))
    return d.view("v_leg").groupBy("row_id").agg(first.alias("arr"))


_LATER = "CASE WHEN revised_arr IS NULL THEN runway_arr WHEN runway_arr IS NULL THEN revised_arr WHEN revised_arr > runway_arr THEN revised_arr ELSE runway_arr END"
_DELAY = f"""a AS (SELECT *, {_LATER} AS actual, row_number() OVER w AS pos, count(*) OVER (PARTITION BY connection_id) AS n, lead(sched_dep) OVER w AS next_dep
  FROM v_status WINDOW w AS (PARTITION BY connection_id ORDER BY leg_no)),
b AS (SELECT *, bool_and(sched_arr IS NOT NULL AND actual IS NOT NULL) OVER (PARTITION BY connection_id) AS ok,
  min(CASE WHEN epoch(next_dep) - epoch(actual) <= 2700 THEN pos END) OVER (PARTITION BY connection_id) AS miss,
  CAST(epoch(actual) - epoch(sched_arr) AS BIGINT) AS late, CAST(epoch(next_dep) - epoch(actual) AS BIGINT) AS layover FROM a)"""


@query(
    "b6_delay",
    oracle(
        "v_status",
        f"""WITH {_DELAY} SELECT id, CAST(CASE WHEN ok AND (pos = miss OR (miss IS NULL AND pos = n AND late >= 9900)) THEN 1 ELSE 0 END AS BIGINT) AS "IsDelayEligible",
  CASE WHEN ok AND miss IS NULL AND pos = n AND late >= 9900 THEN late END AS "DelayTime", CASE WHEN ok AND pos = miss THEN layover END AS "LayOverTime", CASE WHEN ok AND pos = miss THEN pos END AS "LayOverLeg" FROM b""",
    ),
)
def b6(d: Data) -> DataFrame:
    out = delay.delay_eligibility(d.view("v_status"), STATUS)
    return plain(out.select("id", "IsDelayEligible", "DelayTime", "LayOverTime", "LayOverLeg"))


@query(
    "b6_delay_connection",
    oracle(
        "v_status",
        f"""WITH {_DELAY}, c AS (SELECT *, max(CASE WHEN pos = miss THEN layover END) OVER (PARTITION BY connection_id) AS ml, max(CASE WHEN pos = n THEN late END) OVER (PARTITION BY connection_id) AS ll FROM b)
SELECT id, CAST(CASE WHEN ok AND (miss IS NOT NULL OR ll >= 9900) THEN 1 ELSE 0 END AS BIGINT) AS "IsDelayEligible", CASE WHEN ok AND miss IS NOT NULL THEN ml WHEN ok AND ll >= 9900 THEN ll END AS "DelayTime",
  CASE WHEN ok AND miss IS NOT NULL THEN ml END AS "LayOverTime", CASE WHEN ok THEN miss END AS "LayOverLeg" FROM c""",
    ),
)
def b6_connection(d: Data) -> DataFrame:
    out = delay.delay_eligibility(d.view("v_status"), STATUS, mark="connection", layover_as_delay=True)
    return plain(out.select("id", "IsDelayEligible", "DelayTime", "LayOverTime", "LayOverLeg"))


@query("b6_incomplete_log", oracle("v_status", f"SELECT id FROM v_status WHERE sched_arr IS NULL OR ({_LATER}) IS NULL"))
def b6_log(d: Data) -> DataFrame:
    return delay.incomplete_legs(d.view("v_status"), STATUS).select("id")


_ROWS = f"""u AS (SELECT id, connection_id, leg_no, strftime(sched_arr, '%Y-%m-%d %H:%M:%S') AS sa, strftime({_LATER}, '%Y-%m-%d %H:%M:%S') AS aa, strftime(sched_dep, '%Y-%m-%d %H:%M:%S') AS sd,
  strftime(CASE WHEN revised_dep IS NULL THEN runway_dep WHEN runway_dep IS NULL THEN revised_dep ELSE greatest(revised_dep, runway_dep) END, '%Y-%m-%d %H:%M:%S') AS ad,
  CAST(epoch({_LATER}) - epoch(sched_arr) AS BIGINT) AS secs FROM v_status)"""


def _update_rows(d: Data) -> DataFrame:
    from itinera.functions.dates import later_of, seconds_between

    late = seconds_between("sched_arr", later_of("revised_arr", "runway_arr"))
    return d.view("v_status").withColumn("secs", late)


@query(
    "b8_delay_update_rows",
    oracle("v_status", f'WITH {_ROWS} SELECT id AS "Id", secs AS "DelayInSecond", sa AS "ScheduledArrivalTimeLocal", aa AS "ActualArrivalTimeLocal", sd AS "ScheduledDepartureTimeLocal", ad AS "ActualDepartureTimeLocal" FROM u'),
)
def b8(d: Data) -> DataFrame:
    return plain(delay.delay_update_rows(_update_rows(d), STATUS, "id", "secs"))


_Q = "coalesce('''' || replace(CAST({c} AS VARCHAR), '''', '''''') || '''', 'NULL')"


@query(
    "k8_bulk_update",
    oracle(
        "v_status",
        f"""WITH {_ROWS}, v AS (SELECT *, row_number() OVER (ORDER BY connection_id, leg_no) AS n, concat('(', {_Q.format(c='id')}, ',', {_Q.format(c='secs')}, ',', {_Q.format(c='aa')}, ')') AS t FROM u)
SELECT CAST(floor((n - 1) / 1000) + 1 AS BIGINT) AS statement_no, concat('UPDATE t', chr(10), 'SET t.secs = u.secs,', chr(10), '    t.aa = u.aa', chr(10), 'FROM flights t', chr(10), 'JOIN (', chr(10), '    VALUES', chr(10), '    ',
  string_agg(t, concat(',', chr(10), '    ') ORDER BY n), chr(10), ') AS u(id, secs, aa)', chr(10), 'ON t.id = u.id;') AS sql FROM v GROUP BY 1""",
    ),
)
def k8(d: Data) -> DataFrame:
    rows = delay.delay_update_rows(_update_rows(d), STATUS, "id", "secs")
    rows = rows.select(
        F.col("Id").alias("id"),
        F.col("DelayInSecond").alias("secs"),
        F.col("ActualArrivalTimeLocal").alias("aa"),
        F.split_part("Id", F.lit("-"), F.lit(1)).cast("bigint").alias("connection_id"),
        F.split_part("Id", F.lit("-"), F.lit(2)).cast("int").alias("leg_no"),
    )
    return plain(bulk_update_statements(rows, "flights", "id", ["connection_id", "leg_no"]))


@query(
    "w4_next_row",
    oracle("v_status", "SELECT id, CAST(lead(sched_dep) OVER (PARTITION BY connection_id ORDER BY leg_no) AS VARCHAR) AS next_dep, row_number() OVER (PARTITION BY connection_id ORDER BY leg_no) AS pos FROM v_status"),
)
def w4(d: Data) -> DataFrame:
    rows = shift_within(d.view("v_status"), ["connection_id"], ["leg_no"], {"next_dep": ("sched_dep", 1)}, rank="pos")
    return plain(rows.select("id", "next_dep", "pos"))


_ZONES = "z AS (SELECT upper(trim(iata)) AS code, min(timezone) AS zone FROM v_tz WHERE timezone LIKE '%/%' AND timezone <> 'Mars/Base' OR timezone = 'UTC' GROUP BY 1)"
_HOURS = "(epoch({n}) - epoch(timezone({z}, {n}))) / 3600.0"
_NOON = "(CAST({d} AS TIMESTAMP) + INTERVAL '12' HOUR)"


def _label(h: str) -> str:
    return f"CASE WHEN {h} = trunc({h}) THEN printf('%+d', CAST({h} AS INT)) ELSE printf('%+.1f', {h}) END"


@query(
    "b7_utc_offset",
    oracle(
        "v_leg v_tz",
        f"""WITH {_ZONES}, l AS (SELECT *, {_NOON.format(d='CAST(TRY_CAST(dt_raw AS TIMESTAMP) AS DATE)')} AS noon FROM v_leg),
h AS (SELECT row_id, leg, {_HOURS.format(n='noon', z='x.zone')} AS dh, {_HOURS.format(n='noon', z='y.zone')} AS ah FROM l LEFT JOIN z x ON upper(trim(dep)) = x.code LEFT JOIN z y ON upper(trim(arr)) = y.code)
SELECT row_id, CAST(leg AS BIGINT) AS leg, {_label('dh')} AS dep_offset, {_label('ah')} AS arr_offset FROM h""",
    ),
)
def b7(d: Data) -> DataFrame:
    zones = offsets.zone_dimension(d.view("v_tz"), "iata", "timezone")
    rows = d.view("v_leg").withColumn("t", try_timestamp("dt_raw"))
    out = offsets.enrich_utc_offset(rows, "t", {"dep": "dep_offset", "arr": "arr_offset"}, zones)
    return plain(out.select("row_id", "leg", "dep_offset", "arr_offset"))


@query(
    "n4_offset_lookup",
    oracle(
        "v_leg v_tz",
        f"""WITH {_ZONES}, {_PAIRS}, h AS (SELECT airport, day, {_HOURS.format(n=_NOON.format(d='day'), z='zone')} AS h FROM pairs LEFT JOIN z ON airport = code WHERE airport IS NOT NULL AND day IS NOT NULL)
SELECT airport, CAST(day AS VARCHAR) AS day, h AS utc_offset FROM h""",
    ),
)
def n4(d: Data) -> DataFrame:
    zones = offsets.zone_dimension(d.view("v_tz"), "iata", "timezone")
    rows = d.view("v_leg").withColumn("t", try_timestamp("dt_raw"))
    return plain(offsets.offset_lookup(rows, "t", "dep", "arr", zones, kind="hours"))


_ZONE_CASE = "CASE o_orderkey % 3 WHEN 0 THEN 'Europe/London' WHEN 1 THEN 'Asia/Kolkata' ELSE 'America/New_York' END"


@query(
    "c29_utc_offset_label",
    f"""WITH l AS (SELECT o_orderkey, {_ZONE_CASE} AS zone, {_NOON.format(d='CAST(o_orderdate AS DATE)')} AS noon FROM orders),
h AS (SELECT o_orderkey, {_HOURS.format(n='noon', z='zone')} AS h FROM l)
SELECT o_orderkey, h AS hours, {_label('h')} AS label, printf('%+d', CAST(trunc(h) AS INT)) AS whole FROM h""",
)
def c29(d: Data) -> DataFrame:
    k = F.col("o_orderkey") % 3
    zone = F.when(k == 0, "Europe/London").when(k == 1, "Asia/Kolkata").otherwise("America/New_York")
    rows = d.table("orders").withColumn("zone", zone)
    return plain(
        rows.select(
            "o_orderkey",
            utc_offset_hours("o_orderdate", "zone").alias("hours"),
            utc_offset_label("o_orderdate", "zone").alias("label"),
            utc_offset_label("o_orderdate", "zone", truncate=True).alias("whole"),
        )
    )


@query(
    "b9_normalise_by_role",
    oracle(
        "v_booking",
        r"""WITH m AS (SELECT row_id, trim(pax_name) AS "PaxName", CASE WHEN trim(flight1) NOT IN ('', 'NULL', 'None') THEN trim(flight1) END AS f, CASE WHEN trim(date1) NOT IN ('', 'NULL', 'None') THEN trim(date1) END AS t FROM v_booking)
SELECT CAST(row_id AS VARCHAR) AS row_id, "PaxName", CASE WHEN regexp_full_match(upper(f), '[A-Z0-9]{2,3}[-\s]?[0-9]+') THEN regexp_replace(upper(f), '^([A-Z0-9]{2,3})[-\s]?0*([0-9]+)$', '\1\2') ELSE f END AS "FlightNumber1",
  coalesce(CAST(CAST(TRY_CAST(t AS TIMESTAMP) AS DATE) AS VARCHAR), t) AS "FlightDate1" FROM m""",
    ),
)
def b9_role(d: Data) -> DataFrame:
    rows = d.view("v_booking").select(
        "row_id", F.col("pax_name").alias("PaxName"), F.col("flight1").alias("FlightNumber1"), F.col("date1").alias("FlightDate1")
    )
    return normalise.normalise_by_role(rows, normalise.MIXED_ROLES, day_first=False, space_in_number=True)


#: A row has six sectors, so it names at most twelve airports.
WIDEST_CHAIN = 12


@query(
    "b9_normalise_token_lists",
    oracle(
        "v_lists",
        r"""WITH t AS (SELECT row_id, CASE WHEN first_date <> 'NULL' THEN first_date END AS fd, CASE WHEN flights = '' THEN [] ELSE regexp_split_to_array(flights, '\s+') END AS f,
  CASE WHEN short_dates = '' THEN [] ELSE regexp_split_to_array(short_dates, '\s+') END AS s FROM v_lists),
d AS (SELECT *, list_filter(list_transform(s, lambda x: CAST(CAST(try_strptime(x || substr(fd, 1, 4), '%d%b%Y') AS DATE) AS VARCHAR)), lambda x: x IS NOT NULL) AS days FROM t),
u AS (SELECT row_id, unnest(regexp_split_to_array(sectors, '[\s/]+')) AS code, generate_subscripts(regexp_split_to_array(sectors, '[\s/]+'), 1) AS i FROM v_lists WHERE sectors <> ''),
g AS (SELECT row_id, code, min(i) AS i FROM u WHERE code <> '' GROUP BY row_id, code), j AS (SELECT row_id, list(code ORDER BY i) AS a FROM g GROUP BY row_id)
SELECT d.row_id, fd AS "FirstSectordate", """
        + ", ".join(
            [f'days[{k}] AS "FTDA{k}"' for k in range(1, 7)]
            + ["regexp_replace(f[%d], '([A-Z0-9]{2})-([0-9]+)', '\\1\\2') AS \"FlightNo%d\"" % (k, k) for k in range(1, 7)]
            + [f'a[{k}] AS "Airport{k}"' for k in range(1, WIDEST_CHAIN + 1)]
        )
        + " FROM d LEFT JOIN j ON d.row_id = j.row_id",
    ),
)
def b9_lists(d: Data) -> DataFrame:
    rows = d.view("v_lists").select(
        "row_id",
        F.col("first_date").alias("FirstSectordate"),
        F.col("flights").alias("FlightNo"),
        F.col("sectors").alias("Sector"),
        F.col("short_dates").alias("FTDA"),
    )
    return normalise.normalise_token_lists(rows, date_columns=["FirstSectordate"], widths=(6, WIDEST_CHAIN, 6))


@query(
    "b9_normalise_settlement",
    oracle(
        "v_lists",
        r"""WITH t AS (SELECT row_id, first_date, CASE WHEN flights = '' THEN [] ELSE regexp_split_to_array(flights, '\s+') END AS f,
  CASE WHEN short_dates = '' THEN [] ELSE regexp_split_to_array(short_dates, '\s+') END AS s, CASE WHEN sectors = '' THEN [] ELSE regexp_split_to_array(sectors, '\s+') END AS p FROM v_lists)
SELECT row_id, first_date AS "DAIS", """
        + ", ".join(
            [f"""CAST(CAST(try_strptime(s[{k}] || CAST(year(TRY_CAST(first_date AS TIMESTAMP)) AS VARCHAR), '%d%b%Y') AS DATE) AS VARCHAR) AS "FlightDate{k}\"""" for k in range(1, 7)]
            + [f'f[{k}] AS "FlightNumber{k}"' for k in range(1, 7)]
            + ["""coalesce(split_part(p[1], '/', 1), '') AS "Airport1\""""]
            + [f"""coalesce(split_part(p[{k}], '/', 2), '') AS "Airport{k + 1}\"""" for k in range(1, 7)]
        )
        + " FROM t",
    ),
)
def b9_settlement(d: Data) -> DataFrame:
    rows = d.view("v_lists").select(
        "row_id",
        F.col("first_date").alias("DAIS"),
        F.col("short_dates").alias("FTDA"),
        F.col("flights").alias("FlightNo"),
        F.col("sectors").alias("Sector"),
        F.lit("x").alias("WEEK"),
    )
    return plain(normalise.normalise_settlement(rows, drop=["WEEK"], widths=(6, 6, 6)))


@query(
    "b9_normalise_pairs",
    oracle(
        "v_lists",
        r"""WITH p AS (SELECT row_id, CAST(row_id AS VARCHAR) AS k, CASE WHEN flights <> '' THEN NULLIF(replace(trim(split_part(replace(flights, '-', ' '), '/', 1)), ' ', ''), '') END AS f, replace(sector1, '/', ' - ') AS s FROM v_lists),
q AS (SELECT *, CASE WHEN s <> '' THEN NULLIF(trim(split_part(s, '-', 1)), '') END AS a, CASE WHEN s <> '' THEN NULLIF(trim(split_part(s, '-', 2)), '') END AS b FROM p)
SELECT k AS row_id, f AS "FLIGHTNO", a AS "Airport1", b AS "Airport2", sha256(concat(k, chr(1), coalesce(f, chr(0)), chr(1), coalesce(a, chr(0)), chr(1), coalesce(b, chr(0)))) AS "Id" FROM q""",
    ),
)
def b9_pairs(d: Data) -> DataFrame:
    rows = d.view("v_lists").select(
        F.col("row_id").cast("string").alias("row_id"),
        F.replace("flights", F.lit("-"), F.lit(" ")).alias("FLIGHTNO"),
        F.replace("sector1", F.lit("/"), F.lit(" - ")).alias("SECTOR"),
    )
    return normalise.normalise_pairs(rows)


@query(
    "b9_normalise_tickets",
    """SELECT sha256(concat(CAST(o_orderkey AS VARCHAR), chr(1), o_orderstatus, chr(1), CAST(o_orderdate AS VARCHAR))) AS id, CAST(o_orderkey AS VARCHAR) AS ticket_number, o_orderstatus AS status, CAST(o_orderdate AS VARCHAR) AS ticketdate FROM orders""",
)
def b9_tickets(d: Data) -> DataFrame:
    rows = d.table("orders").select(
        F.col("o_orderkey").alias("Ticket Number"), F.col("o_orderstatus").alias(" Status"), F.col("o_orderdate").alias("TicketDate")
    )
    return plain(normalise.normalise_tickets(rows, ["TicketDate"]))


@query("s14_sanitize_columns", 'SELECT o_orderkey AS "order_key", o_orderstatus AS "order_status" FROM orders')
def s14(d: Data) -> DataFrame:
    rows = d.table("orders").select(F.col("o_orderkey").alias(" Order Key"), F.col("o_orderstatus").alias("Order-Status "))
    return sanitize_columns(rows)
