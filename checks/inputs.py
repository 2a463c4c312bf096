"""Booking, airport, limit, zone and status data derived from the driver tables.

The texts run unchanged on both engines. They cover every row of the tables they read.
"""

from __future__ import annotations

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _listed(item: str) -> str:
    """A blank-separated list of an item of all legs of a row."""
    cells = " || ' ' || ".join(f"coalesce(max(CASE WHEN leg = {k} THEN {item} END), '')" for k in range(1, 7))
    return f"trim({cells})"


VIEWS: dict[str, str] = {
    # one row per order line as a leg; every six lines of an order make one booking row
    "v_leg": """
WITH n AS (
  SELECT o_orderkey, o_custkey, l_partkey, l_suppkey, o_orderdate,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS seq
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT n.*, o_orderkey * 100 + CAST(floor((seq - 1) / 6) AS BIGINT) AS row_id, (seq - 1) % 6 + 1 AS leg FROM n),
k AS (
  SELECT p.*, lead(l_suppkey) OVER (PARTITION BY row_id ORDER BY leg) AS next_supp,
         first_value(l_suppkey) OVER (PARTITION BY row_id ORDER BY leg) AS first_supp
  FROM p)
SELECT row_id,
  concat('R', CAST(o_custkey % 500 AS VARCHAR(20))) AS booking_ref,
  concat('P', CAST(o_custkey AS VARCHAR(20))) AS pax_name,
  CAST(leg AS INT) AS leg,
  CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 23 = 1 THEN '' WHEN l_partkey % 23 = 2 THEN '60000000'
       WHEN l_partkey % 23 = 3 THEN 'TK000' WHEN l_partkey % 23 = 4 THEN 'LH1234567890' WHEN l_partkey % 23 = 5 THEN 'G8'
       ELSE concat(CASE l_suppkey % 6 WHEN 0 THEN 'TK' WHEN 1 THEN 'BA' WHEN 2 THEN 'lh' WHEN 3 THEN ' AF ' WHEN 4 THEN '6E' ELSE 'DL' END,
                   lpad(CAST(l_partkey % 1000 + 1 AS VARCHAR(10)), 5, '0')) END AS fn_raw,
  CASE WHEN l_suppkey % 17 = 0 THEN 'bad-date' WHEN l_suppkey % 29 = 0 THEN NULL
       ELSE CAST(o_orderdate + (leg * 8 + (l_partkey % 3) * 20) * INTERVAL '1' HOUR AS VARCHAR(19)) END AS dt_raw,
  concat('S', CAST(l_suppkey AS VARCHAR(20))) AS dep,
  CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE
  concat('S', CAST(CASE WHEN next_supp IS NOT NULL THEN next_supp WHEN l_partkey % 4 = 0 THEN first_supp ELSE l_partkey % 10 END AS VARCHAR(20))) END AS arr
FROM k""",
    "v_booking": """
SELECT row_id, booking_ref, pax_name,
"""
    + ",\n".join(
        [f"  max(CASE WHEN leg = {i} THEN fn_raw END) AS flight{i}" for i in range(1, 7)]
        + [f"  max(CASE WHEN leg = {i} THEN dt_raw END) AS date{i}" for i in range(1, 7)]
        + ["  max(CASE WHEN leg = 1 THEN dep END) AS airport1"]
        + [f"  max(CASE WHEN leg = {i} THEN arr END) AS airport{i + 1}" for i in range(1, 7)]
    )
    + "\nFROM v_leg GROUP BY row_id, booking_ref, pax_name",
    "v_airports": """
SELECT concat('S', CAST(s_suppkey AS VARCHAR(20))) AS code, n_name AS country, r_name = 'EUROPE' AS is_eu
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    # carriers and whether they are union carriers: taken from the leg data, so the table grows with it
    "v_airlines": """
SELECT code, CASE WHEN code IN ('LH', 'AF') THEN 1 ELSE 0 END AS is_in_union
FROM (SELECT DISTINCT substr(trim(upper(fn_raw)), 1, 2) AS code FROM v_leg WHERE fn_raw <> '') q""",
    "v_limits": """
SELECT n_name AS country, CAST(n_nationkey % 7 AS VARCHAR(5)) AS limit_l1,
  CASE WHEN n_nationkey % 11 = 0 THEN 'n/a' ELSE CAST(n_nationkey % 4 AS VARCHAR(5)) END AS limit_l2
FROM nation WHERE n_nationkey % 5 <> 0""",
    "v_tz": """
SELECT concat('S', CAST(s_suppkey AS VARCHAR(20))) AS iata,
  CASE s_suppkey % 6 WHEN 0 THEN 'Europe/London' WHEN 1 THEN 'Asia/Kolkata' WHEN 2 THEN 'America/New_York'
    WHEN 3 THEN 'UTC' WHEN 4 THEN NULL ELSE 'Mars/Base' END AS timezone
FROM supplier""",
    "v_status": """
SELECT concat(CAST(o_orderkey AS VARCHAR(20)), '-', CAST(leg AS VARCHAR(5))) AS id, o_orderkey AS connection_id,
  CAST(leg AS INT) AS leg_no, sched_dep, sched_dep + INTERVAL '2' HOUR AS sched_arr,
  CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE sched_dep + (120 + l_partkey % 260) * INTERVAL '1' MINUTE END AS revised_arr,
  CASE WHEN l_partkey % 3 <> 0 THEN NULL ELSE sched_dep + (125 + l_suppkey % 200) * INTERVAL '1' MINUTE END AS runway_arr,
  CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE sched_dep + (l_suppkey % 50) * INTERVAL '1' MINUTE END AS revised_dep,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE sched_dep + (l_partkey % 40) * INTERVAL '1' MINUTE END AS runway_dep
FROM (SELECT o_orderkey, l_partkey, l_suppkey,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS leg,
        o_orderdate + (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) * 5) * INTERVAL '1' HOUR AS sched_dep
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) q""",
    # standard leg table: text-only legs with complete slots
    "v_std": """
SELECT row_id AS connection_id, leg AS leg_no, upper(replace(fn_raw, ' ', '')) AS fn,
  substr(upper(replace(fn_raw, ' ', '')), 1, 2) AS carrier, dt_raw, dep, arr
FROM v_leg WHERE trim(fn_raw) <> '' AND dt_raw IS NOT NULL AND dt_raw <> 'bad-date' AND arr IS NOT NULL""",
    # settlement-style lines: token lists built from the lines of each order
    "v_lists": """
SELECT row_id, booking_ref,
  CASE WHEN row_id % 19 = 0 THEN 'NULL' ELSE substr(max(CASE WHEN leg = 1 AND dt_raw <> 'bad-date' THEN dt_raw END), 1, 10) END AS first_date,
  """ + _listed("flight") + """ AS flights,
  """ + _listed("sector") + """ AS sectors,
  """ + _listed("short") + """ AS short_dates,
  """ + ", ".join(f"{'CASE WHEN row_id % 7 = 0 THEN ' + chr(39) + 'VOID' + chr(39) + ' ELSE ' if k == 2 else ''}max(CASE WHEN leg = {k} THEN sector END){' END' if k == 2 else ''} AS sector{k}" for k in range(1, 7)) + """
FROM (SELECT *, substr(replace(upper(fn_raw), ' ', ''), 1, 2) || '-' || substr(replace(upper(fn_raw), ' ', ''), 3) AS flight, dep || '/' || arr AS sector,
    CASE WHEN dt_raw <> 'bad-date' THEN substr(dt_raw, 9, 2) || substr('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', CAST(substr(dt_raw, 6, 2) AS INT) * 3 - 2, 3) END AS short FROM v_leg) q
GROUP BY row_id, booking_ref""",
}


# Views that are written out before use: the fact tables.
STORED = {"v_leg", "v_booking", "v_status", "v_std", "v_lists"}


def needs(*names: str) -> list[str]:
    """The views with everything they stand on, in build order."""
    out: list[str] = []

    def visit(name: str) -> None:
        for other in VIEWS:
            if other != name and other in VIEWS[name]:
                visit(other)
        if name not in out:
            out.append(name)

    for n in names:
        visit(n)
    return out


def oracle(views: str, body: str, recursive: bool = False) -> str:
    """SQL with the views inlined; ``body`` may start with further CTEs after ``WITH``."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in needs(*views.split())]
    head = "WITH RECURSIVE " if recursive else "WITH "
    text = body.strip()
    if text.upper().startswith("WITH "):
        return head + ",\n".join(parts) + ",\n" + text[5:]
    return head + ",\n".join(parts) + "\n" + text


# SQL of single rules, shared by several oracles.
def sql_c1(x: str, carrier: str = "[A-Z]{2,3}") -> str:
    return rf"NULLIF(regexp_replace(replace(trim(upper({x})), ' ', ''), '^({carrier})0+([1-9][0-9]*)$', '\1\2'), '')"


def sql_c4(x: str) -> str:
    return rf"regexp_replace(upper(trim({x})), '^([A-Z]{{2,3}})0+([0-9]+)$', '\1\2')"


def sql_ts(x: str) -> str:
    return f"TRY_CAST({x} AS TIMESTAMP)"


def sql_date(x: str, lo: int = 1996, hi: int = 2000) -> str:
    return f"CASE WHEN year({sql_ts(x)}) BETWEEN {lo} AND {hi} THEN {sql_ts(x)} END"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_reason(fn: str, dt: str) -> str:
    return rf"""CASE WHEN {fn} IS NULL THEN 'FlightNumber NULL' WHEN {dt} IS NULL THEN 'FlightDate NULL'
  WHEN {fn} = '' THEN 'FlightNumber EMPTY' WHEN regexp_full_match({fn}, '[0-9]+') THEN 'FlightNumber PURELY_NUMERIC'
  WHEN length({fn}) > 8 THEN 'FlightNumber TOO_LONG'
  WHEN regexp_full_match(rtrim({fn}, '0'), '[A-Za-z]+') THEN 'FlightNumber ALL_ALPHA_AFTER_STRIP'
  WHEN NOT regexp_full_match(upper({fn}), '[A-Z0-9]{{2,3}}[0-9]+') THEN 'FlightNumber BAD_FORMAT' END"""


# Slots of every booking row, normalised, with the reject reason: the base of the cleaner's oracles.
SLOTS = (
    "slots AS ("
    + " UNION ALL ".join(
        f"SELECT row_id, {i} AS slot, {sql_c1(f'flight{i}')} AS fn, {sql_ts(f'date{i}')} AS dt, "
        f"airport{i} AS dep, airport{i + 1} AS arr FROM v_booking"
        for i in range(1, 7)
    )
    + ")"
)
LEGS = f"""{SLOTS},
tagged AS (SELECT *, {sql_reason('fn', 'dt')} AS reason FROM slots),
legs AS (SELECT * FROM tagged WHERE reason IS NULL)"""


def sql_fold(legs: str, order: str, same: str) -> str:
    """Routes of ordered legs by recursion; ``same`` compares ``o`` (current) with ``f`` (state so far)."""
    return f"""o AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {order}) AS n FROM {legs}),
f AS (SELECT row_id, n, dt, dt AS anchor, 1 AS route_no FROM o WHERE n = 1
  UNION ALL
  SELECT o.row_id, o.n, o.dt, CASE WHEN {same} THEN f.anchor ELSE o.dt END, CASE WHEN {same} THEN f.route_no ELSE f.route_no + 1 END
  FROM f JOIN o ON o.row_id = f.row_id AND o.n = f.n + 1),
routed AS (SELECT o.*, f.route_no, row_number() OVER (PARTITION BY o.row_id, f.route_no ORDER BY o.n) AS leg_no
  FROM o JOIN f ON o.row_id = f.row_id AND o.n = f.n)"""


ANCHORED = "abs(epoch(o.dt) - epoch(f.anchor)) <= 86400"
