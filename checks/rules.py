"""Scalar rules over leg, list and text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import oracle, sql_c1, sql_c4, sql_date, sql_reason, sql_strip, sql_ts
from checks.registry import Data, plain, query
from itinera.functions import chains, dates, flights, text
from itinera.functions.registry import register_sql_functions
from itinera.operators.layout import align_schema, cast_columns, reorder_after
from itinera.spec import classify_columns, detect_slots

# Leg rows plus odd spellings of the flight number, so that every rule has something to do.
_SPELLED = """WITH m AS (SELECT row_id, CAST(leg AS BIGINT) AS leg, fn_raw,
  CASE WHEN row_id % 5 = 0 THEN substr(trim(fn_raw), 1, 2) || '-' || substr(trim(fn_raw), 3) WHEN row_id % 5 = 1 THEN ' ' || substr(trim(fn_raw), 1, 2) || ' ' || substr(trim(fn_raw), 3)
       WHEN row_id % 5 = 2 THEN fn_raw || ' / BA 12' WHEN row_id % 5 = 3 THEN lower(fn_raw) ELSE fn_raw END AS x FROM v_leg)"""


def _spelled(d: Data) -> DataFrame:
    d.view("v_leg")
    return d.spark.sql(_SPELLED + " SELECT * FROM m")


def _rule(name: str, sql: str, column) -> None:
    """One rule over the spelled flight numbers: key columns plus ``y``."""

    @query(name, oracle("v_leg", f"{_SPELLED} SELECT row_id, leg, {sql} AS y FROM m"))
    def run(d: Data) -> DataFrame:
        return plain(_spelled(d).select("row_id", "leg", column().alias("y")))


_rule("c1_normalize_flight", sql_c1("x"), lambda: flights.normalize_flight("x"))
_rule(
    "c1_normalize_flight_digit_carrier",
    sql_c1("x", r"[A-Z]{2,3}|\d[A-Z]"),
    lambda: flights.normalize_flight("x", flights.LETTERS_OR_DIGIT_LETTER),
)
_rule(
    "c2_normalize_flight_alnum",
    r"NULLIF(regexp_replace(regexp_replace(upper(x), '[^A-Z0-9]', '', 'g'), '^([A-Z]{2,3})0+([1-9][0-9]*)$', '\1\2'), '')",
    lambda: flights.normalize_flight_alnum("x"),
)
_rule(
    "c3_extract_flight",
    "NULLIF(regexp_extract(replace(trim(upper(x)), ' ', ''), '^([A-Z]{2,3}[0-9]+)', 1), '')",
    lambda: flights.extract_flight("x"),
)
_rule("c4_normalize_flight_sql", sql_c4("x"), lambda: flights.normalize_flight_keep_digit("x"))
_rule(
    "c4_normalize_flight_inner_spaces",
    r"CASE WHEN regexp_full_match(upper(trim(x)), '[A-Z]{2,3}\s*[0-9]+') THEN regexp_replace(regexp_replace(upper(trim(x)), '\s+', ''), '^([A-Z]{2,3})0+([0-9]+)$', '\1\2') ELSE upper(trim(x)) END",
    lambda: flights.normalize_flight_keep_digit("x", inner_spaces=True),
)
_rule(
    "c5_normalize_flight_int",
    rf"regexp_replace(upper({sql_strip('x')}), '^([A-Z]{{2,3}})0*([0-9]+)$', '\1\2')",
    lambda: flights.normalize_flight_integer("x"),
)
_HYPHEN = rf"""CASE WHEN {sql_strip('x')} IN ('', 'NULL', 'None') THEN NULL
  WHEN regexp_full_match(upper({sql_strip('x')}), '[A-Z0-9]{{2,3}}%s[0-9]+') THEN regexp_replace(upper({sql_strip('x')}), '^([A-Z0-9]{{2,3}})%s0*([0-9]+)$', '\1\2') ELSE {sql_strip('x')} END"""
_rule("c6_normalize_flight_hyphen", _HYPHEN % ("-?", "-?"), lambda: flights.normalize_flight_hyphen("x"))
_rule(
    "c6_normalize_flight_hyphen_space",
    _HYPHEN % (r"[-\s]?", r"[-\s]?"),
    lambda: flights.normalize_flight_hyphen("x", allow_space=True),
)
_rule(
    "c7_first_flight_of_pair",
    f"CASE WHEN {sql_strip('x')} NOT IN ('', 'NULL', 'None') THEN NULLIF(replace(trim(split_part(x, '/', 1)), ' ', ''), '') END",
    lambda: flights.first_flight_of_pair("x"),
)
_rule(
    "c8_strip_prefix_zeros",
    r"regexp_replace(upper(x), '^([A-Z]{2,3})0*', '\1')",
    lambda: flights.strip_prefix_zeros("x"),
)
_rule("c17_null_tokens", f"CASE WHEN {sql_strip('x')} NOT IN ('', 'NULL', 'None') THEN {sql_strip('x')} END", lambda: text.null_tokens("x"))
_rule(
    "c18_carrier_of",
    "CASE WHEN regexp_matches(upper(x), '^[A-Z0-9]{2}') THEN substr(upper(x), 1, 2) ELSE '' END",
    lambda: flights.carrier_of("x"),
)
_rule("c24_first_of_list", "NULLIF(trim(split_part(x, '/', 1)), '')", lambda: text.first_of_list("x", "/"))
_rule("c25_blank_to_null", f"NULLIF({sql_strip('x')}, '')", lambda: text.blank_to_null("x"))


@query(
    "c10_reject_reason",
    oracle(
        "v_leg",
        f"""WITH m AS (SELECT row_id, CAST(leg AS BIGINT) AS leg, {sql_c1('fn_raw')} AS fn, {sql_ts('dt_raw')} AS dt FROM v_leg),
r AS (SELECT *, {sql_reason('fn', 'dt')} AS reason FROM m)
SELECT row_id, leg, reason, CASE WHEN reason = 'FlightNumber NULL' AND dt IS NULL THEN 'fn=None, dt=NaT' WHEN reason = 'FlightNumber NULL' THEN 'fn=None' WHEN reason = 'FlightDate NULL' THEN 'dt=NaT'
  WHEN reason = 'FlightNumber TOO_LONG' THEN concat('fn=''', fn, ''' len=', length(fn)) WHEN reason IS NOT NULL THEN concat('fn=''', fn, '''') END AS detail FROM r""",
    ),
)
def c10(d: Data) -> DataFrame:
    legs = d.view("v_leg").withColumns(
        {"fn": flights.normalize_flight("fn_raw"), "dt": dates.try_timestamp("dt_raw")}
    )
    legs = legs.withColumn("reason", flights.flight_reject_reason("fn", "dt"))
    return plain(legs.select("row_id", "leg", "reason", flights.flight_reject_detail("fn", "reason", "dt").alias("detail")))


_ALPHA = "(rtrim(fn, '0') = '' OR regexp_full_match(rtrim(fn, '0'), '[A-Za-z]+'))"


@query(
    "c11_valid_lenient",
    oracle(
        "v_leg",
        f"""WITH m AS (SELECT row_id, CAST(leg AS BIGINT) AS leg, {sql_c1('fn_raw')} AS fn, {sql_ts('dt_raw')} AS dt FROM v_leg)
SELECT row_id, leg, coalesce(fn <> '' AND dt IS NOT NULL AND NOT {_ALPHA}, FALSE) AS minimal,
  coalesce(fn <> '' AND dt IS NOT NULL AND NOT regexp_full_match(fn, '[0-9]+') AND NOT {_ALPHA}, FALSE) AS no_numeric,
  coalesce(fn <> '' AND dt IS NOT NULL AND NOT (regexp_full_match(fn, '[0-9]+') AND length(fn) > 8) AND length(fn) <= 10 AND NOT {_ALPHA}
    AND (regexp_full_match(fn, '[0-9]+') OR regexp_full_match(fn, '[A-Z0-9]{{2,3}}[0-9]+')), FALSE) AS digits_allowed FROM m""",
    ),
)
def c11(d: Data) -> DataFrame:
    legs = d.view("v_leg").withColumns(
        {"fn": flights.normalize_flight("fn_raw"), "dt": dates.try_timestamp("dt_raw")}
    )
    valid = lambda r: flights.is_valid_flight("fn", "dt", r)
    return plain(
        legs.select(
            "row_id",
            "leg",
            valid(flights.MINIMAL).alias("minimal"),
            valid(flights.MINIMAL_NO_NUMERIC).alias("no_numeric"),
            valid(flights.DIGITS_ALLOWED).alias("digits_allowed"),
        )
    )


@query("c12_try_timestamp", oracle("v_leg", f"SELECT row_id, CAST(leg AS BIGINT) AS leg, CAST({sql_ts('dt_raw')} AS VARCHAR) AS dt FROM v_leg"))
def c12(d: Data) -> DataFrame:
    return plain(d.view("v_leg").select("row_id", "leg", dates.try_timestamp("dt_raw").alias("dt")))


@query(
    "c13_normalize_date",
    oracle("v_leg", f"SELECT row_id, CAST(leg AS BIGINT) AS leg, CAST({sql_date('dt_raw')} AS VARCHAR) AS dt, CAST(CAST({sql_date('dt_raw')} AS DATE) AS VARCHAR) AS day FROM v_leg"),
)
def c13(d: Data) -> DataFrame:
    return plain(
        d.view("v_leg").select(
            "row_id",
            "leg",
            dates.normalize_date("dt_raw", 1996, 2000).alias("dt"),
            dates.normalize_date("dt_raw", 1996, 2000, truncate=True).alias("day"),
        )
    )


# Order dates printed in several layouts; every ninth is broken.
_LAYOUTS = """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE '' END AS bad,
  lpad(CAST(day(o_orderdate) AS VARCHAR(2)), 2, '0') AS dd, lpad(CAST(month(o_orderdate) AS VARCHAR(2)), 2, '0') AS mm, CAST(year(o_orderdate) AS VARCHAR(4)) AS yyyy,
  CAST(day(o_orderdate) AS VARCHAR(2)) AS d, substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(o_orderdate) AS INT) * 3 - 2, 3) AS mon,
  lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR(2)), 2, '0') AS hh, CASE WHEN o_orderkey % 2 = 0 THEN 'AM' ELSE 'PM' END AS ampm FROM orders),
p AS (SELECT o_orderkey, concat(bad, dd, '/', mm, '/', yyyy) AS slash, concat(bad, d, ' ', mon, ' ', yyyy) AS named, concat(bad, dd, '-', mm, '-', yyyy, ' ', hh, ':30 ', ampm) AS clock,
  concat(bad, dd, upper(mon)) AS short, yyyy,
  concat(bad, CASE o_orderkey % 6 WHEN 0 THEN concat(yyyy, '-', mm, '-', dd) WHEN 1 THEN concat(d, '-', mon, '-', substr(yyyy, 3)) WHEN 2 THEN concat(d, '-', mon, '-', yyyy)
    WHEN 3 THEN concat(dd, '/', mm, '/', yyyy) WHEN 4 THEN ' NULL ' ELSE concat(yyyy, '-', mm, '-', dd, ' 10:00:00') END) AS mixed FROM t)"""


def _layouts(d: Data) -> DataFrame:
    d.table("orders").createOrReplaceTempView("orders")
    return d.spark.sql(_LAYOUTS + " SELECT * FROM p")


@query(
    "c14_parse_format",
    _LAYOUTS
    + """ SELECT o_orderkey, CAST(try_strptime(slash, '%d/%m/%Y') AS VARCHAR) AS a, CAST(try_strptime(named, '%d %b %Y') AS VARCHAR) AS b,
  CAST(try_strptime(clock, '%d-%m-%Y %I:%M %p') AS VARCHAR) AS c FROM p""",
)
def c14(d: Data) -> DataFrame:
    return plain(
        _layouts(d).select(
            "o_orderkey",
            dates.parse_format("slash", dates.DAY_FIRST_SLASH).alias("a"),
            dates.parse_format("named", dates.DAY_MONTH_NAME).alias("b"),
            dates.parse_format("clock", dates.DAY_FIRST_CLOCK).alias("c"),
        )
    )


@query(
    "c15_parse_short_date",
    _LAYOUTS + " SELECT o_orderkey, CAST(CAST(try_strptime(concat(short, yyyy), '%d%b%Y') AS DATE) AS VARCHAR) AS day FROM p",
)
def c15(d: Data) -> DataFrame:
    return plain(_layouts(d).select("o_orderkey", dates.parse_short_date("short", "yyyy").alias("day")))


_ANY = """CASE WHEN trim(mixed) IN ('', 'NULL', 'None') THEN NULL WHEN regexp_full_match(mixed, '\\d{4}-\\d{2}-\\d{2}') THEN mixed
  ELSE CAST(CAST(coalesce(CASE WHEN length(mixed) >= 10 THEN try_strptime(mixed, '%d-%b-%Y') END, CASE WHEN length(mixed) < 10 THEN try_strptime(regexp_replace(mixed, '-(\\d\\d)$', '-20\\1'), '%d-%b-%Y') END, try_strptime(mixed, '%d/%m/%Y'), try_strptime(mixed, '%Y-%m-%d %H:%M:%S')) AS DATE) AS VARCHAR) END"""


@query("c16_parse_any_date", _LAYOUTS + f" SELECT o_orderkey, {_ANY} AS day, coalesce({_ANY}, CASE WHEN trim(mixed) NOT IN ('', 'NULL', 'None') THEN trim(mixed) END) AS kept FROM p")
def c16(d: Data) -> DataFrame:
    return plain(
        _layouts(d).select(
            "o_orderkey", dates.parse_any_date("mixed").alias("day"), dates.parse_any_date("mixed", keep_text=True).alias("kept")
        )
    )


@query(
    "c19_first_present",
    oracle(
        "v_booking",
        "SELECT row_id, coalesce(CASE WHEN trim(flight3) NOT IN ('', 'nan', 'None') THEN trim(flight3) END, CASE WHEN trim(flight1) NOT IN ('', 'nan', 'None') THEN trim(flight1) END) AS y FROM v_booking",
    ),
)
def c19(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    return rows.select("row_id", text.first_present(rows, "missing", "flight3", "flight1").alias("y"))


@query(
    "c20_split_tokens",
    oracle(
        "v_lists",
        r"""WITH t AS (SELECT row_id, CASE WHEN flights = '' THEN [] ELSE regexp_split_to_array(flights, '\s+') END AS f,
  CASE WHEN sectors = '' THEN [] ELSE regexp_split_to_array(sectors, '\s+') END AS s FROM v_lists)
SELECT row_id, """
        + ", ".join([f'f[{k}] AS "FlightNumber{k}"' for k in range(1, 7)] + [f's[{k}] AS "Sector{k}"' for k in range(1, 7)])
        + " FROM t",
    ),
)
def c20(d: Data) -> DataFrame:
    rows = d.view("v_lists").select("row_id", "flights", "sectors")
    return chains.split_tokens(chains.split_tokens(rows, "flights", "FlightNumber", 6), "sectors", "Sector", 6)


@query(
    "c21_airport_chain_unique",
    oracle(
        "v_lists",
        r"""WITH u AS (SELECT row_id, unnest(regexp_split_to_array(sectors, '[\s/]+')) AS code, generate_subscripts(regexp_split_to_array(sectors, '[\s/]+'), 1) AS i FROM v_lists WHERE sectors <> ''),
g AS (SELECT row_id, code, min(i) AS i FROM u GROUP BY row_id, code),
j AS (SELECT row_id, string_agg(code, '>' ORDER BY i) AS chain FROM g GROUP BY row_id)
SELECT v.row_id, coalesce(chain, '') AS chain FROM v_lists v LEFT JOIN j ON v.row_id = j.row_id""",
    ),
)
def c21(d: Data) -> DataFrame:
    chain = F.array_join(chains.airport_chain_unique("sectors"), ">")
    return d.view("v_lists").select("row_id", F.coalesce(chain, F.lit("")).alias("chain"))


def _dest_sql(compact: bool) -> str:
    has = lambda i: f"coalesce(sector{i} LIKE '%/%', FALSE)"
    origin = "coalesce(" + ", ".join(f"CASE WHEN {has(i)} THEN split_part(sector{i}, '/', 1) END" for i in range(1, 7)) + ", '')"
    if compact:
        items = ", ".join(f"CASE WHEN {has(i)} THEN split_part(sector{i}, '/', 2) END" for i in range(1, 7))
        chain = f"list_filter([CASE WHEN {' OR '.join(map(has, range(1, 7)))} THEN {origin} END, {items}], lambda v: v IS NOT NULL)"
    else:
        items = ", ".join(f"CASE WHEN {has(i)} THEN split_part(sector{i}, '/', 2) ELSE '' END" for i in range(1, 7))
        chain = f"[{origin}, {items}]"
    return f"array_to_string(list_resize({chain}, greatest(5, len({chain})), ''), '>')"


@query(
    "c22_airport_chain_dest",
    oracle("v_lists", f"SELECT row_id, {_dest_sql(True)} AS compact, {_dest_sql(False)} AS positional FROM v_lists"),
)
def c22(d: Data) -> DataFrame:
    parts = F.array(*[f"sector{k}" for k in range(1, 7)])
    joined = lambda compact: F.array_join(chains.airport_chain_destinations(parts, 5, compact), ">")
    return d.view("v_lists").select("row_id", joined(True).alias("compact"), joined(False).alias("positional"))


@query(
    "c23_sector_pair",
    oracle(
        "v_lists",
        """WITH p AS (SELECT row_id, replace(sectors, '/', ' - ') AS s FROM v_lists),
q AS (SELECT row_id, trim(split_part(s, '/', 1)) AS s FROM p)
SELECT row_id, CASE WHEN s <> '' THEN NULLIF(trim(split_part(s, '-', 1)), '') END AS a, CASE WHEN s <> '' THEN NULLIF(trim(split_part(s, '-', 2)), '') END AS b FROM q""",
    ),
)
def c23(d: Data) -> DataFrame:
    a, b = chains.sector_pair(F.replace("sectors", F.lit("/"), F.lit(" - ")))
    return d.view("v_lists").select("row_id", a.alias("a"), b.alias("b"))


@query(
    "c26_classify_columns",
    oracle(
        "v_booking",
        "SELECT 'flight' AS role, count(flight1) + count(flight2) + count(flight3) + count(flight4) + count(flight5) + count(flight6) AS filled FROM v_booking "
        "UNION ALL SELECT 'date', count(date1) + count(date2) + count(date3) + count(date4) + count(date5) + count(date6) FROM v_booking "
        "UNION ALL SELECT 'other', count(row_id) + count(booking_ref) + count(pax_name) + " + " + ".join(f"count(airport{i})" for i in range(1, 8)) + " FROM v_booking",
    ),
)
def c26(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    roles = classify_columns(rows.columns, {"flight": r"flight\d+$", "date": r"date\d+$"})
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    items = [F.struct(F.lit(r).alias("role"), sum(F.col(c) for c in names).alias("filled")) for r, names in roles.items()]
    return plain(counts.select(F.inline(F.array(*items))))


@query(
    "c27_detect_slots",
    oracle(
        "v_booking",
        " UNION ALL ".join(
            f"SELECT CAST({i} AS BIGINT) AS slot, count(flight{i}) AS numbers, count(date{i}) AS dates FROM v_booking" for i in range(1, 7)
        ),
    ),
)
def c27(d: Data) -> DataFrame:
    rows = d.view("v_booking").withColumnsRenamed({f"flight{i}": f"FltNo{i}" for i in range(1, 7)})
    slots = detect_slots(rows.columns)
    counts = rows.agg(*[F.count(c).alias(c) for pair in slots.values() for c in pair])
    items = [
        F.struct(F.lit(i).alias("slot"), F.col(n).alias("numbers"), F.col(t).alias("dates")) for i, (n, t) in slots.items()
    ]
    return plain(counts.select(F.inline(F.array(*items))))


@query("c28_reorder_after", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def c28(d: Data) -> DataFrame:
    rows = d.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return plain(reorder_after(rows, ["o_orderstatus"], "o_orderkey"))


@query(
    "c30_actual_time",
    oracle("v_status", "SELECT id, CAST(CASE WHEN revised_arr IS NULL THEN runway_arr WHEN runway_arr IS NULL THEN revised_arr WHEN revised_arr > runway_arr THEN revised_arr ELSE runway_arr END AS VARCHAR) AS actual FROM v_status"),
)
def c30(d: Data) -> DataFrame:
    return plain(d.view("v_status").select("id", dates.later_of("revised_arr", "runway_arr").alias("actual")))


@query("c31_to_seconds", oracle("v_status", "SELECT id, CAST(epoch(revised_arr) - epoch(sched_arr) AS BIGINT) AS secs FROM v_status"))
def c31(d: Data) -> DataFrame:
    return plain(d.view("v_status").select("id", dates.seconds_between("sched_arr", "revised_arr").alias("secs")))


_WRAPPED = """WITH w AS (SELECT conv_id, turn, role, CASE WHEN turn % 3 = 0 THEN concat('["', text, '"]') WHEN turn % 3 = 1 THEN concat('''', replace(text, ',', '\\"'), '''') ELSE text END AS t FROM conversations)"""


def _wrapped(d: Data) -> DataFrame:
    t = F.col("text")
    return d.table("conversations").withColumn(
        "t",
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit('["'), t, F.lit('"]')))
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("'"), F.replace(t, F.lit(","), F.lit('\\"')), F.lit("'")))
        .otherwise(t),
    )


@query(
    "c32_clean_text_literal",
    _WRAPPED
    + """, i AS (SELECT conv_id, turn, CASE WHEN t LIKE '[%' AND t LIKE '%]' THEN substr(t, 2, length(t) - 2) ELSE t END AS t FROM w)
SELECT conv_id, turn, replace(trim(t, '"'''), '\\"', '"') AS clean FROM i""",
)
def c32(d: Data) -> DataFrame:
    return plain(_wrapped(d).select("conv_id", "turn", text.unwrap_literal("t").alias("clean")))


@query(
    "c33_format_text",
    """SELECT conv_id, turn, concat('Prompt: ', role, chr(10), chr(10), 'Response: ', text) AS block,
  CASE WHEN turn % 3 = 1 THEN 0 WHEN turn % 2 = 1 THEN 1 ELSE 2 END AS label FROM conversations""",
)
def c33(d: Data) -> DataFrame:
    rows = d.table("conversations").withColumns({"a": F.col("turn") % 3, "b": F.col("turn") % 2})
    return plain(
        rows.select(
            "conv_id",
            "turn",
            text.sectioned_text([("Prompt", "role"), ("Response", "text")]).alias("block"),
            text.winner_label("a", "b").alias("label"),
        )
    )


@query(
    "c34_general_scalars",
    """SELECT o_orderkey, coalesce(NULLIF(o_orderstatus, 'F'), 'done') AS s, right(o_orderpriority, 3) AS r, CAST(year(o_orderdate) AS BIGINT) AS y,
  lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS padded, abs(o_orderkey - 5000) AS dist, CAST(floor(o_totalprice / 100) AS BIGINT) AS hundreds, greatest(o_orderkey, o_custkey) AS hi, least(o_orderkey, o_custkey) AS lo FROM orders""",
)
def c34(d: Data) -> DataFrame:
    k = F.col("o_orderkey")
    return plain(
        d.table("orders").select(
            k,
            F.coalesce(F.nullif("o_orderstatus", F.lit("F")), F.lit("done")).alias("s"),
            F.right("o_orderpriority", F.lit(3)).alias("r"),
            F.year("o_orderdate").alias("y"),
            F.format_string("%012d", k).alias("padded"),
            F.abs(k - 5000).alias("dist"),
            F.floor(F.col("o_totalprice") / 100).alias("hundreds"),
            F.greatest("o_orderkey", "o_custkey").alias("hi"),
            F.least("o_orderkey", "o_custkey").alias("lo"),
        )
    )


@query(
    "u1_sql_functions",
    oracle(
        "v_leg",
        f"""SELECT row_id, CAST(leg AS BIGINT) AS leg, coalesce(regexp_full_match(upper(trim(fn_raw)), '[A-Z]{{2,3}}0+'), FALSE) AS rnk,
  coalesce(regexp_full_match(upper(trim(fn_raw)), '[A-Z]{{1,2}}'), FALSE) AS vo, {sql_c4('fn_raw')} AS fn, CAST({sql_date('dt_raw', 1990, 2100)} AS VARCHAR) AS dt FROM v_leg""",
    ),
)
def u1(d: Data) -> DataFrame:
    rows = d.view("v_leg")
    register_sql_functions(d.spark)
    return plain(
        rows.selectExpr(
            "row_id", "leg", "is_rnk(fn_raw) AS rnk", "is_vo(fn_raw) AS vo", "normalize_flight(fn_raw) AS fn", "normalize_date(dt_raw) AS dt"
        )
    )


@query(
    "u1_sql_functions_slash_dates",
    """WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, ' %Y/%-m/%-d ') ELSE strftime(o_orderdate, '%Y.%m.%d') END AS d, o_orderdate FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 AND year(o_orderdate) BETWEEN 1990 AND 2100 THEN CAST(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS VARCHAR) END AS by_sql,
  CASE WHEN o_orderkey % 4 < 3 AND year(o_orderdate) BETWEEN 1990 AND 2100 THEN CAST(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS VARCHAR) END AS by_column FROM t""",
)
def u1_slash(d: Data) -> DataFrame:
    register_sql_functions(d.spark)
    day = lambda pattern: F.date_format("o_orderdate", pattern)
    text = (
        F.when(F.col("o_orderkey") % 4 == 0, day("yyyy/MM/dd"))
        .when(F.col("o_orderkey") % 4 == 1, day("yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 4 == 2, day(" yyyy/M/d "))
        .otherwise(day("yyyy.MM.dd"))
    )
    rows = d.table("orders").select("o_orderkey", text.alias("d"))
    return plain(rows.select("o_orderkey", F.expr("normalize_date(d)").alias("by_sql"), dates.normalize_date("d", 1990, 2100).alias("by_column")))


@query("k10_align_schema", "SELECT o_custkey, '' AS note, o_orderkey FROM orders")
def k10(d: Data) -> DataFrame:
    return plain(align_schema(d.table("orders"), ["o_custkey", "note", "o_orderkey"]))


@query(
    "k11_cast_columns",
    oracle("v_leg", f"SELECT row_id, CAST(leg AS BIGINT) AS leg, CAST(CAST({sql_ts('dt_raw')} AS DATE) AS VARCHAR) AS dt_raw, CASE WHEN regexp_full_match(fn_raw, '[0-9]+') THEN TRY_CAST(fn_raw AS BIGINT) END AS fn_raw FROM v_leg"),
)
def k11(d: Data) -> DataFrame:
    rows = d.view("v_leg").select("row_id", "leg", "dt_raw", "fn_raw")
    return plain(cast_columns(rows, {"dt_raw": "date", "fn_raw": "bigint"}))
