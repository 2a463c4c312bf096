"""Sources and sinks, exercised with files and tables written from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.cleaning import LOADED
from checks.inputs import oracle
from checks.journeys import BOOKING
from checks.registry import ORACLES, Data, plain, query
from itinera.operators import layout
from itinera.operators.dedupe import match_target
from itinera.session import scratch_path
from itinera.sinks.files import export_csv_chunks, split_output
from itinera.sinks.tables import replace_table, rows_to_append
from itinera.sinks.versioned import VersionedTable
from itinera.sources import delimited, markup, tables, workbooks
from itinera.streaming.incremental import incremental_clean

_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def _csv(d: Data, df: DataFrame, label: str, sep: str = ",") -> str:
    path = scratch_path(d.spark, label)
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


def _orders(d: Data) -> DataFrame:
    return d.table("orders").select(*_ORDERS)


@query(
    "s1_read_csv_all_string",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority FROM orders",
)
def s1(d: Data) -> DataFrame:
    return delimited.read_csv_all_string(d.spark, _csv(d, _orders(d), "s1"))


def _mixed_files(d: Data) -> str:
    """The orders as files of three layouts: other column orders, a column more, a column less; the last also has lines
    with a cell too many."""
    root = scratch_path(d.spark, "s1-mixed")
    orders, part = _orders(d), F.pmod("o_orderkey", F.lit(3))
    write = lambda df, name: df.write.option("header", True).csv(f"{root}/{name}")
    write(orders.filter(part == 0), "a")
    write(orders.filter(part == 1).select("o_orderpriority", "o_orderkey", "o_custkey", "o_orderstatus", F.lit("x").alias("more")), "b")
    short = orders.filter(part == 2).select("o_orderstatus", "o_orderkey")
    bad = short.filter("o_orderkey % 5 = 0").select(F.concat_ws(",", "o_orderstatus", "o_orderkey", F.lit("too many")).alias("value"))
    lines = short.select(F.concat_ws(",", "o_orderstatus", "o_orderkey").alias("value")).unionByName(bad)
    # every file has its own header line
    lines.mapInPandas(_with_header, "value string").write.text(f"{root}/c")
    return root


def _with_header(frames):
    import pandas as pd

    first = True
    for frame in frames:
        if first and len(frame):
            yield pd.DataFrame({"value": ["o_orderstatus,o_orderkey"]})
            first = False
        yield frame


@query(
    "s1_read_csv_by_name",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_custkey AS VARCHAR) END AS o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 3 < 2 THEN o_orderpriority END AS o_orderpriority, CASE WHEN o_orderkey % 3 = 1 THEN 'x' END AS more FROM orders""",
)
def s1_by_name(d: Data) -> DataFrame:
    root = _mixed_files(d)
    return delimited.read_csv_all_string(d.spark, [f"{root}/{x}" for x in "abc"])


@query(
    "s17_load_report_by_file",
    """SELECT CASE o_orderkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS folder, count(*) + count_if(o_orderkey % 15 = 5) AS total_rows,
  count(*) AS loaded_rows, count_if(o_orderkey % 15 = 5) AS skipped_rows FROM orders GROUP BY 1""",
)
def s17_by_file(d: Data) -> DataFrame:
    root = _mixed_files(d)
    report = delimited.load_report(d.spark, [f"{root}/{x}" for x in "abc"], name="file_path")
    folder = F.element_at(F.split("file_name", "/"), -2).alias("folder")
    return report.groupBy(folder).agg(*[F.sum(c).alias(c) for c in ("total_rows", "loaded_rows", "skipped_rows")])


@query("s2_read_csv_infer", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def s2(d: Data) -> DataFrame:
    _, df = delimited.read_csv_infer(d.spark, _csv(d, _orders(d), "s2"))
    return plain(df)


@query("s3_read_csv_typed", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def s3(d: Data) -> DataFrame:
    return plain(delimited.read_csv_typed(d.spark, _csv(d, _orders(d), "s3"), ["o_orderkey"]))


@query("s4_detect_separator", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, ';' AS sep FROM customer")
def s4(d: Data) -> DataFrame:
    path = _csv(d, d.table("customer").select("c_custkey", "c_mktsegment"), "s4", ";")
    sep = delimited.detect_separator(d.spark, path)
    return delimited.read_csv_all_string(d.spark, path, sep).withColumn("sep", F.lit(sep))


def _html(d: Data) -> DataFrame:
    """One document per booking row: its legs as an HTML table (at most six rows each)."""
    cell = lambda c: F.concat(F.lit("<td>"), F.coalesce(F.col(c), F.lit("")), F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), cell("dep"), F.lit("\n"), cell("dt_raw"), F.lit("</TR>"))
    legs = d.view("v_leg").groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("leg", row.alias("r")))).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["r"]), "\n")
    return legs.select("row_id", F.concat(F.lit("<html><p>x</p><TABLE border=1>"), body, F.lit("</table>")).alias("html"))


@query(
    "s6_extract_html_tables",
    oracle("v_leg", "SELECT row_id, CAST(0 AS BIGINT) AS table_no, row_number() OVER (PARTITION BY row_id ORDER BY leg) - 1 AS row_no, trim(dep) AS c1, coalesce(dt_raw, '') AS c2 FROM v_leg"),
)
def s6(d: Data) -> DataFrame:
    out = markup.extract_html_tables(_html(d), "html", "row_id")
    return plain(out.select("row_id", "table_no", "row_no", *markup.cell_columns(2)))


def _workbook(key: tuple, rows):
    """One workbook of the rows' orders: a sheet for each status, dates as day numbers, a blank row in between."""
    import io
    import zipfile
    from xml.sax.saxutils import escape

    import pandas as pd

    text = lambda v: f'<c t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheets = dict(tuple(rows.fillna({"o_orderstatus": "none"}).groupby("o_orderstatus", sort=True)))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for i, part in enumerate(sheets.values(), start=1):
            lines = ["<row>" + "".join(map(text, ["Order", "Customer ", "Date", "Priority"])) + "</row>", "<row></row>"]
            for r in part.itertuples():
                days = (r.o_orderdate - pd.Timestamp("1899-12-30")).days
                lines.append(f'<row>{text(r.o_orderkey)}<c><v>{r.o_custkey}</v></c><c s="1"><v>{days}</v></c>{text(r.o_orderpriority)}</row>')
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}><sheetData>{''.join(lines)}</sheetData></worksheet>")
        names = "".join(f'<sheet name="{escape(str(n))}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, start=1))
        targets = "".join(f'<Relationship Id="rId{i}" Type="x" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{targets}</Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
    return pd.DataFrame({"name": [f"book{key[0]}.xlsx"], "content": [out.getvalue()]})


@query(
    "s5_read_workbooks",
    """SELECT concat('book', CAST(floor(o_orderkey / 4000) AS BIGINT), '.xlsx') AS source_file, coalesce(o_orderstatus, 'none') AS source_sheet, CAST(o_orderkey AS VARCHAR) AS "Order",
  CAST(o_custkey AS VARCHAR) AS "Customer", CAST(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS VARCHAR) AS "Date", o_orderpriority AS "Priority" FROM orders""",
)
def s5(d: Data) -> DataFrame:
    orders = d.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_orderpriority")
    books = orders.groupBy(F.floor(F.col("o_orderkey") / 4000).alias("book")).applyInPandas(_workbook, "name string, content binary")
    return plain(workbooks.workbook_table(books, headers=["Order", "Customer", "Date", "Priority"], date_columns=["Date"]))


@query("s7_read_parquet", "SELECT l_orderkey, l_quantity FROM lineitem")
def s7(d: Data) -> DataFrame:
    return tables.read_parquet(d.spark, f"{d.folder}/lineitem.parquet", ["l_orderkey", "l_quantity"])


@query("s8_load_dimension", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def s8(d: Data) -> DataFrame:
    return delimited.load_dimension(d.spark, _csv(d, d.table("nation"), "s8"))


@query("s9_union_tables", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def s9(d: Data) -> DataFrame:
    orders = _orders(d)
    for status in ("F", "O", "P"):
        orders.filter(F.col("o_orderstatus") == status).createOrReplaceTempView(f"export_202{status.lower()}")
    orders.filter(~F.coalesce(F.col("o_orderstatus").isin("F", "O", "P"), F.lit(False))).createOrReplaceTempView("export_202rest")
    return plain(tables.union_tables(d.spark, "export_202%"))


@query(
    "s10_merge_files",
    "SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name, NULL AS c_mktsegment FROM nation UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment FROM customer",
)
def s10(d: Data) -> DataFrame:
    a = _csv(d, d.table("nation").select(F.col("n_nationkey").alias("k"), "n_name"), "s10a")
    b = _csv(d, d.table("customer").select(F.col("c_custkey").alias("k"), "c_mktsegment"), "s10b")
    return delimited.merge_files(d.spark, [a, b])


@query(
    "s11_describe_schema",
    " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, CASE typeof(any_value({c})) WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof(any_value({c}))) END AS column_type, count({c}) AS filled FROM orders"
        for i, c in enumerate(_ORDERS, start=1)
    ),
)
def s11(d: Data) -> DataFrame:
    from itinera.operators.profile import fill_rate

    orders = _orders(d)
    filled = fill_rate(orders, orders.columns).select("column_name", "filled")
    return plain(layout.describe_schema(orders).join(filled, "column_name"))


@query("s12_add_provenance", "SELECT o_orderkey, 'orders.parquet' AS source_file, 'main' AS source_sheet FROM orders")
def s12(d: Data) -> DataFrame:
    return delimited.with_provenance(d.table("orders"), sheet="main").select("o_orderkey", "source_file", "source_sheet")


@query("s13_add_row_uuid", "SELECT o_orderkey, sha256(concat(CAST(o_orderkey AS VARCHAR), chr(1), coalesce(o_orderstatus, chr(0)))) AS id FROM orders")
def s13(d: Data) -> DataFrame:
    rows = layout.add_row_uuid(d.table("orders"), ["o_orderkey", "o_orderstatus"], "id")
    return rows.select("o_orderkey", "id")


@query("s15_drop_columns", "SELECT c_custkey, c_name FROM customer")
def s15(d: Data) -> DataFrame:
    return layout.drop_columns(d.table("customer"), ["c_nationkey", "c_acctbal", "c_mktsegment", "unknown"])


@query(
    "s16_drop_empty_rows",
    oracle("v_leg", "SELECT NULLIF(trim(fn_raw), '') AS f, arr FROM v_leg WHERE NULLIF(trim(fn_raw), '') IS NOT NULL OR arr IS NOT NULL"),
)
def s16(d: Data) -> DataFrame:
    return layout.drop_empty_rows(d.view("v_leg").select(F.nullif(F.trim("fn_raw"), F.lit("")).alias("f"), "arr"))


@query(
    "s17_load_report",
    "SELECT count(*) AS total_rows, count(*) FILTER (o_orderkey % 10 <> 0) AS loaded_rows, count(*) FILTER (o_orderkey % 10 = 0) AS skipped_rows FROM orders",
)
def s17(d: Data) -> DataFrame:
    """Every tenth line carries a cell too many and must be counted as skipped."""
    path = scratch_path(d.spark, "s17")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, F.lit("x")))
    d.table("orders").select(line.alias("o_orderkey,o_orderstatus")).write.option("header", True).option("quote", "").csv(path)
    report = delimited.load_report(d.spark, path)
    sums = report.agg(*[F.sum(c).alias(c) for c in ("total_rows", "loaded_rows", "skipped_rows")])
    return plain(sums)


@query("k1_replace_table", "SELECT n_nationkey, n_name FROM nation")
def k1(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "k1")
    name = f"k1_{path.rsplit('-', 1)[1]}"
    d.spark.sql(f"CREATE TABLE {name} (n_nationkey INT, n_name STRING) USING parquet LOCATION '{path}'")
    replace_table(d.table("nation").select("n_nationkey", "n_name"), name)
    return plain(d.spark.table(name))


def _versioned(d: Data, label: str, rows: DataFrame) -> VersionedTable:
    table = VersionedTable(d.spark, scratch_path(d.spark, label))
    table.replace(rows)
    return table


@query("k3_update_committed", ORACLES["k3_update_from"])
def k3_committed(d: Data) -> DataFrame:
    """The update as one commit of a versioned table."""
    top = d.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_mktsegment"))
    table = _versioned(d, "k3", d.table("customer").select("c_custkey", "c_mktsegment", "c_nationkey"))
    table.update_from(top, ["c_custkey"], ["c_mktsegment"], F.col("c_nationkey") > 5)
    return plain(table.read())


@query("k5_replace_committed", ORACLES["k5_replace_subset"])
def k5_committed(d: Data) -> DataFrame:
    """Delete and insert as one commit; the version before stays readable."""
    table = _versioned(d, "k5", d.view("v_booking").select("row_id", "booking_ref", "pax_name", "airport1", "airport3"))
    table.replace_subset(F.col("airport1") == F.col("airport3"), lambda x: x.withColumn("pax_name", F.lit("RETURN")))
    return table.read().select("row_id", "booking_ref", "pax_name")


@query(
    "k2_append_committed",
    oracle(
        "v_booking",
        f"""WITH t AS (SELECT * FROM v_booking WHERE {LOADED}), r AS (SELECT *, row_number() OVER (PARTITION BY booking_ref, flight1, airport1 ORDER BY row_id) AS rn FROM v_booking)
SELECT row_id, booking_ref FROM t UNION ALL SELECT row_id, booking_ref FROM r WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM t WHERE t.booking_ref IS NOT DISTINCT FROM r.booking_ref
  AND t.flight1 IS NOT DISTINCT FROM r.flight1 AND t.airport1 IS NOT DISTINCT FROM r.airport1)""",
    ),
)
def k2_committed(d: Data) -> DataFrame:
    """The loaded table after rows with new keys were committed to it."""
    rows = d.view("v_booking").select("row_id", "booking_ref", "flight1", "airport1", "date1")
    table = _versioned(d, "k2", d.view("v_booking").filter(LOADED).select(*rows.columns))
    table.append_if_absent(rows, ["booking_ref", "flight1", "airport1"], ["row_id"], nulls_equal=True)
    return table.read().select("row_id", "booking_ref")


@query("k6_export_csv_chunks", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders")
def k6(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "k6")
    export_csv_chunks(d.table("orders").select("o_orderkey", "o_orderstatus"), path, rows=5_000)
    return delimited.read_csv_all_string(d.spark, path)


@query("k7_split_output", "SELECT TRUE AS within_limit, count(*) AS total FROM orders")
def k7(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "k7")
    split_output(d.table("orders").select("o_orderkey"), path, rows=4_000)
    parts = d.spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return plain(parts.agg((F.max("n") <= 4_000).alias("within_limit"), F.sum("n").alias("total")))


@query("k9_empty_like", "SELECT 'o_orderkey' AS column_name, count(*) AS total FROM orders")
def k9(d: Data) -> DataFrame:
    orders = d.table("orders").select("o_orderkey")
    both = layout.empty_like(orders).unionByName(orders)
    return plain(both.agg(F.lit(orders.columns[0]).alias("column_name"), F.count(F.lit(1)).alias("total")))


# A booking reference belongs to one delivery and is part of the key, so both runs together equal one batch run.
@query("x1_incremental_clean", ORACLES["b1_accepted"])
def x1(d: Data) -> DataFrame:
    """Two deliveries of the booking data, cleaned by two runs of the same stream."""
    rows = d.view("v_booking")
    source, target, rejected, ckpt = (scratch_path(d.spark, f"x1-{p}") for p in ("in", "out", "rejected", "state"))
    for part in (rows.filter(LOADED), rows.filter(f"NOT ({LOADED})")):
        part.repartition(3).write.mode("append").parquet(source)
        incremental_clean(d.spark, source, rows.schema, BOOKING, "row_id", target, rejected, ckpt, max_files=1)
    return plain(d.spark.read.parquet(target).drop("run_id"))


@query(
    "k2_append_pruned",
    ORACLES["k2_append_if_absent"],
)
def k2_pruned(d: Data) -> DataFrame:
    """A target far larger than the run: its rows meet a filter of the run's keys before they are shuffled."""
    rows = d.view("v_booking")
    return rows_to_append(rows, rows.filter(LOADED), ["booking_ref", "flight1", "airport1"], ["row_id"], prune=True).select("row_id")


@query("d7_conflicts_pruned", ORACLES["d7_conflicts"])
def d7_pruned(d: Data) -> DataFrame:
    rows = d.view("v_booking")
    return match_target(rows, rows.filter(LOADED), ["booking_ref", "flight1", "airport1"], prune=True).select("row_id")
