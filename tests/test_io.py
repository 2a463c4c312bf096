"""Sources, sinks and the incremental run, on files the tests write themselves."""

from __future__ import annotations

import datetime as dt
import os
import zipfile
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from itinera.operators import dedupe
from itinera.plans.clean import clean_bookings
from itinera.sinks import files, tables as sink_tables
from itinera.sources import delimited, markup, tables, workbooks
from itinera.spec import SourceSpec
from itinera.streaming.incremental import incremental_clean


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_text_skips_bad_lines_and_reports_them(spark, tmp_path):
    write(tmp_path / "a.csv", "id,name\n001,x\n2,y,z\n3,\n")
    write(tmp_path / "b.csv", "id,name\n4,w\n5\n")
    df = delimited.read_csv_all_string(spark, str(tmp_path))
    assert sorted((r["id"], r["name"]) for r in df.collect()) == [("001", "x"), ("3", None), ("4", "w")]
    assert df.count() == 3
    report = {r["file_name"]: tuple(r)[1:] for r in delimited.load_report(spark, str(tmp_path)).collect()}
    assert report == {"a.csv": (3, 2, 1, 66.6667), "b.csv": (2, 1, 1, 50.0)}
    names = {r["source_file"] for r in delimited.with_provenance(df).select("source_file").collect()}
    assert names == {"a.csv", "b.csv"}


def test_csv_types_names_separators(spark, tmp_path):
    path = write(tmp_path / "2024 export-1.csv", "code;n\n007;1\n")
    assert delimited.detect_separator(spark, path) == ";"
    name, df = delimited.read_csv_infer(spark, path, ";")
    assert name == "_2024_export_1" and spark.table(name).first()["code"] == 7
    assert delimited.read_csv_typed(spark, path, ["code"], ";").first()["code"] == "007"
    assert delimited.detect_separator(spark, write(tmp_path / "t.txt", "a\tb,c\n")) == "\t"
    other = write(tmp_path / "other.csv", "n,extra\n5,z\n")
    both = delimited.merge_files(spark, [other, write(tmp_path / "m.csv", "n,more\n6,q\n")])
    assert sorted(map(tuple, both.collect()), key=str) == [("5", "z", None), ("6", None, "q")]


def test_union_of_catalog_tables(spark):
    spark.range(2).selectExpr("id", "'a' AS s").createOrReplaceTempView("part_2024a")
    spark.range(3).selectExpr("'b' AS s", "id").createOrReplaceTempView("part_2024b")
    assert tables.matching_tables(spark, "part_2024%") == ["part_2024a", "part_2024b"]
    assert tables.union_tables(spark, "part_2024%").groupBy("s").count().collect().__len__() == 2
    with pytest.raises(ValueError):
        tables.union_tables(spark, "nothing_like_this%")


def _workbook(path, sheets):
    """A small xlsx: shared strings, one date style, sparse cells."""
    texts: list[str] = []

    def cell(ref, v):
        if v is None:
            return ""
        if isinstance(v, dt.datetime):
            days = (v - dt.datetime(1899, 12, 30)).total_seconds() / 86400
            return f'<c r="{ref}" s="1"><v>{days}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        if v not in texts:
            texts.append(v)
        return f'<c r="{ref}" t="s"><v>{texts.index(v)}</v></c>'

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        names, rels = "", ""
        for i, (name, data) in enumerate(sheets.items(), 1):
            body = "".join(
                f'<row r="{r}">' + "".join(cell(f"{chr(65 + c)}{r}", v) for c, v in enumerate(line)) + "</row>"
                for r, line in enumerate(data, 1)
            )
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
            names += f'<sheet name="{name}" sheetId="{i}" r:id="rId{i}"/>'
            rels += f'<Relationship Id="rId{i}" Type="x" Target="worksheets/sheet{i}.xml"/>'
        z.writestr("xl/workbook.xml", f"<workbook {main} {rel}><sheets>{names}</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><t>{t}</t></si>" for t in texts) + "</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')


def test_workbooks(spark, tmp_path):
    when = dt.datetime(2024, 3, 5, 8, 30)
    _workbook(tmp_path / "one.xlsx", {"S1": [["Ref", " Date "], ["007", when], [None, None], ["NULL", None]], "Empty": []})
    _workbook(tmp_path / "two.xlsx", {"S2": [["Ref", "N"], ["b", 12]]})
    df = workbooks.read_workbooks(spark, str(tmp_path / "*.xlsx"), null_columns=["Ref"], date_columns=["Date"])
    got = sorted((tuple(r) for r in df.select("source_file", "source_sheet", "Ref", F.col("Date").cast("string"), "N").collect()), key=str)
    assert got == [
        ("one.xlsx", "S1", "007", "2024-03-05 08:30:00", None), ("one.xlsx", "S1", None, None, None), ("two.xlsx", "S2", "b", None, "12"),
    ]


def test_html_tables(spark):
    page = (
        "<table><tr><th>A<th>B</tr><tr><td>1<br>2</td><td> x &amp; y </td></tr></table>"
        "<table><tr><td>out<table><tr><td>in</td></tr></table></td></tr></table>"
    )
    df = spark.createDataFrame([(1, page), (2, "<p>no table</p>"), (3, None), (4, "<TABLE><tr><td>open")], "doc int, html string")
    got = [tuple(r) for r in markup.extract_html_tables(df, "html", "doc").orderBy("doc", "table_no", "row_no").collect()]
    assert got == [
        (1, 0, 0, ["A", "B"]), (1, 0, 1, ["12", "x & y"]), (1, 1, 0, ["out"]), (1, 2, 0, ["in"]), (4, 0, 0, ["open"]),
    ]
    assert issubclass(markup._Tables, HTMLParser)


def test_exports(spark, tmp_path):
    df = spark.range(2500).selectExpr("id", "concat('it''s ', id) AS s")
    files.export_csv_chunks(df, str(tmp_path / "csv"), rows=400)
    sizes = [sum(1 for _ in open(tmp_path / "csv" / f)) - 1 for f in os.listdir(tmp_path / "csv") if f.endswith(".csv")]
    assert sum(sizes) == 2500 and max(sizes) <= 400
    statements = files.bulk_update_statements(df, "dbo.t", "id", ["id"], batch=1000).orderBy("statement_no").collect()
    assert [r["sql"].count("\n    (") for r in statements] == [1000, 1000, 500]
    assert "('7','it''s 7')" in statements[0]["sql"] and statements[0]["sql"].endswith("ON t.id = u.id;")
    files.write_statements(spark.createDataFrame([(1, "x;")], "statement_no int, sql string"), str(tmp_path / "sql"))
    assert spark.read.text(str(tmp_path / "sql")).filter("value = 'x;'").count() == 1


def test_append_if_absent_twice_changes_nothing(spark):
    spark.sql("DROP TABLE IF EXISTS append_target")
    old = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    sink_tables.replace_table(old, "append_target")
    new = spark.createDataFrame([(3, "a"), (4, "b"), (5, "b"), (6, None), (7, None)], "id int, k string")
    for _ in range(2):
        sink_tables.append_if_absent(new, "append_target", ["k"], ["id"], nulls_equal=True)
    assert sorted(r["id"] for r in spark.table("append_target").collect()) == [1, 2, 4]
    strict = sink_tables.rows_to_append(new, old, ["k"], ["id"])
    assert sorted(r["id"] for r in strict.collect()) == [4, 6, 7]


@pytest.fixture
def deliveries(spark):
    """Two deliveries of several files each; keys repeat within and across them."""
    spec = SourceSpec("t", ("Ref",), 1, key=("Ref", "FlightNumber1", "FlightDate1"))
    data = [((i * 37) % 180, f"r{i % 7}", f"TK{i % 5 + 1}" if i % 9 else "bad", "2024-01-0%d" % (i % 3 + 1), "A", "B") for i in range(180)]
    df = spark.createDataFrame(data, "id int, Ref string, FlightNumber1 string, FlightDate1 string, Airport1 string, Airport2 string")
    return spec, [df.where("id % 180 < 60 or id = 177"), df.where("id >= 60 and id <> 177")]


def _outcome(spark, path):
    rows = spark.read.parquet(path)
    return sorted((r["run_id"], r["id"], r["Ref"], r["FlightNumber1"], str(r["FlightDate1"]), r["RejectionReason"] if "RejectionReason" in rows.columns else None) for r in rows.collect())


def test_incremental_runs_do_not_depend_on_micro_batches(spark, tmp_path, deliveries):
    spec, parts = deliveries
    outcomes = []
    for max_files in (1, 1000):
        source, out, bad, state = (str(tmp_path / f"{p}{max_files}") for p in ("in", "out", "bad", "state"))
        for n, part in enumerate(parts):
            part.repartition(4).write.mode("append").parquet(source)
            assert incremental_clean(spark, source, part.schema, spec, "id", out, bad, state, max_files=max_files) == n + 1
        assert incremental_clean(spark, source, part.schema, spec, "id", out, bad, state) == 0
        outcomes.append((_outcome(spark, out), _outcome(spark, bad)))
    assert outcomes[0] == outcomes[1]
    first = clean_bookings(parts[0], spec, "id")
    second = clean_bookings(parts[1], spec, "id", first.accepted)
    for found, name in zip(outcomes[0], ("accepted", "rejected")):
        for run, result in ((1, first), (2, second)):
            assert [r[1] for r in found if r[0] == run] == sorted(r["id"] for r in getattr(result, name).collect())
    reasons = {r[5] for r in outcomes[0][1]}
    assert {"BATCH DUPLICATE", "DB UNIQUE VIOLATION"} <= reasons


def test_a_run_that_died_is_taken_up(spark, tmp_path, deliveries, monkeypatch):
    from itinera.streaming import incremental

    spec, parts = deliveries
    source, out, bad, state = (str(tmp_path / p) for p in ("in", "out", "bad", "state"))
    parts[0].repartition(3).write.parquet(source)
    args = (spark, source, parts[0].schema, spec, "id", out, bad, state)
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "finish_run", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental_clean(*args, max_files=1)
    parts[1].repartition(2).write.mode("append").parquet(source)
    assert incremental_clean(*args) == 1  # both deliveries, under the old number
    whole = clean_bookings(parts[0].unionByName(parts[1]), spec, "id")
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == sorted(r["id"] for r in whole.accepted.collect())
    assert spark.read.parquet(bad).count() == whole.rejected.count()


def test_a_filter_of_the_run_keeps_the_target_out_of_the_shuffle(spark, tmp_path):
    target = spark.range(200_000).selectExpr("cast(id as string) as k", "id % 11 as n", "if(id % 100 = 0, null, id % 5) as m")
    target.write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    run = spark.createDataFrame([("17", 6, 2), (" 18 ", 7, 3), ("100", 1, None), ("x", 1, 1), (None, 1, 1)], "k string, n long, m long")
    near = dedupe.pruned_target(run, target, ["k", "n", "m"], ["k"])
    assert 3 <= near.count() < 60  # of 200,000
    for how in ("left_semi", "left_anti"):
        plain = dedupe.match_target(run, target, ["k", "n", "m"], ["k"], how)
        assert sorted(map(str, dedupe.match_target(run, target, ["k", "n", "m"], ["k"], how, prune=True).collect())) == sorted(map(str, plain.collect()))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2  # the target itself is not exchanged


def test_csv_files_of_several_layouts(spark, tmp_path):
    (tmp_path / "a [1] 50%.csv").write_text("pax,pnr\nP1,R1\nP2,R2\n")
    (tmp_path / "b.csv").write_text("pnr,pax\nR3,P3\nbad\n")
    (tmp_path / "c.csv").write_text("pax,pnr,extra\nP4,R4,x\n")
    (tmp_path / "d.csv").write_text("")
    rows = delimited.read_csv_all_string(spark, str(tmp_path), source="file").collect()
    assert sorted((r["pax"], r["pnr"], r["extra"]) for r in rows) == [("P1", "R1", None), ("P2", "R2", None), ("P3", "R3", None), ("P4", "R4", "x")]
    report = {r["file_name"]: tuple(r)[1:4] for r in delimited.load_report(spark, str(tmp_path)).collect()}
    assert sorted(report.values()) == [(1, 1, 0), (2, 1, 1), (2, 2, 0)]
    typed = delimited.read_csv_typed(spark, str(tmp_path), ["pnr"])
    assert dict(typed.dtypes) == {"pax": "string", "pnr": "string", "extra": "string"}


def test_split_connections_loses_no_leg(spark):
    from itinera.operators.reshape import split_connections
    from itinera.spec import SPECS

    spec = SPECS["four_slot_plain"]
    values = {c: None for c in spec.columns} | {f"FltNo{i}": f"AA{i}" for i in (1, 2, 3)} | {f"Airport{i}": f"P{i}" for i in (1, 2, 3, 4)}
    schema = ", ".join(f"{c} string" for c in spec.columns)
    df = spark.createDataFrame([tuple(values[c] for c in spec.columns)], schema)
    got = sorted((r["FltNo1"], r["Airport1"], r["Airport2"]) for r in split_connections(df, spec).collect())
    assert got == [("AA1", "P1", "P2"), ("AA2", "P2", "P3"), ("AA3", "P3", "P4")]
    two = split_connections(df, spec, first_two=True, dropped="gone").collect()
    assert [r["gone"] for r in two] == [1, 1]


def test_one_file_is_parsed_by_several_tasks(spark, tmp_path, deliveries, monkeypatch):
    from itinera.session import METHOD_BYTES, METHOD_LIMIT
    from itinera.streaming import incremental

    spec, parts = deliveries
    source, out, bad, state = (str(tmp_path / p) for p in ("in", "out", "bad", "state"))
    parts[0].coalesce(1).write.parquet(source)  # one row group, which one task reads
    before, seen = spark.conf.get(METHOD_LIMIT, None), []
    parse = incremental.stage_rows
    monkeypatch.setattr(incremental, "finish_run", lambda *a, **k: None)
    monkeypatch.setattr(incremental, "stage_rows", lambda df, s: seen.append(df.sparkSession.conf.get(METHOD_LIMIT)) or parse(df, s))
    assert incremental_clean(spark, source, parts[0].schema, spec, "id", out, bad, state, max_files=1) == 1
    staged = spark.read.parquet(f"{state}/staged/run_id=1/batch_id=0")
    tasks = staged.groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == parts[0].count()
    assert seen == [METHOD_BYTES] and spark.conf.get(METHOD_LIMIT, None) == before


def test_labels_of_a_pruned_run_are_those_without_the_filter(spark, tmp_path, deliveries):
    from itinera.plans.clean import route_rows, stage_rows, turned_down

    spec, parts = deliveries
    stage_rows(parts[1], spec).write.parquet(str(tmp_path / "staged"))
    rows = route_rows(spark.read.parquet(str(tmp_path / "staged")), spec, "id")
    target = clean_bookings(parts[0], spec, "id").accepted
    pruned, plain = (turned_down(rows, spec, "id", target, (), prune) for prune in (True, False))
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, plain.collect()))
    assert pruned.where("__status = 'DB UNIQUE VIOLATION'").count() > 0
