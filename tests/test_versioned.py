"""Table changes that commit as one step or leave no trace."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from itinera.session import scratch_path
from itinera.sinks.versioned import CommitConflict, VersionedTable


@pytest.fixture
def table(spark):
    t = VersionedTable(spark, scratch_path(spark, "versioned"))
    t.replace(spark.range(100, numPartitions=4).select("id", (F.col("id") % 7).alias("k"), F.lit("old").alias("v")))
    return t


def content(df):
    return sorted(tuple(r) for r in df.collect())


def stored_files(table):
    return {(f, n) for f in table.files.names(f"{table.path}/data") for n in table.files.names(f"{table.path}/data/{f}") if n.endswith(".parquet")}


def test_every_change_is_one_version_and_readers_are_pinned(spark, table):
    first = table.read()
    before = content(first)
    table.append(spark.range(100, 105).select("id", F.lit(0).alias("k"), F.lit("new").alias("v")))
    table.update_from(spark.createDataFrame([(3, "u"), (102, None), (999, "x")], "id long, v string"), ["id"], ["v"])
    table.replace_subset(F.col("id") == 50, lambda x: x.unionByName(x.withColumn("v", F.lit("twice"))))
    table.delete_where((F.col("k") == 6) | F.lit(None).cast("boolean"))
    table.append_if_absent(spark.createDataFrame([(3, 1, "a"), (500, 1, "b"), (500, 1, "c")], "id long, k long, v string"), ["id"], ["v"])
    expected = {i: (i, i % 7, "old") for i in range(100)} | {i: (i, 0, "new") for i in range(100, 105)}
    expected[3], expected[102] = (3, 3, "u"), (102, 0, None)
    rows = [*expected.values(), (50, 50 % 7, "twice")]
    rows = [r for r in rows if r[1] != 6] + [(500, 1, "b")]
    assert sorted(table.read().collect(), key=str) == sorted(rows, key=str)
    assert table.versions() == [1, 2, 3, 4, 5, 6]
    assert content(first) == before == content(table.read(1))
    with pytest.raises(ValueError, match="no version"):
        table.read(9)


def test_only_files_with_changed_rows_are_rewritten(spark, table):
    old = stored_files(table)
    table.update_from(spark.createDataFrame([(3, "u")], "id long, v string"), ["id"], ["v"])
    kept = {p.rsplit("/", 1)[1] for p in table._paths(table.manifest())} & {n for _, n in old}
    assert len(kept) == 3
    table.update_from(spark.createDataFrame([(3, "w")], "id long, v string"), ["id"], ["v"], F.col("k") == 0)
    assert table.versions() == [1, 2]  # nothing to change, no version


def test_a_failing_task_rolls_back(spark, table):
    before, files = content(table.read()), stored_files(table)
    broken = F.when(F.col("id") == 77, F.raise_error(F.lit("a task fails"))).otherwise(F.lit("half"))
    with pytest.raises(Exception, match="a task fails"):
        with table.transaction() as t:
            t.delete_where(F.col("id") < 10)
            t.append(spark.range(1000, 1010).select("id", F.lit(1).alias("k"), F.lit("x").alias("v")))
            t.replace_subset(F.col("id") > 20, lambda x: x.withColumn("v", broken))
    assert content(table.read()) == before and table.versions() == [1] and stored_files(table) == files
    with pytest.raises(KeyError):
        with table.transaction() as t:
            t.delete_where(F.col("id") < 10)
            raise KeyError("driver")
    assert content(table.read()) == before and stored_files(table) == files


def test_changes_of_a_transaction_see_each_other_and_commit_once(spark, table):
    with table.transaction() as t:
        t.delete_where(F.col("id") >= 5)
        t.append(t.read().withColumn("id", F.col("id") + 1000))
        t.replace_subset(F.col("id") == 1004, lambda x: x.withColumn("v", F.lit("seen")))
        assert table.read().count() == 100  # others do not see it yet
    assert table.versions() == [1, 2]
    assert content(table.read()) == sorted([(i, i % 7, "old") for i in range(5)] + [(i + 1000, i % 7, "seen" if i == 4 else "old") for i in range(5)])


def test_of_two_writers_the_first_wins(spark, table):
    with pytest.raises(CommitConflict):
        with table.transaction() as slow:
            slow.delete_where(F.col("id") < 50)
            table.update_from(spark.createDataFrame([(1, "fast")], "id long, v string"), ["id"], ["v"])
    assert table.versions() == [1, 2] and table.read().count() == 100
    assert table.read().where("id = 1").first()["v"] == "fast"


def test_a_table_replaces_itself_and_old_versions_go(spark, table):
    table.replace(table.read().where("id < 3").withColumn("extra", F.lit(1.5)))
    assert content(table.read()) == [(i, i, "old", 1.5) for i in range(3)]
    table.files.write(f"{table.path}/data/left/part-0.parquet", "of a run that died")
    table.vacuum()
    assert table.versions() == [2] and len(table.files.names(f"{table.path}/data")) == 1
    assert table.read().count() == 3


def test_empty_tables(spark):
    t = VersionedTable(spark, scratch_path(spark, "versioned"))
    assert t.manifest() is None
    with pytest.raises(ValueError, match="no version"):
        t.read()
    t.append(spark.createDataFrame([], "id long, v string"))
    t.delete_where(F.col("id") == 1)
    assert t.read().collect() == [] and t.read().columns == ["id", "v"]


def test_cleanup_removes_what_the_application_stored(spark, tmp_path, monkeypatch):
    from itinera import session

    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    spark.range(3).write.parquet(session.scratch_path(spark, "mine"))
    (tmp_path / "itinera" / "another-application").mkdir()
    assert session.cleanup(spark)
    assert [x.name for x in (tmp_path / "itinera").iterdir()] == ["another-application"]
    assert not session.cleanup(spark)
