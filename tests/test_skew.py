"""Hot keys: results equal the plain form, and no task holds a whole group."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from itinera.operators import dedupe, features, grouped, profile
from itinera.operators.quantiles import exact_quantiles, exact_ranks
from itinera.operators.segment import trips_gap
from itinera.plans import delay, trips


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one blank key, another third a null key."""
    return (
        spark.range(6000)
        .select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, F.lit("")).when(F.col("id") % 3 == 2, F.concat(F.lit("K"), F.col("id") % 50)).alias("k"),
            (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") * 7919) % 9000)).alias("t"),
            ((F.col("id") * 37) % 101).cast("double").alias("v"),
        )
        .cache()
    )


def same(a, b, *columns):
    assert sorted(map(str, a.select(*columns).collect())) == sorted(map(str, b.select(*columns).collect()))


@pytest.mark.parametrize("backward", [False, True])
def test_trips_match_plain_windows(hot, backward):
    args = (["k"], "t", ["t", "id"])
    for rows in (150, 700):
        spread = trips_gap(hot, *args, gap_seconds=3600, break_on_backward=backward, rows_per_chunk=rows)
        plain = trips_gap(hot, *args, gap_seconds=3600, break_on_backward=backward, bounded_keys=True)
        same(spread, plain, "id", "trip_id", "leg_no")


@pytest.mark.parametrize("keys,order", [(["k"], ["t", "id"]), (["k"], ["few", "text", "id"]), ([], ["text"])])
def test_hot_groups_are_cut_evenly(spark, hot, keys, order):
    """Blank and null keys, order columns of few values and text order: no chunk over twice its size, in row order."""
    df = hot.withColumns({"few": (F.col("id") % 2).cast("int"), "text": F.concat(F.lit("same prefix "), F.lpad(F.col("id").cast("string"), 6, "0"))})
    splits = grouped.hot_splits(df, keys, order, 200)
    assert {r["__group"][0] for r in splits.collect()} == ({None, ""} if keys else {1})
    rows = grouped.chunked(df, keys, order, splits)
    sizes = rows.groupBy("__group", "__chunk").count().where("__chunk is not null").collect()
    assert len(sizes) > 12 and max(r["count"] for r in sizes) <= 2.5 * 200
    at = F.struct(*order)
    ranges = rows.where("__chunk is not null").groupBy("__group", "__chunk").agg(F.min(at).alias("a"), F.max(at).alias("z")).collect()
    ranges.sort(key=lambda r: (str(r["__group"]), r["__chunk"]))
    assert all(x["z"] < y["a"] for x, y in zip(ranges, ranges[1:]) if x["__group"] == y["__group"])
    assert grouped.hot_splits(df, ["id"], order, 200) is None


def test_one_exchange_of_whole_rows(spark, hot):
    """Without hot groups one exchange; with them one that carries whole rows and narrow ones for the summary."""
    wide = hot.withColumns({f"w{i}": F.col("id") + i for i in range(5)})
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(grouped.number_within(wide, ["k"], ["t", "id"])).count("Exchange hashpartitioning") == 1
    cut = plan(grouped.number_within(wide, ["k"], ["t", "id"], rows_per_chunk=200))
    carrying = [line for line in cut.split("\n") if "Window" in line and "w4" in line]
    assert len(carrying) <= 1 and "SinglePartition" not in cut


def test_trips_over_two_level_chunks(hot):
    df = hot.withColumn("slot", (F.col("id") % 4).cast("int"))
    args = (["k"], "t", ["slot", "t", "id"], 7200, True)
    same(trips_gap(df, *args, rows_per_chunk=200), trips_gap(df, *args, bounded_keys=True), "id", "trip_id", "leg_no")


def test_exact_gap_joins_and_backward_breaks(spark):
    df = spark.createDataFrame(
        [(1, "a", "2024-01-01 00:00"), (2, "a", "2024-01-02 12:00"), (3, "a", "2024-01-04 00:01"), (4, "a", "2024-01-03 00:00")],
        "n int, k string, t string",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = lambda b: [r["trip_id"] for r in trips_gap(df, ["k"], "t", ["n"], break_on_backward=b).orderBy("n").collect()]
    assert got(False) == [1, 1, 2, 2]
    assert got(True) == [1, 1, 2, 3]


def test_shift_number_fill_match_pandas(hot):
    pdf = hot.toPandas()
    pdf["k"] = pdf["k"].fillna("<null>")
    pdf = pdf.sort_values(["t", "id"]).reset_index(drop=True)
    g = pdf.groupby("k")
    want = pdf.assign(p2=g["v"].shift(2), n1=g["v"].shift(-1), pos=g.cumcount() + 1).set_index("id").sort_index()
    got = grouped.shift_within(hot, ["k"], ["t", "id"], {"p2": ("v", -2), "n1": ("v", 1)}, rank="pos", rows_per_chunk=200)
    got = got.toPandas().set_index("id").sort_index()
    for c in ("p2", "n1", "pos"):
        pd.testing.assert_series_equal(got[c], want[c], check_dtype=False)

    sparse = hot.withColumn("v", F.when(F.col("id") % 11 == 0, F.col("v")))
    filled = grouped.fill_forward(sparse, [], ["t", "id"], ["v"], rows_per_chunk=200).toPandas().set_index("id").sort_index()
    ref = sparse.toPandas().sort_values(["t", "id"])
    ref["v"] = ref["v"].ffill()
    pd.testing.assert_series_equal(filled["v"], ref.set_index("id").sort_index()["v"], check_dtype=False)


def test_running_sum_matches_pandas(hot):
    got = grouped.running_sum(hot, ["k"], ["t", "id"], {"total": "v"}, rows_per_chunk=200).toPandas().set_index("id").sort_index()
    pdf = hot.toPandas().sort_values(["t", "id"])
    want = pdf.assign(total=pdf.groupby(pdf["k"].fillna("<null>"))["v"].cumsum()).set_index("id").sort_index()
    pd.testing.assert_series_equal(got["total"], want["total"], check_dtype=False)


def test_flag_repeats_keeps_the_first(hot):
    same(
        dedupe.flag_repeats(hot, ["k"], ["id"]).filter("NOT is_repeat"),
        dedupe.keep_first(hot, ["k"], ["id"]),
        "id",
    )


def test_flag_repeats_keeps_exactly_one_per_key(hot):
    marked = dedupe.flag_repeats(hot, ["k"], ["id"])
    kept = marked.filter("NOT is_repeat")
    assert marked.count() == 6000
    assert kept.count() == hot.select("k").distinct().count()
    assert kept.filter("k = ''").first()["id"] == 0


def test_adaptive_skew_join_splits_the_hot_key(spark, hot):
    """The summary side has an exchange of its own, which is what lets the adaptive rule split a hot key."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = grouped.attach_group(hot.repartition(16), ["k"], [F.max("v").alias("top")])
        assert out.count() == 6000
        out.write.format("noop").mode("overwrite").save()
        collected = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(collected) == 6000
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keep_first_limits_before_the_shuffle(hot):
    plan = dedupe.keep_first(hot, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-20, 20), min_size=1, max_size=60))
def test_exact_quantiles_match_pandas(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    want = pd.Series(values, dtype=float).quantile([0.001, 0.25, 0.5, 0.999]).tolist()
    assert exact_quantiles(df, "v", [0.001, 0.25, 0.5, 0.999]) == pytest.approx(want)


@pytest.mark.parametrize("shape", ["even", "heavy", "one"])
def test_ranks_by_coarse_sketches(spark, shape):
    """Brackets and cells far smaller than the column, values that fill whole brackets, many ranks at once."""
    v = {"even": "(id * 7919) % 50021", "heavy": "case when id % 3 = 0 then 7 else pow(id % 1000, 2) end", "one": "5"}[shape]
    df = spark.range(50_000).selectExpr(f"cast({v} as double) as v").unionByName(spark.sql("select cast(null as double) as v"))
    ordered = sorted(r["v"] for r in df.collect() if r["v"] is not None)
    ranks = [0, 1, 17, 24_999, 25_000, 25_001, 33_333, 49_998, 49_999]
    assert exact_ranks(df, "v", lambda n: ranks, accuracy=200, cells=50) == {r: ordered[r] for r in ranks}
    assert exact_quantiles(df.where("v < -1"), "v", [0.5]) == [None]


def test_ranks_take_three_passes(spark, monkeypatch):
    from itinera.operators import quantiles

    jobs = []
    monkeypatch.setattr(quantiles, "_picked", lambda *a, real=quantiles._picked: jobs.append("third") or real(*a))
    real = quantiles._sketch
    monkeypatch.setattr(quantiles, "_sketch", lambda *a: jobs.append("sketch") or real(*a))
    df = spark.range(30_000).selectExpr("cast(id % 9973 as double) as v")
    assert len(exact_quantiles(df, "v", [i / 40 for i in range(41)], 1_000, 100)) == 41
    assert jobs == ["sketch", "sketch", "third"]


def test_split_and_codes(spark, hot):
    split = features.stratified_split(hot, "k", ["id"], 0.1)
    per = split.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_validation").alias("m")).collect()
    assert all(r["m"] == int(r["n"] * 0.1 + 0.5) for r in per)
    coded = features.label_encode(hot, ["k"])
    pairs = {(r["k"], r["k_code"]) for r in coded.select("k", "k_code").distinct().collect()}
    values = sorted(k for k, _ in pairs if k is not None)
    assert pairs == {(None, -1)} | {(v, i) for i, v in enumerate(values)}


def test_codes_of_one_prefix_are_ranked_in_parts(spark):
    values = spark.range(20_000).select(F.concat(F.lit("one and the same prefix "), (F.col("id") * 7919) % 19_997).alias("c"))
    codes = features.category_codes(values, "c", 1_000)
    got = {r["value"]: r["code"] for r in codes.collect()}
    assert got == {v: i for i, v in enumerate(sorted({r["c"] for r in values.collect()}))}


@pytest.mark.parametrize("mark", ["row", "connection"])
def test_delay_of_shared_connections(spark, mark):
    """A blank id and a wrongly shared one hold most legs, with few leg numbers: cut or whole, the outcome is the same."""
    minute = lambda e: F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=e)
    i = F.col("id")
    names = {"DepartureScheduledTimeLocal": i * 7, "ArrivalScheduledTimeLocal": i * 7 + 90, "ArrivalRevisedTimeLocal": i * 7 + 90 + i % 300}
    legs = spark.range(3_000).select(
        i.alias("Id"),
        F.when(i % 3 == 0, F.lit("")).when(i % 3 == 1, F.lit("shared")).when(i % 30 == 2, None).otherwise(F.concat(F.lit("c"), F.floor(i / 12))).alias("ConnectionID"),
        (i % 4).cast("int").alias("LegNo"),
        *[minute(e.cast("int")).alias(n) for n, e in names.items()],
        *[F.lit(None).cast("timestamp_ntz").alias(n) for n in ("ArrivalRunwayTimeLocal", "DepartureRevisedTimeLocal", "DepartureRunwayTimeLocal")],
    )
    cut = delay.delay_eligibility(legs, mark=mark, layover_as_delay=True, rows_per_chunk=100)
    assert cut.where("IsDelayEligible = 1").count() > 0 and cut.where("ConnectionID is null and IsDelayEligible = 1").count() == 0
    same(cut, delay.delay_eligibility(legs, mark=mark, layover_as_delay=True), *cut.columns)


def test_correlations_of_300_columns_in_one_pass(spark):
    """Gaps, a constant column, large offsets; against pandas, pair by pair."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 300)) + rng.normal(size=(700, 1)) + np.arange(300) * 1e5
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 3.0
    names = [f"n{i}" for i in range(300)]
    frame = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"{n} double" for n in names)).repartition(5)
    got = profile.correlation_matrix(df, names).toPandas().pivot(index="a", columns="b", values="r").loc[names, names]
    want = frame.corr(min_periods=2)
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(), rtol=0, atol=1e-6)
    assert profile.correlation_matrix(df.limit(0), names[:2]).collect() == []


def test_trip_of_any_length_in_fixed_width_rows(spark):
    """A blank reference holds one trip of 5,000 legs: no array holds them, and no leg is lost."""
    i = F.col("id")
    legs = spark.range(6_000).select(
        F.when(i < 5_000, F.lit("")).when(i % 2 == 0, None).otherwise(F.concat(F.lit("b"), F.floor(i / 4))).alias("ref"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=i.cast("int"))).alias("dt"),
        F.lit(1).alias("slot"),
        i.alias("tie"),
        F.concat(F.lit("XX"), i).alias("fn"),
        F.lit("AAA").alias("dep"),
        F.when(i % 7 > 0, "BBB").alias("arr"),
    )
    wide, rest = trips.reconstruct_trips_and_legs(legs, ["ref"], ["tie"], 3, ["tie"])
    assert "overflow_legs" not in wide.columns and "collect" not in wide._jdf.queryExecution().optimizedPlan().toString()
    hot = wide.where("ref = ''").collect()
    assert [(r.trip_id, r.leg_count, r.FlightNumber3, r.tie) for r in hot] == [(1, 5_000, "XX2", 0)]
    rows = rest.where("ref = ''").orderBy("leg").collect()
    assert [(r.leg, r.fn, r.arr) for r in rows] == [(k + 1, f"XX{k}", "BBB" if k % 7 else None) for k in range(3, 5_000)]
    shown = sum(F.col(f"FlightNumber{k}").isNotNull().cast("long") for k in (1, 2, 3))
    assert wide.select(F.sum(shown)).first()[0] + rest.count() == legs.count()
    of = trips.reconstruct_trips(legs, ["ref"], ["tie"], 3, ["tie"]).select("ref", "trip_id", F.inline("overflow_legs"))
    assert of.exceptAll(rest).count() == 0 and rest.exceptAll(of).count() == 0
    none, no_legs = trips.reconstruct_trips_and_legs(legs.limit(0), ["ref"], ["tie"], 3)
    assert none.count() == 0 and no_legs.count() == 0
