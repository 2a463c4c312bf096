"""Profiling, features and models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import oracle
from checks.registry import Data, plain, query
from itinera.operators import features, profile
from itinera.operators.grouped import fill_forward, running_sum
from itinera.operators.quantiles import quantile_clip
from itinera.plans import models


@query(
    "a3_conditional_max",
    "SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_partkey END) AS p1, max(CASE WHEN l_linenumber = 2 THEN l_partkey END) AS p2 FROM lineitem GROUP BY l_orderkey",
)
def a3(d: Data) -> DataFrame:
    at = lambda k: F.max(F.when(F.col("l_linenumber") == k, F.col("l_partkey"))).alias(f"p{k}")
    return d.table("lineitem").groupBy("l_orderkey").agg(at(1), at(2))


def _fill_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total, count({c}) AS filled, count(*) - count({c}) AS missing, round(100.0 * count({c}) / count(*), 4) AS filled_pct FROM {source}"
        for c in columns
    )


@query("a6_fill_rate", oracle("v_leg", _fill_sql(["fn_raw", "dt_raw", "arr"], "v_leg")))
def a6(d: Data) -> DataFrame:
    return plain(profile.fill_rate(d.view("v_leg"), ["fn_raw", "dt_raw", "arr"]))


@query(
    "a7_count_distinct_having",
    "SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY o_custkey HAVING count(*) > 5",
)
def a7(d: Data) -> DataFrame:
    per = d.table("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderpriority").alias("priorities")
    )
    return per.filter("n > 5")


@query(
    "a9_null_profile",
    oracle(
        "v_leg",
        "WITH s AS (SELECT fn_raw, dt_raw, arr FROM v_leg), u AS (SELECT DISTINCT * FROM s) "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS row_count, CAST(3 AS BIGINT) AS column_count, count(*) - (SELECT count(*) FROM u) AS duplicate_rows FROM s"
            for c in ("fn_raw", "dt_raw", "arr")
        ),
    ),
)
def a9(d: Data) -> DataFrame:
    return plain(profile.null_profile(d.view("v_leg").select("fn_raw", "dt_raw", "arr")))


@query(
    "a10_value_counts",
    "SELECT event_type, count(*) AS cnt, count(*) / (SELECT count(event_type) FROM events) AS share FROM events WHERE event_type IS NOT NULL GROUP BY event_type",
)
def a10(d: Data) -> DataFrame:
    return plain(profile.value_counts(d.table("events"), "event_type", normalize=True))


@query(
    "a11_group_mean_topk",
    "SELECT p_brand, round(avg(p_retailprice), 4) AS mean_value FROM part GROUP BY p_brand ORDER BY mean_value DESC, p_brand LIMIT 10",
)
def a11(d: Data) -> DataFrame:
    return profile.group_mean_top(d.table("part"), "p_brand", "p_retailprice", 10, digits=4)


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a12_variance_ranking",
    "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(var_samp({c}), 2) AS variance FROM lineitem" for c in _NUMBERS)
    + ") q ORDER BY variance DESC, feature LIMIT 3",
)
def a12(d: Data) -> DataFrame:
    return profile.variance_ranking(d.table("lineitem"), _NUMBERS, 3, digits=2)


@query(
    "a13_row_statistics",
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS a, CAST(o_custkey AS DOUBLE) AS b, CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE CAST(o_orderkey AS DOUBLE) END AS c FROM orders)
SELECT o_orderkey, round(list_avg([a, b, c]), 6) AS mean, round(coalesce(list_stddev_samp([a, b, c]), 0), 6) AS std, CAST((a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT AS BIGINT) AS missing FROM t""",
)
def a13(d: Data) -> DataFrame:
    k = F.col("o_orderkey")
    rows = d.table("orders").select(
        k,
        F.when(k % 5 != 0, F.col("o_totalprice")).alias("a"),
        F.col("o_custkey").cast("double").alias("b"),
        F.when(k % 15 != 0, k.cast("double")).alias("c"),
    )
    s = features.row_statistics(["a", "b", "c"])
    return plain(
        rows.select(
            k,
            F.round(s["feature_mean"], 6).alias("mean"),
            F.round(s["feature_std"], 6).alias("std"),
            s["feature_missing"].alias("missing"),
        )
    )


@query(
    "a14_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in _NUMBERS for b in _NUMBERS
    ),
)
def a14(d: Data) -> DataFrame:
    return profile.correlation_matrix(d.table("lineitem"), _NUMBERS, digits=6)


@query(
    "a15_quantile_clip",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.001) AS lo, quantile_cont(l_extendedprice, 0.999) AS hi FROM lineitem)
SELECT o_orderkey, round(CASE WHEN o_totalprice < lo THEN lo WHEN o_totalprice > hi THEN hi ELSE o_totalprice END, 6) AS clipped FROM orders, q""",
)
def a15(d: Data) -> DataFrame:
    out = quantile_clip(d.table("orders"), "o_totalprice", d.table("lineitem"), "l_extendedprice", out="clipped")
    return out.select("o_orderkey", F.round("clipped", 6).alias("clipped"))


_SCORE = "round(CASE WHEN sum(l_quantity * l_extendedprice * l_extendedprice) > 0 THEN sqrt(greatest(0, 1 - sum(l_quantity * power(l_extendedprice - l_extendedprice * (1 - l_discount), 2)) / sum(l_quantity * l_extendedprice * l_extendedprice))) ELSE 0 END, 6) AS score"


@query(
    "a16_weighted_score",
    f"SELECT 'all' AS l_returnflag, count(*) AS row_count, {_SCORE} FROM lineitem UNION ALL SELECT l_returnflag, count(*), {_SCORE} FROM lineitem GROUP BY l_returnflag",
)
def a16(d: Data) -> DataFrame:
    rows = d.table("lineitem").withColumn("p", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    args = ("l_extendedprice", "p", "l_quantity")
    whole = profile.weighted_score(rows, *args, digits=6).withColumn("l_returnflag", F.lit("all"))
    return whole.unionByName(profile.weighted_score(rows, *args, groups=["l_returnflag"], digits=6))


@query(
    "a17_distribution_summary",
    "WITH s AS (SELECT CAST(count(value) AS DOUBLE) AS c, avg(value) AS m, stddev_samp(value) AS sd, min(value) AS lo, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3, max(value) AS hi FROM events) "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS measure, round({c}, 6) AS value FROM s"
        for n, c in (("count", "c"), ("mean", "m"), ("std", "sd"), ("min", "lo"), ("25%", "q1"), ("50%", "q2"), ("75%", "q3"), ("max", "hi"))
    ),
)
def a17(d: Data) -> DataFrame:
    return profile.describe(d.table("events"), "value", digits=6)


@query("w3_running_sum", "SELECT event_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS errors FROM events")
def w3(d: Data) -> DataFrame:
    rows = d.table("events").withColumn("e", F.when(F.col("event_type") == "error", 1).otherwise(0))
    return plain(running_sum(rows, ["user_id"], ["ts", "event_id"], {"errors": "e"}).select("event_id", "errors"))


@query(
    "w6_lag_features",
    """WITH l AS (SELECT event_id, coalesce(value, 0) AS value, lag(value, 1) OVER w AS a, lag(value, 2) OVER w AS b, value - lag(value, 1) OVER w AS c FROM events WINDOW w AS (PARTITION BY event_type, user_id ORDER BY ts, event_id))
SELECT event_id, value, coalesce(a, 0) AS value_lag1, coalesce(b, 0) AS value_lag2, round(coalesce(c, 0), 6) AS value_diff1 FROM l""",
)
def w6(d: Data) -> DataFrame:
    out = features.lag_features(d.table("events"), ["event_type", "user_id"], ["ts", "event_id"], ["value"], 2)
    return out.select("event_id", "value", "value_lag1", "value_lag2", F.round("value_diff1", 6).alias("value_diff1"))


@query(
    "w7_forward_fill",
    """WITH v AS (SELECT event_id, ts, CASE WHEN event_id % 4 = 0 THEN event_type END AS kind FROM events)
SELECT event_id, last_value(kind IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kind FROM v""",
)
def w7(d: Data) -> DataFrame:
    rows = d.table("events").select("event_id", "ts", F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("kind"))
    return fill_forward(rows, [], ["ts", "event_id"], ["kind"]).select("event_id", "kind")


@query("w8_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def w8(d: Data) -> DataFrame:
    return d.table("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("w9_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def w9(d: Data) -> DataFrame:
    return d.table("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    "w10_time_split",
    """WITH t AS (SELECT DISTINCT ts FROM events), n AS (SELECT ts, row_number() OVER (ORDER BY ts) AS i, count(*) OVER () AS c FROM t), s AS (SELECT min(ts) AS start FROM n WHERE i >= floor(0.8 * c) + 1)
SELECT event_id, ts < start AS is_train FROM events, s""",
)
def w10(d: Data) -> DataFrame:
    return features.time_split(d.table("events"), "ts").select("event_id", "is_train")


_HASH = "CAST(concat('0x', substr(md5(concat('', '|', CAST({k} AS VARCHAR))), 1, 8)) AS BIGINT)"


@query(
    "w10_stratified_split",
    f"""WITH h AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_HASH.format(k='doc_id')}, doc_id) AS i, count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality AS quality, i <= round(n * 0.1) AS is_validation FROM h""",
)
def w10_stratified(d: Data) -> DataFrame:
    rows = d.table("labels").select("doc_id", "quality")
    return plain(features.stratified_split(rows, "quality", ["doc_id"], 0.1))


@query("w10_hash_split", f"SELECT o_orderkey, {_HASH.format(k='o_orderkey')} < 3435973836 AS is_train FROM orders")
def w10_hash(d: Data) -> DataFrame:
    return features.hash_split(d.table("orders").select("o_orderkey"), ["o_orderkey"], 0.8)


@query(
    "b10_label_encode",
    """WITH c AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL) q),
b AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL) q)
SELECT p_partkey, coalesce(c.code, -1) AS p_type_code, coalesce(b.code, -1) AS p_brand_code FROM part LEFT JOIN c ON part.p_type = c.p_type LEFT JOIN b ON part.p_brand = b.p_brand""",
)
def b10(d: Data) -> DataFrame:
    out = features.label_encode(d.table("part"), ["p_type", "p_brand"])
    return plain(out.select("p_partkey", "p_type_code", "p_brand_code"))


_SPLIT = "CAST(concat('0x', substr(md5(concat('', '|', CAST(l_orderkey AS VARCHAR), '|', CAST(l_linenumber AS VARCHAR), '|', CAST(l_partkey AS VARCHAR))), 1, 8)) AS BIGINT) < 3435973836"


_X = ("l_quantity", "l_discount", "l_tax")
# Least squares of three features: the normal equations of centred values, solved by Cramer's rule.
_DET = lambda r: " + ".join(f"{r[0][i]} * ({r[1][(i + 1) % 3]} * {r[2][(i + 2) % 3]} - {r[1][(i + 2) % 3]} * {r[2][(i + 1) % 3]})" for i in range(3))
_S = [[f"s{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
_SOLVED = ", ".join(f"({_DET([[f't{i}' if j == k else _S[i][j] for j in range(3)] for i in range(3)])}) / ({_DET(_S)}) AS b{k}" for k in range(3))


@query(
    "b11_compare_regressors",
    f"""WITH r AS (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(_X))}, CAST(l_extendedprice AS DOUBLE) AS y, {_SPLIT} AS is_train FROM lineitem),
m AS (SELECT avg(y) AS my, {", ".join(f"avg(x{i}) AS m{i}, covar_pop(x{i}, y) AS t{i}" for i in range(3))}, {", ".join(f"covar_pop(x{i}, x{j}) AS s{i}{j}" for i in range(3) for j in range(i, 3))} FROM r WHERE is_train),
w AS (SELECT *, {_SOLVED} FROM m),
h AS (SELECT y, y - my - b0 * (x0 - m0) - b1 * (x1 - m1) - b2 * (x2 - m2) AS d FROM r, w WHERE NOT is_train),
e AS (SELECT sqrt(avg(d * d)) AS rmse, 1 - sum(d * d) / (sum(y * y) - count(*) * avg(y) * avg(y)) AS r2 FROM h)
SELECT 'Linear Regression' AS model, round(rmse, 1) AS rmse, round(r2, 4) AS r2 FROM e UNION ALL SELECT 'Decision Tree', NULL, NULL UNION ALL SELECT 'Random Forest', NULL, NULL""",
)
def b11(d: Data) -> DataFrame:
    """The linear model's figures; SQL has no trees, tests hold them against a plain split."""
    rows = d.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", *_X)
    out = models.compare_regressors(rows, _X, "l_extendedprice", ["l_orderkey", "l_linenumber", "l_partkey"], trees=5)
    linear = F.col("model") == "Linear Regression"
    return out.select("model", F.when(linear, F.round("rmse", 1)).alias("rmse"), F.when(linear, F.round("r2", 4)).alias("r2"))


@query(
    "b12_boosted_forecast",
    """WITH t AS (SELECT DISTINCT ts FROM events), n AS (SELECT ts, row_number() OVER (ORDER BY ts) AS i, count(*) OVER () AS c FROM t), s AS (SELECT min(ts) AS start FROM n WHERE i >= floor(0.8 * c) + 1),
f AS (SELECT count_if(coalesce(ts < start, FALSE)) AS train_rows, count_if(NOT coalesce(ts < start, FALSE)) AS validation_rows FROM events, s)
SELECT f.*, 3 AS features, CAST(1 AS DOUBLE) AS importance, 0 AS missing_predictions FROM f""",
)
def b12(d: Data) -> DataFrame:
    events = features.lag_features(
        d.table("events").select("event_id", "ts", "user_id", "value"), ["user_id"], ["ts", "event_id"], ["value"], 2
    )
    events = features.time_split(events, "ts").withColumn("w", F.lit(1.0))
    events = events.withColumn("is_validation", ~F.col("is_train"))
    names = ["value_lag1", "value_lag2", "user_id"]
    model = models.boosted_forecast(events, names, "value", "w", "is_validation", iterations=5, depth=3)
    facts = models.forecast(model, events, names).agg(
        F.count_if("is_train").alias("train_rows"),
        F.count_if("is_validation").alias("validation_rows"),
        F.count_if(F.col("prediction").isNull() | F.isnan("prediction")).alias("missing_predictions"),
    )
    weights = models.top_importances(d.spark, model, names).agg(F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("importance"))
    return plain(facts.join(F.broadcast(weights), F.lit(True)))  # one row each
