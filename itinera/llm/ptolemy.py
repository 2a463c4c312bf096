"""Centroid clustering in whole numbers, pruned by Ptolemy's inequality over pivots.

Vectors become integers, so every distance, sum and mean is exact and does not depend on the order of rows. A few of the
starting centroids, chosen far apart, stay pivots for good; each vector's distances to them are stored beside it once. For
pivots p and s Ptolemy's inequality says d(x, c) d(p, s) >= |d(x, p) d(c, s) - d(x, s) d(c, p)|, which bounds the distance to
a centroid from below by cached numbers alone. A round takes the centroid with the least bound, measures it exactly, drops all
whose bound lies above that distance and measures the rest exactly. Bounds are rounded down by more than their error.

A round is one pass over the stored vectors: a task adds up its own vectors by cluster and sends k rows of sums. Only those k
sums reach the driver, and centroids travel in the task's closure; both are as long as k times the dimensions.

Edge cases: vectors that are null, of another length, or hold null or non-finite components are left out and give no row;
repeated rows count each; rows with a null id are clustered but start no centroid; of equal hashes the smaller vector
(as bytes) comes first; fewer vectors than k give fewer centroids; an empty table gives an empty result; other columns are
not read. Components beyond 2^19 would make squared distances leave a long, so they are refused with an error.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itinera.llm.common import map_rows, stored

PIVOTS = 8
_HALF_LONG = 2**27


def whole_numbers(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, x): floor(scale * component) as little-endian 32-bit integers, only of vectors that take part."""
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))

    def run(batches):
        for batch in batches:
            length = pc.fill_null(pc.list_value_length(batch.column(1)), -1)
            batch = batch.filter(pc.equal(length, dims))
            values = pc.list_flatten(batch.column(1)).to_numpy(zero_copy_only=False).reshape(-1, dims)  # null becomes NaN
            fine = np.isfinite(values).all(axis=1)
            with np.errstate(over="ignore"):
                x = np.floor(scale * values[fine])
            if x.size and np.abs(x).max() >= _HALF_LONG:
                raise ValueError("a component is too large: squared distances would not fit a long")
            ids = batch.column(0).filter(pa.array(fine))
            yield pa.RecordBatch.from_arrays([ids, pa.array([v.tobytes() for v in x.astype("<i4")], pa.binary())], names=["vec_id", "x"])

    return read.mapInArrow(run, "vec_id long, x binary")


def starting_centroids(kept: DataFrame, k: int, seed: str, dims: int) -> np.ndarray:
    """The k vectors with the smallest hash of ``seed:vec_id``."""
    hashed = kept.where("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256))
    first = hashed.orderBy("h", "x").limit(k).select("x").collect()  # k rows
    return np.array([np.frombuffer(r.x, "<i4") for r in first], np.int64).reshape(-1, dims)


class Bounds:
    """Fixed pivots, and lower bounds of distances to centroids."""

    def __init__(self, starts: np.ndarray, count: int):
        chosen = [0] if len(starts) else []
        while chosen and len(chosen) < count:  # the next one lies furthest from those chosen
            away = np.min([squared(starts, starts[c]) for c in chosen], axis=0)
            if not away.max():
                break
            chosen.append(int(away.argmax()))
        self.pivots = starts[chosen]
        self.pairs = list(combinations(range(len(chosen)), 2))
        self.apart = [float(np.sqrt(squared(self.pivots[i : i + 1], self.pivots[j])[0])) for i, j in self.pairs]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """(rows, pivots), as cached."""
        out = np.empty((len(x), len(self.pivots)))
        for i, p in enumerate(self.pivots):
            out[:, i] = np.sqrt(squared(x, p))
        return out

    def below(self, mine: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """(rows, centroids): never above the true distance. Products of two distances are off by less than 4 ulp."""
        theirs = self.distances(centroids)
        out = np.zeros((len(mine), len(centroids)))
        slack = 1e-14 * float(mine.max(initial=0.0)) * float(theirs.max(initial=0.0))
        for (i, j), apart in zip(self.pairs, self.apart, strict=True):
            bound = np.abs(np.outer(mine[:, i], theirs[:, j]) - np.outer(mine[:, j], theirs[:, i]))
            np.maximum(out, (bound - slack) / (apart * (1 + 1e-14)), out=out)
        return out


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one vector: in doubles while all sums stay below 2^53, else in longs."""
    if not len(x):
        return np.zeros(0, np.int64)
    small = max(int(np.abs(x).max()), int(np.abs(c).max())) < 2**21 and x.shape[1] <= 512
    away = x.astype(np.float64 if small else np.int64) - c
    return np.einsum("rd,rd->r", away, away).astype(np.int64)


def assign(x: np.ndarray, mine: np.ndarray, centroids: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, exact measurements made): the nearest centroid of each row, ties to the smaller number."""
    below = bounds.below(mine, centroids)
    guess = below.argmin(axis=1)
    near = np.empty(len(x), np.int64)
    for c in range(len(centroids)):
        rows = np.flatnonzero(guess == c)
        near[rows] = squared(x[rows], centroids[c])
    survives = below * below * (1 - 1e-12) <= near[:, None]
    survives[np.arange(len(x)), guess] = False
    best, cluster = near, guess
    for c in range(len(centroids)):
        rows = np.flatnonzero(survives[:, c])
        away = squared(x[rows], centroids[c])
        better = (away < best[rows]) | ((away == best[rows]) & (c < cluster[rows]))
        rows = rows[better]
        best[rows], cluster[rows] = away[better], c
    return cluster, best, len(x) + int(survives.sum())


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2", pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every vector that takes part, after ``rounds`` rounds."""
    spark = vectors.sparkSession
    kept = whole_numbers(vectors, dims, scale)
    centroids = starting_centroids(kept, k, seed, dims)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    bounds = Bounds(centroids, pivots)

    def cache(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch["x"]), "<i4").reshape(-1, dims).astype(np.int64)
            yield batch["vec_id"], batch["x"], [d.tobytes() for d in bounds.distances(x).astype("<f8")]

    cached = stored(map_rows(kept, cache, "vec_id long, x binary, away binary"), "pivots")

    def arrays(batch):
        x = np.frombuffer(b"".join(batch["x"]), "<i4").reshape(-1, dims).astype(np.int64)
        return x, np.frombuffer(b"".join(batch["away"]), "<f8").reshape(len(x), -1)

    for _ in range(rounds):
        fixed = centroids

        def add_up(batches, fixed=fixed):
            total, number = np.zeros((len(fixed), dims), np.int64), np.zeros(len(fixed), np.int64)
            for batch in batches:
                x, away = arrays(batch)
                mine, _, _ = assign(x, away, fixed, bounds)
                np.add.at(total, mine, x)
                number += np.bincount(mine, minlength=len(fixed))
            some = np.flatnonzero(number)
            yield some.tolist(), number[some].tolist(), total[some].tolist()

        parts = map_rows(cached.select("x", "away"), add_up, "cluster int, n long, total array<long>")
        exact = lambda c: F.sum(c.cast("decimal(20,0)"))
        sums = parts.groupBy("cluster").agg(exact(F.col("n")).alias("n"), *[exact(F.col("total")[i]).alias(f"t{i}") for i in range(dims)])
        centroids = fixed.copy()
        for row in sums.collect():  # k rows
            centroids[row.cluster] = [int(row[f"t{i}"]) // int(row.n) for i in range(dims)]

    def last(batches):
        for batch in batches:
            mine, near, _ = assign(*arrays(batch), centroids, bounds)
            yield batch["vec_id"], mine.tolist(), near.tolist()

    assigned = stored(map_rows(cached, last, "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # k rows
    facts = spark.createDataFrame(
        [(c, s, sum(inertia.values()), centroids[c].tolist()) for c, s in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")  # k rows


def op11(spark, sf_dir: str) -> DataFrame:
    found = cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    joined = F.concat_ws(",", F.transform("centroid", lambda v: v.cast("string")))
    return found.withColumn("centroid_sha256", F.sha2(joined.cast("binary"), 256)).drop("centroid")


def sql(k: int = 40, rounds: int = 5) -> str:
    """The same in SQL, one step after another."""
    assigned = (
        "SELECT rid, vec_id, x, arg_min(c, d * 1000 + c) AS c, min(d) AS d FROM (SELECT rid, vec_id, k.x, c.c, list_sum(list_transform(list_zip(k.x, c.x), "
        "lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM k, c{0} c) GROUP BY rid, vec_id, x"
    )
    steps = [
        """k AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, x FROM k WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {k}))",
    ]
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({assigned.format(i)})")
        steps.append(
            f"m{i} AS (SELECT c, list(m ORDER BY p) AS x FROM (SELECT c, p, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS m "
            f"FROM (SELECT c, unnest(x) AS v, unnest(range(1, 65)) AS p FROM a{i}) GROUP BY c, p) GROUP BY c)"
        )
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x::BIGINT[], c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.c = c.c)")
    steps.append(f"z AS MATERIALIZED ({assigned.format(rounds)})")
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, CAST(z.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY z.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM z JOIN c{rounds} c ON c.c = z.c"""
    )
