"""Nearest neighbours by inner product over balanced posting lists.

Largest inner product becomes least distance: every vector gets one more component that lifts it to the greatest norm
M, and queries are scaled to M. Centroids are fitted by balanced k-means on a bounded sample of distinct vectors
(``sample``, or four for each centroid where that is more); clusters that hold far more than their share are split. A graph links every centroid to its nearest
others; it is held in memory by each task and searched best-first from fixed entries.

Every distinct vector goes to the lists of its nearest centroids: the nearest one, and as a boundary vector up to
``COPIES`` in all whose distance is within ``BOUNDARY`` of it. A query reads the lists whose centroids lie within a
ratio of its nearest centroid's distance, or of the distance that is usual among queries where its own is less: a query
that stands apart has a centroid to itself, whose distance says nothing about its neighbours. The ratio is measured: for a
bounded set of query rows the true neighbours are found by brute force over all vectors, and the ratio that reaches
``TARGET`` of them is taken. The search of the graph is measured with it, and takes more nodes until it reaches them too.
Where the lists within the ratio hold fewer than k + 1 ids, a query reads the next nearest lists until they do.

Lists are dealt to groups of bounded size. A task holds one group and streams the queries that probe any of its lists,
so each query gives one row a group and not one a list. Equal vectors are one entry with its k + 1 smallest ids, which
is all that any answer can need.

Edge cases: vectors without part (null, zero, holding null or non-finite components) are neither queries nor
candidates; null ids neither; of a repeated id each row can be found, the id comes once; with fewer candidates than k all
are returned; an empty table gives an empty result; vectors must be equally long; other columns are not read. Vectors of
any finite length are placed, as lengths are taken in a unit near the greatest.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itinera.llm.common import lowest, map_rows, stored, unsigned
from itinera.llm.vectors import matrix, usable

K = 20
SAMPLE = 20_000
#: Centroids: about the square root of the vectors times this, at most ...
DENSITY, MOST = 1.0, 16_384
COPIES, BOUNDARY = 4, 1.05
TARGET, PROBES = 0.98, 400
#: Entries of a group of lists at most and, where there are enough tasks, about; links of a centroid in the graph.
GROUP, LEAST_GROUP, DEGREE = 100_000, 8_000, 16
#: Distinct queries that one task answers at most.
ASKED = 50_000
#: Vectors that are held against all centroids at once: at most _BATCH, and so many that their distances are at most _CELLS.
_BATCH, _CELLS = 1024, 1 << 22


class Centroids:
    """Centroids with a graph over them; all of them and the common norm are in units of ``unit``."""

    def __init__(self, points: np.ndarray, norm: float, unit: float = 1.0):
        self.points, self.norm, self.unit = points, norm, unit
        n = len(points)
        square = (points * points).sum(axis=1)
        degree = min(DEGREE, n - 1)
        rng = np.random.default_rng(3)
        links = []
        for at in range(0, n, 1024):
            part = points[at : at + 1024]
            away = square - 2 * part @ points.T
            away[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
            near = np.argpartition(away, max(0, degree - 1), axis=1)[:, :degree] if degree else np.zeros((len(part), 0), int)
            links.append(near)
        near = np.concatenate(links) if links else np.zeros((0, 0), int)
        # a ring over a shuffled order keeps the graph in one piece
        order = rng.permutation(n)
        ring = np.empty((n, 2), int)
        ring[order, 0], ring[order, 1] = np.roll(order, 1), np.roll(order, -1)
        self.links = np.concatenate([near, ring], axis=1)
        self.entries = order[: min(n, 8)]
        self.batch = max(1, min(_BATCH, _CELLS // max(1, n)))

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that lifts them to the common norm."""
        return _lift(x / self.unit, self.norm)

    def scale(self, q: np.ndarray) -> np.ndarray:
        """Queries, scaled to the common norm."""
        q = q / np.abs(q).max(axis=1, keepdims=True)
        return np.c_[q * (self.norm / np.linalg.norm(q, axis=1, keepdims=True)), np.zeros(len(q))]

    def away(self, x: np.ndarray) -> np.ndarray:
        """(rows, centroids) distances, all of them."""
        return np.stack([np.sqrt(np.square(self.points - row).sum(axis=1)) for row in x])

    def search(self, x: np.ndarray, ratio: float, least: int, usual: float = 0.0) -> np.ndarray:
        """(rows, centroids) distances, infinite where the search did not come: best-first along the graph, until the next
        node is further than ``ratio`` times the nearest (or ``usual``, if that is more) and at least ``least`` nodes were
        taken."""
        found = np.full((len(x), len(self.points)), np.inf)
        taken = np.zeros(found.shape, bool)
        live = np.arange(len(x))

        def look(rows, nodes):
            away = x[rows][:, None, :] - self.points[nodes]
            found[rows[:, None], nodes] = np.sqrt(np.einsum("rnd,rnd->rn", away, away))

        look(live, np.tile(self.entries, (len(x), 1)))
        for step in range(len(self.points)):
            open_ = np.where(taken[live], np.inf, found[live])
            pick = open_.argmin(axis=1)
            away = open_[np.arange(len(live)), pick]
            go = np.isfinite(away) & ((away <= ratio * np.maximum(found[live].min(axis=1), usual)) | (step < least))
            live, pick = live[go], pick[go]
            if not len(live):
                break
            taken[live, pick] = True
            look(live, self.links[pick])
        return found

    def read(self, q: np.ndarray, ratio: float, least: int, usual: float, held: np.ndarray, enough: int) -> np.ndarray:
        """(rows, centroids): whether a scaled query reads the list. A query whose lists do not hold ``enough`` ids goes on to
        the next nearest; ``held`` counts each id in one list only."""
        found = self.search(q, ratio, least, usual)
        read = found <= ratio * np.maximum(found.min(axis=1, keepdims=True), usual)
        for i in np.flatnonzero(read @ held < enough).tolist():
            order = np.argsort(self.away(q[i : i + 1])[0], kind="stable")
            read[i, order[: np.searchsorted(np.cumsum(held[order]), enough) + 1]] = True
        return read

    def lists(self, x: np.ndarray) -> list[list[int]]:
        """The lists of lifted vectors: the nearest, and others nearly as near."""
        out: list[list[int]] = []
        for at in range(0, len(x), self.batch):
            found = self.search(x[at : at + self.batch], 1.0, 8)
            order = np.argsort(found, axis=1)[:, :COPIES]
            away = np.take_along_axis(found, order, axis=1)
            keep = away <= BOUNDARY * away[:, :1]
            out.extend(o[k].tolist() for o, k in zip(order, keep, strict=True))
        return out


def _lift(x: np.ndarray, norm: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(norm**2 - (x * x).sum(axis=1), 0.0))]


def _assigned(x: np.ndarray, points: np.ndarray, charge: np.ndarray | float = 0.0) -> np.ndarray:
    """The point of least squared distance plus charge, of each row; blocks of rows bound the memory."""
    bias, block = (points * points).sum(axis=1) + charge, max(1, _CELLS // len(points))
    return np.concatenate([(bias - 2 * x[at : at + block] @ points.T).argmin(axis=1) for at in range(0, len(x), block)])


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means whose assignment charges for crowded centroids; clusters over three shares are cut in two afterwards."""
    rng = np.random.default_rng(5)
    k = min(k, len(x))
    points = x[rng.choice(len(x), k, replace=False)].copy()
    share, charge = len(x) / k, np.zeros(k)
    for _ in range(rounds):
        mine = _assigned(x, points, charge)
        size = np.bincount(mine, minlength=k)
        spread = max(1e-12, float(np.var(x, axis=0).sum()))
        charge += 0.05 * spread * (size / share - 1)
        total = np.zeros_like(points)
        np.add.at(total, mine, x)
        points = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], points)
    mine = _assigned(x, points)
    more = []
    for c in np.flatnonzero(np.bincount(mine, minlength=k) > 3 * share):
        rows = x[mine == c]
        axis = rows[((rows - rows.mean(axis=0)) ** 2).sum(axis=1).argmax()] - rows.mean(axis=0)
        side = (rows - rows.mean(axis=0)) @ axis > 0
        if side.any() and not side.all():
            points[c] = rows[~side].mean(axis=0)
            more.append(rows[side].mean(axis=0))
    return np.concatenate([points, more]) if more else points


def _best(scores: np.ndarray, ids: list, k: int) -> list[tuple[float, int]]:
    """The k best (score, id) of entries with a list of ids each; equal scores by the smaller id, each id once."""
    some = np.flatnonzero(np.isfinite(scores))
    if len(some) > k:
        bar = np.partition(scores[some], len(some) - k)[len(some) - k]
        some = some[scores[some] >= bar]
    pairs = sorted({(-float(scores[i]), d) for i in some.tolist() for d in ids[i]})
    return [(-s, d) for s, d in pairs[:k]]


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of one query in an order of summation that does not depend on the batch."""
    return np.multiply(x, q).sum(axis=1)


def nearest(vectors: DataFrame, is_query: Column, k: int = K, sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row that satisfies ``is_query`` (on vec_id), itself excluded."""
    spark = vectors.sparkSession
    rows = usable(vectors).where("vec is not null and vec_id is not null").select("vec_id", "vec")
    rows = stored(rows.withColumn("key", F.unhex(F.md5("vec"))), "vectors")
    first = rows.withColumn("r", F.row_number().over(W.partitionBy("key").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    entries = stored(first.groupBy("key").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")

    def norms(batches):
        for batch in batches:
            x = matrix(batch["vec"])
            if len(x):
                most = np.abs(x).max(axis=1, keepdims=True)
                yield [len(x)], [float((np.log2(most[:, 0]) + np.log2(np.linalg.norm(x / most, axis=1))).max())]

    total, top = map_rows(entries.select("vec"), norms, "n long, norm double").agg(F.sum("n"), F.max("norm")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    wanted = int(min(MOST, max(1, DENSITY * total**0.5)))
    drawn = _first(entries.select("key", "vec"), max(sample, 4 * wanted))
    x = matrix([bytes(v) for v in drawn])
    whole = float(np.clip(np.floor(top), -1000, 1000))
    unit, norm = 2.0**whole, 2.0 ** (top - whole) * (1 + 1e-9)  # no vector is longer, whatever rounding did to the logarithm
    count = int(min(wanted, max(1, len(x) / 4)))
    centroids = Centroids(balanced_centroids(_lift(x / unit, norm), count), norm, unit)
    shared = spark.sparkContext.broadcast(centroids)  # at most 1.4 * MOST points

    def place(batches):
        c = shared.value
        for batch in batches:
            if not batch["key"]:
                continue
            yield batch["key"], batch["vec"], batch["ids"], c.lists(c.lift(matrix(batch["vec"])))

    placed = stored(map_rows(entries, place, "key binary, vec binary, ids array<long>, lists array<int>"), "placed")
    queries = rows.where(is_query)
    asked = stored(queries.groupBy("key").agg(F.first("vec").alias("vec")), "queries")
    # the ids whose nearest centroid it is, of each list: as many rows as centroids
    held = np.zeros(len(centroids.points), np.int64)
    for list_, n in placed.groupBy(F.col("lists")[0]).agg(F.sum(F.size("ids"))).collect():
        held[list_] = n
    reach = _measured_reach(placed, queries, shared, held, k, target)

    # lists are dealt to groups at random but for good; a group holds about GROUP entries
    copies = placed.agg(F.sum(F.size("lists"))).first()[0]
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # few groups, as each gives a row a query: as many as there are tasks, more only where a group would get large
    groups = max(1, min(len(centroids.points), max(-(-copies // GROUP), min(parts, -(-copies // LEAST_GROUP)))))
    salts = max(1, -(-asked.count() // ASKED))  # a group's queries are shared out, each share with the group's entries

    def probe(batches):
        c = shared.value
        for batch in batches:
            out = [[], [], [], []]
            for at in range(0, len(batch["key"]), c.batch):
                vecs = batch["vec"][at : at + c.batch]
                for i, row in enumerate(c.read(c.scale(matrix(vecs)), *reach)):
                    by: dict[int, list[int]] = {}
                    for list_ in np.flatnonzero(row).tolist():
                        by.setdefault(list_ % groups, []).append(list_)
                    for g, lists in by.items():
                        for column, value in zip(out, (g, batch["key"][at + i], vecs[i], lists), strict=True):
                            column.append(value)
            yield tuple(out)

    probes = map_rows(asked, probe, "group int, key binary, vec binary, lists array<int>")
    probes = probes.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).withColumn("ids", F.lit(None).cast("array<long>"))
    lists = placed.withColumn("list", F.explode("lists"))
    lists = lists.select(F.pmod("list", F.lit(groups)).cast("int").alias("group"), "key", "vec", "ids", F.array("list").alias("lists"))
    lists = lists.groupBy("group", "key").agg(F.first("vec").alias("vec"), F.first("ids").alias("ids"), F.flatten(F.collect_set("lists")).alias("lists"))
    lists = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    columns = ["group", "salt", "kind", "key", "vec", "ids", "lists"]
    both = lists.withColumn("kind", F.lit(0)).select(columns).unionByName(probes.withColumn("kind", F.lit(1)).select(columns))
    ordered = both.repartition(parts, "group", "salt").sortWithinPartitions("group", "salt", "kind")
    near = map_rows(ordered, _answers(k), "key binary, ids array<long>, scores array<double>")
    # a query's answers from its groups meet sorted by query; no row for each of them is made
    met = near.repartition(parts, "key").sortWithinPartitions("key")
    whole = stored(map_rows(met, _merged(k), "key binary, hits array<struct<s:double,vec_id:long>>"), "hits")
    joined = queries.select(F.col("vec_id").alias("query_id"), "key").distinct().join(whole, "key")
    mine = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    out = joined.select("query_id", F.posexplode(mine).alias("p", "h"))
    return out.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("h.vec_id").alias("vec_id"), (-F.col("h.s")).alias("score"))


def _first(keyed: DataFrame, n: int) -> list[bytes]:
    """The vectors of the ``n`` smallest keys."""
    bits = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")
    return lowest(keyed, bits, ["key"], n).select("vec").toArrow().column("vec").to_pylist()


def _answers(k: int):
    """Rows come sorted by (group, salt, kind): a group's entries, then the queries that probe its lists."""

    def run(batches):
        at, state = None, None

        def load(held):
            keys, vecs, ids, lists = held
            x = matrix(vecs)
            by: dict[int, list[int]] = {}
            for i, mine in enumerate(lists):
                for c in mine:
                    by.setdefault(c, []).append(i)
            return x, ids, {c: np.array(v) for c, v in by.items()}

        held = ([], [], [], [])
        for batch in batches:
            out = [[], [], []]
            asked = []
            for g, salt, kind, *row in zip(*(batch[c] for c in ("group", "salt", "kind", "key", "vec", "ids", "lists")), strict=True):
                if (g, salt) != at:
                    _ask(asked, state, k, out)
                    asked, at, state, held = [], (g, salt), None, ([], [], [], [])
                if kind == 0:
                    for column, value in zip(held, row, strict=True):
                        column.append(value)
                    continue
                if state is None:
                    state, held = load(held), ([], [], [], [])
                asked.append((row[0], row[1], row[3]))
                if len(asked) >= 128:
                    _ask(asked, state, k, out)
                    asked = []
            _ask(asked, state, k, out)
            yield tuple(out)

    return run


def _merged(k: int):
    """Rows come sorted by query: its k + 1 best of all groups, an entry of several lists once."""

    def run(batches):
        key, hits = None, set()

        def close():
            return [key], [[{"s": s, "vec_id": d} for s, d in sorted(hits)[: k + 1]]]

        for batch in batches:
            out = [[], []]
            for now, ids, scores in zip(batch["key"], batch["ids"], batch["scores"], strict=True):
                if now != key:
                    if key is not None:
                        for column, value in zip(out, close(), strict=True):
                            column.extend(value)
                    key, hits = now, set()
                hits.update((-s, d) for s, d in zip(scores, ids, strict=True))
            yield tuple(out)
        if key is not None:
            yield close()

    return run


def _ask(asked, state, k, out) -> None:
    if not asked:
        return
    x, ids, by = state
    if not len(x):
        return
    q = matrix([a[1] for a in asked])
    room = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
    scores = np.full((len(asked), len(x)), -np.inf)
    readers: dict[int, list[int]] = {}
    for i, (_, _, lists) in enumerate(asked):
        for c in lists:
            readers.setdefault(c, []).append(i)
    for c, rows in readers.items():
        if c in by:
            scores[np.ix_(rows, by[c])] = q[rows] @ x[by[c]].T
    for i, (key, _, _) in enumerate(asked):
        some = np.flatnonzero(np.isfinite(scores[i]))
        if len(some) > k + 1:  # rounding may tell equal products apart: leave a little room
            bar = np.partition(scores[i][some], len(some) - k - 1)[len(some) - k - 1]
            some = some[scores[i][some] >= bar - room[i]]
        best = _best(_exact(q[i], x[some]), [ids[j] for j in some.tolist()], k + 1)
        out[0].append(key)
        out[1].append([d for _, d in best])
        out[2].append([s for s, _ in best])


def _measured_reach(placed: DataFrame, queries: DataFrame, shared, held: np.ndarray, k: int, target: float) -> tuple:
    """Ratio, least number of nodes, usual distance (with held and k + 1, as ``Centroids.read`` takes them) at which the
    lists that PROBES query rows read hold ``target`` of their true neighbours."""
    hashed = F.xxhash64("vec_id", F.lit("probe"))
    drawn = lowest(queries.select("vec_id", "vec"), unsigned(hashed), [hashed, "vec_id"], PROBES).select("vec").collect()
    if not drawn:
        return 1.0, 8, 0.0, held, k + 1
    probes = matrix([bytes(r["vec"]) for r in drawn])
    sent = placed.sparkSession.sparkContext.broadcast(probes)

    def run(batches):
        q = sent.value
        best: list[list[tuple]] = [[] for _ in q]
        for batch in batches:
            if not batch["vec"]:
                continue
            x = matrix(batch["vec"])
            scores = q @ x.T
            for i in range(len(q)):
                bar = np.partition(scores[i], max(0, len(x) - k - 1))[max(0, len(x) - k - 1)]
                top = np.flatnonzero(scores[i] >= bar).tolist()
                best[i] += [(-float(scores[i, j]), batch["ids"][j][0], len(batch["ids"][j]), batch["lists"][j]) for j in top]
                best[i] = sorted(best[i])[: k + 1]
        flat = [(i, *b) for i, rows in enumerate(best) for b in rows]
        yield tuple([f[c] for f in flat] for c in range(5))

    true = map_rows(placed.select("vec", "ids", "lists"), run, "probe int, score double, first long, copies int, lists array<int>")
    true = true.withColumn("r", F.row_number().over(W.partitionBy("probe").orderBy("score", "first"))).where(F.col("r") <= k + 1)
    # the lists of each neighbour; copies of a vector count as often as they can be answers: PROBES * (k + 1) rows at most
    wanted: list[tuple[int, list[int]]] = []
    have: dict[int, int] = defaultdict(int)
    for row in sorted(true.select("probe", "r", "copies", "lists").collect()):
        more = min(row["copies"], k + 1 - have[row["probe"]])
        have[row["probe"]] += more
        wanted += [(row["probe"], row["lists"])] * more
    c = shared.value
    scaled = c.scale(probes)
    away = c.away(scaled)
    usual = float(np.median(away.min(axis=1)))
    near = np.maximum(away.min(axis=1), max(usual, 1e-300))
    needs = np.sort([away[i, lists].min() / near[i] for i, lists in wanted])
    ratio = float(max(1.0, needs[min(len(needs) - 1, int(np.ceil(target * len(needs))) - 1)]) * (1 + 1e-9))
    least = 8
    while least < len(c.points):
        read = np.concatenate([c.read(scaled[at : at + c.batch], ratio, least, usual, held, k + 1) for at in range(0, len(scaled), c.batch)])
        if sum(read[i, lists].any() for i, lists in wanted) >= target * len(wanted):
            break
        least *= 2  # the graph led past lists: up to all of them are looked at
    return ratio, least, usual, held, k + 1


def recall(found: DataFrame, vectors: DataFrame, is_query: Column, k: int = K, probes: int = PROBES) -> float:
    """Share of the true nearest ids of a bounded set of queries that ``found`` holds, by brute force over all rows."""
    rows = usable(vectors).where("vec is not null and vec_id is not null").select("vec_id", "vec")
    hashed = F.xxhash64("vec_id")
    drawn = lowest(rows.where(is_query), unsigned(hashed), [hashed, "vec_id"], probes).collect()
    if not drawn:
        return 1.0
    ids, q = [r["vec_id"] for r in drawn], matrix([bytes(r["vec"]) for r in drawn])

    def run(batches):
        for batch in batches:
            if not batch["vec"]:
                continue
            x = matrix(batch["vec"])
            out = [[], [], []]
            for i, own in enumerate(ids):
                scores = _exact(q[i], x)
                best = _best(scores, [[d] if d != own else [] for d in batch["vec_id"]], k + 1)
                out[0] += [own] * len(best)
                out[1] += [d for _, d in best]
                out[2] += [s for s, _ in best]
            yield tuple(out)

    true = map_rows(rows, run, "query_id long, vec_id long, score double").distinct()
    true = true.withColumn("r", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k)
    both = true.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left").agg(F.count("*"), F.count("hit")).first()
    return both[1] / both[0] if both[0] else 1.0


def op9(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
