"""Threshold pairs of embeddings by dual traversal of cover trees.

Unit vectors with a cosine of at least ``cosine`` lie within r = sqrt(2 - 2 * cosine) of each other. Equal vectors of a
label are one class first. A label's classes fall into cells around a bounded number of pivots; a cell pair whose
covering radii keep it further apart than r is dropped. Cells are cut into
blocks of at most ``BLOCK`` classes. Each block gets a cover tree: nested levels, where a level's centres cover
their points within half the radius of the level above and every centre is the first of its own children.

Pairs of blocks are traversed together from the roots: children pairs are compared centre to centre, and a pair goes
no further if its distance exceeds the two covering radii and r. What remains at the leaves is tested exactly. A task
gives a class its number of links and one edge to its part of the graph instead of all links, so groups of near
copies do not grow into their squares.

Blocks without structure cannot be pruned and cost a product of their sizes, in matrix products.

Edge cases: a null label or a vector without part links with nothing and keeps itself; repeated rows are copies of each
other; rows with a null id count as copies but get no component and are kept; vectors of one label must be equally
long; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.llm.common import components, map_rows, stored
from itinera.llm.vectors import matrix, usable

COSINE = 0.98
BLOCK = 2048
#: Most pivots of a label, and of all labels together.
PIVOTS, ALL_PIVOTS = 64, 4096
#: Node pairs with at most so many vector pairs are tested directly.
DIRECT = 16_384
_SLACK = 1e-9


def build_tree(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes): rows in tree order, and for each node [first row, end, radius, first child, children].

    Node 0 is the root; a node's centre is its first row, children are numbered in a row, and a single row has none.
    """
    nodes: list[list[float]] = []
    order = np.arange(len(unit))

    def far(rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * unit[rows] @ unit[rows[0]]))

    nodes.append([0, len(unit), 0.0, 0, 0])
    pending = [(0, None)]
    while pending:
        at, limit = pending.pop()
        lo, hi = int(nodes[at][0]), int(nodes[at][1])
        rows = order[lo:hi]
        distance = far(rows)
        radius = float(distance.max())
        nodes[at][2] = radius
        if hi - lo == 1:
            continue
        if radius == 0 or radius < 1e-7:  # equal to rounding: leaves of one centre
            parts = [np.array([r]) for r in rows]
        else:
            # halve the level's radius until the centre no longer covers all
            cover = radius / 2 if limit is None else min(limit, radius / 2)
            parts = _net(unit, rows, cover)
        nodes[at][3], nodes[at][4] = len(nodes), len(parts)
        start = lo
        for part in parts:
            order[start : start + len(part)] = part
            nodes.append([start, start + len(part), 0.0, 0, 0])
            if len(part) > 1:
                pending.append((len(nodes) - 1, cover / 2))
            start += len(part)
    return order, np.array(nodes)


def _net(unit: np.ndarray, rows: np.ndarray, cover: float) -> list[np.ndarray]:
    """Greedy centres among the rows, the first row first, and the rows that each covers."""
    close = unit[rows] @ unit[rows].T >= 1 - cover * cover / 2
    free = np.ones(len(rows), bool)
    parts = []
    for i in range(len(rows)):
        if free[i]:
            mine = close[i] & free
            mine[i] = False
            parts.append(np.r_[rows[i], rows[mine]])
            free &= ~mine
            free[i] = False
    return parts


def _children(nodes: np.ndarray, i: int) -> np.ndarray:
    first, n = int(nodes[i, 3]), int(nodes[i, 4])
    return np.arange(first, first + n) if n else np.array([i])


def dual_links(ua: np.ndarray, na: np.ndarray, ub: np.ndarray, nb: np.ndarray, same: bool, cosine: float = COSINE):
    """Row pairs of two trees with at least the cosine; with ``same`` both are one tree and each pair comes once."""
    r = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    stack = [(0, 0)]
    size_a, size_b = na[:, 1] - na[:, 0], nb[:, 1] - nb[:, 0]
    while stack:
        i, j = stack.pop()
        if size_a[i] * size_b[j] <= DIRECT or not (na[i, 4] or nb[j, 4]):
            a, b = np.arange(int(na[i, 0]), int(na[i, 1])), np.arange(int(nb[j, 0]), int(nb[j, 1]))
            x, y = np.nonzero(ua[a] @ ub[b].T >= cosine)
            x, y = a[x], b[y]
            if same and i == j:
                once = x < y
                x, y = x[once], y[once]
            if len(x):
                found.append((x, y))
            continue
        ca, cb = _children(na, i), _children(nb, j)
        x, y = na[ca, 0].astype(int), nb[cb, 0].astype(int)
        product = ua[x] @ ub[y].T
        reach = na[ca, 2][:, None] + nb[cb, 2] + r + _SLACK
        near = np.sqrt(np.maximum(0.0, 2 - 2 * product)) <= reach
        if same and i == j:
            near &= ca[:, None] <= cb
        single = (size_a[ca] == 1)[:, None] & (size_b[cb] == 1)
        p, q = np.nonzero(near & single & (product >= cosine))
        if same:
            other = x[p] != y[q]
            p, q = p[other], q[other]
        if len(p):
            found.append((x[p], y[q]))
        p, q = np.nonzero(near & ~single)
        stack.extend(zip(ca[p].tolist(), cb[q].tolist(), strict=True))
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _parts_of_graph(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node number reachable, of each of n nodes."""
    label = np.arange(n)
    while True:
        old = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (old == label).all():
            return label


def _unit(vecs: list[bytes]) -> np.ndarray:
    x = matrix(vecs)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _identity() -> Column:
    """128 bits of a row's label and vector."""
    return F.unhex(F.md5(F.concat(F.encode("label", "UTF-8"), F.unhex(F.lit("FF")), F.col("vec"))))


def links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, "label"), "vectors")
    live = rows.where("vec is not null and label is not null")
    # ids may be null: a class without any id still counts its rows
    classes = live.groupBy("label", "vec").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    # classes are numbered once, in the stored table; rows find theirs by 128 bits
    classes = classes.withColumn("class", F.monotonically_increasing_id()).withColumn("key", _identity())
    classes = stored(classes, "classes")
    sizes = classes.groupBy("label").agg(F.count("*").alias("m"))
    # pivots of the labels that need several cells, the largest labels first: at most ALL_PIVOTS rows
    large = sizes.where(F.col("m") > BLOCK).orderBy(F.desc("m"), "label").limit(ALL_PIVOTS // 4)
    wanted = large.withColumn("p", F.least(F.lit(PIVOTS), F.ceil(F.col("m") / BLOCK)).cast("int"))
    hashed = F.xxhash64("label", "vec")
    share = F.pmod(hashed, F.lit(1024)).cast("int")  # the window sorts shares of a label, not whole labels
    drawn = classes.join(F.broadcast(wanted), "label").withColumn("s", share).groupBy("label", "p", "s").agg(F.min_by("vec", hashed).alias("vec"))
    drawn = drawn.where("s < p * 16").orderBy("s", "label").limit(ALL_PIVOTS * 16)
    pivots: dict[str, list[bytes]] = {}
    for label, p, _, vec in drawn.select("label", "p", "s", "vec").toLocalIterator():
        have = pivots.setdefault(label, [])
        if len(have) < p and sum(map(len, pivots.values())) < ALL_PIVOTS:
            have.append(bytes(vec))
    shared = spark.sparkContext.broadcast(pivots)

    def place(batches):
        units = {label: _unit(vecs) for label, vecs in shared.value.items()}
        for batch in batches:
            cells, radii = [0] * len(batch["label"]), [2.0] * len(batch["label"])
            by: dict[str, list[int]] = {}
            for i, label in enumerate(batch["label"]):
                if label in units:
                    by.setdefault(label, []).append(i)
            for label, at in by.items():
                near = _unit([batch["vec"][i] for i in at]) @ units[label].T
                best = near.argmax(axis=1)
                for i, c, g in zip(at, best.tolist(), near[np.arange(len(at)), best].tolist(), strict=True):
                    cells[i], radii[i] = c, float(np.sqrt(max(0.0, 2 - 2 * g)))
            yield batch["label"], cells, radii, batch["class"], batch["n"], batch["vec"]

    placed = map_rows(classes.select("label", "class", "n", "vec"), place, "label string, cell int, away double, class long, n long, vec binary")
    cells = placed.groupBy("label", "cell").agg(F.count("*").alias("m"), F.max("away").alias("radius"))
    cells = stored(cells.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")), "cells")
    blocked = placed.join(cells.select("label", "cell", "blocks"), ["label", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    )

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        unit = _unit(list(group["vec"]))
        order, nodes = build_tree(unit)
        return pd.DataFrame(
            {
                "label": [group["label"].iloc[0]],
                "cell": [group["cell"].iloc[0]],
                "block": [group["block"].iloc[0]],
                "classes": [group["class"].to_numpy(np.int64)[order].tobytes()],
                "n": [group["n"].to_numpy(np.int64)[order].tobytes()],
                "unit": [np.ascontiguousarray(unit[order]).tobytes()],
                "nodes": [nodes.tobytes()],
            }
        )

    tree = "label string, cell int, block int, classes binary, n binary, unit binary, nodes binary"
    trees = stored(blocked.groupBy("label", "cell", "block").applyInPandas(grow, tree), "trees")

    # pairs of cells that their covering radii let meet, then of their blocks
    one = cells.select("label", F.col("cell").alias("ca"), F.col("radius").alias("ra"))
    two = cells.select("label", F.col("cell").alias("cb"), F.col("radius").alias("rb"))
    meet = one.join(two, "label").where("ca <= cb")
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))

    def apart(batches):
        units = {label: _unit(vecs) for label, vecs in shared.value.items()}
        for batch in batches:
            keep = []
            for i, (label, a, b, ra, rb) in enumerate(zip(*(batch[k] for k in ("label", "ca", "cb", "ra", "rb")), strict=True)):
                u = units.get(label)
                gap = 0.0 if u is None else float(np.sqrt(max(0.0, 2 - 2 * u[a] @ u[b])))
                if gap <= ra + rb + reach + _SLACK:
                    keep.append(i)
            yield tuple([batch[k][i] for i in keep] for k in ("label", "ca", "cb"))

    meet = map_rows(meet, apart, "label string, ca int, cb int")
    at = trees.select("label", "cell", "block")
    pairs = meet.join(at.select("label", F.col("cell").alias("ca"), F.col("block").alias("ba")), ["label", "ca"])
    pairs = pairs.join(at.select("label", F.col("cell").alias("cb"), F.col("block").alias("bb")), ["label", "cb"]).where("ca < cb or ba <= bb")
    left = trees.select("label", F.col("cell").alias("ca"), F.col("block").alias("ba"), F.struct("classes", "n", "unit", "nodes").alias("x"))
    right = trees.select("label", F.col("cell").alias("cb"), F.col("block").alias("bb"), F.struct("classes", "n", "unit", "nodes").alias("y"))
    both = pairs.join(left, ["label", "ca", "ba"]).join(right, ["label", "cb", "bb"])

    def traverse(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        x, y = group["x"].iloc[0], group["y"].iloc[0]
        same = key[1:3] == key[3:5]

        def load(t):
            ids, n = np.frombuffer(t["classes"], np.int64), np.frombuffer(t["n"], np.int64)
            return ids, n, np.frombuffer(t["unit"]).reshape(len(ids), -1), np.frombuffer(t["nodes"]).reshape(-1, 5)

        ids_a, n_a, unit_a, nodes_a = load(x)
        ids_b, n_b, unit_b, nodes_b = load(y)
        a, b = dual_links(unit_a, nodes_a, unit_b, nodes_b, same, cosine)
        shift = 0 if same else len(ids_a)
        ids, weight = (ids_a, n_a) if same else (np.r_[ids_a, ids_b], np.r_[n_a, n_b])
        b = b + shift
        count = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
        part = _parts_of_graph(len(ids), a, b)
        some = np.flatnonzero(count)
        return pd.DataFrame({"class": ids[some], "links": count[some].astype(np.int64), "peer": ids[part[some]]})

    keys = ["label", "ca", "ba", "cb", "bb"]
    linked = stored(both.groupBy(*keys).applyInPandas(traverse, "class long, links long, peer long"), "links")
    counts = linked.groupBy("class").agg(F.sum("links").alias("links"))
    graph = components(linked.select(F.col("class").alias("a"), F.col("peer").alias("b")))
    # a component is named by its smallest vec_id
    named = classes.select("class", "key", "n", "first").join(graph.select(F.col("node").alias("class"), "component"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    whole = named.join(least, "component").join(counts, "class", "left")
    whole = stored(whole.select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "classes")
    mine = rows.select("vec_id", F.when(F.col("vec").isNotNull() & F.col("label").isNotNull(), _identity()).alias("key"))
    out = mine.join(whole, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op1(spark, sf_dir: str) -> DataFrame:
    return links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
