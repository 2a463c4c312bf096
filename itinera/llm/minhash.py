"""Near-duplicates by b-bit MinHash.

A document's set is its distinct shingles of ``SIZE`` lower-cased words (A-Z only), each a 64-bit hash of its words; the
set as a whole is addressed by a 128-bit digest. Documents with equal sets form a class, and only one row of a class,
its smallest id, goes on, so groups of copies cost nothing however large they are.

Classes are numbered, and the numbers are the nodes of buckets, links and components, as an id may stand on rows of several
classes; a component is named by its smallest document id at the end.

For each class: ``BANDS * ROWS`` minima. Their bands give the candidate buckets; of every minimum only the low ``BITS``
bits are kept, packed into one signature. The share of equal low bits, corrected for chance collisions, estimates the
similarity; candidates that fall short by over five standard errors are dropped, all others are confirmed on full sets.

No bucket is expanded into its pairs. First every member meets only the bucket's smallest member, and the links found are
closed to connected components; for a group of near copies that is all, however large it is. Buckets whose members are
still in several components are cut into blocks, and a task holds two blocks. From the signatures it names the members
with a likely partner in another component; of these a second task holds the full sets and gives the links that join
components. Both return at most their members, never their pairs.

At 75 % similarity a pair misses all 24 bands of 3 rows with probability 2e-6.

Edge cases: documents without words (null, empty, white space) have an empty set, link with nothing and keep
themselves; fewer than ``SIZE`` words are one shingle; repeated rows with one id and one set are copies of each other, and
rows with one id and different sets link each for itself; rows with a null id take no part and keep component_id null and kept true; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itinera.llm.common import components, map_rows, stored, text_rows

SIZE = 5
PERCENT = 75
BANDS, ROWS = 24, 3
BITS = 4
#: Members of a bucket that one task compares with as many others.
BLOCK = 1_000
#: Words whose hash a worker remembers; results do not depend on it.
REMEMBER = 150_000
_CHARS = 1_000_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        got = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = got
        return got


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_sets(texts: list[str | None], known: _WordHash, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for text in texts:
        words = _words(text)
        if not words:
            out.append(np.zeros(0, np.uint64))
            continue
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        # fewer words than a shingle has: one shingle, told apart from full ones by its length
        n = min(size, len(words))
        with np.errstate(over="ignore"):
            mix = np.full(len(codes) - n + 1, n, np.uint64)
            for i in range(n):
                mix = _mixed(mix * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - n + 1 + i])
        out.append(np.unique(mix))
    return out


def _permutations(n: int) -> np.ndarray:
    return np.random.default_rng(11).integers(1, 2**63, (2, n), dtype=np.int64).astype(np.uint64) | np.uint64(1)


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, BANDS * ROWS) minima of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    factor, shift = _permutations(BANDS * ROWS)
    out = np.empty((BANDS * ROWS, len(sets)), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(BANDS * ROWS):
            x = flat * factor[k] + shift[k]
            x ^= x >> np.uint64(32)
            out[k] = np.minimum.reduceat(x * factor[k], starts)
    return out.T


def _pack(minima: np.ndarray) -> np.ndarray:
    """Low BITS bits of every minimum, packed to bytes."""
    low = _mixed(minima) & np.uint64((1 << BITS) - 1)
    bits = (low[:, :, None].astype(np.uint8) >> np.arange(BITS, dtype=np.uint8)) & 1
    return np.packbits(bits.reshape(len(minima), -1), axis=1)


def _profile(batches):
    known = _WordHash()
    for batch in batches:
        ids, texts, marks, at = batch["doc_id"], batch["text"], batch["text_key"], 0
        while at < len(ids):
            upto, chars = at, 0
            while upto < len(ids) and (upto == at or chars < _CHARS):
                chars += len(texts[upto] or "")
                upto += 1
            if len(known) > REMEMBER:
                known = _WordHash()
            sets = shingle_sets(texts[at:upto], known)
            full = [i for i, s in enumerate(sets) if len(s)]
            bands, packed = [None] * len(sets), [None] * len(sets)
            if full:
                minima = _minima([sets[i] for i in full])
                with np.errstate(over="ignore"):
                    packs = _pack(minima)
                    keys = minima.reshape(len(full), BANDS, ROWS)
                    key = np.tile(np.arange(BANDS, dtype=np.uint64), (len(full), 1))
                    for r in range(ROWS):
                        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + keys[:, :, r])
                key = key.view(np.int64)
                for k, i in enumerate(full):
                    bands[i], packed[i] = key[k], packs[k].tobytes()
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield ids[at:upto], marks[at:upto], [len(s) for s in sets], digests, bands, packed
            at = upto


def profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, bands, packed) of every document; bands and packed are null for empty sets."""
    rows = text_rows(docs).withColumn("text_key", F.xxhash64("text"))
    return map_rows(rows, _profile, "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>, packed binary")


def estimate(a: bytes, b: bytes) -> float:
    """Similarity from two packed signatures: the share of equal BITS-bit minima, corrected for chance collisions."""
    return float(_estimates(np.frombuffer(a, np.uint8)[None], np.frombuffer(b, np.uint8)[None])[0])


def _estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = BANDS * ROWS
    bits = np.unpackbits(a ^ b, axis=1)[:, : n * BITS].reshape(len(a), n, BITS)
    equal = 1 - bits.any(axis=2).sum(axis=1) / n
    chance = 0.5**BITS
    return (equal - chance) / (1 - chance)


def _least_estimate() -> float:
    share, chance = PERCENT / 100, 0.5**BITS
    equal = share + (1 - share) * chance
    return share - 5 * (equal * (1 - equal) / (BANDS * ROWS)) ** 0.5 / (1 - chance)


def _likely(pa: list[bytes], pb: list[bytes]) -> np.ndarray:
    if not len(pa):
        return np.zeros(0, bool)
    a = np.frombuffer(b"".join(pa), np.uint8).reshape(len(pa), -1)
    b = np.frombuffer(b"".join(pb), np.uint8).reshape(len(pb), -1)
    return _estimates(a, b) >= _least_estimate()


def _near(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes allow the similarity and whose signatures do not speak against it."""
    one = marks.select(F.col("node").alias("a"), F.col("packed").alias("pa"), F.col("n_shingles").alias("na"))
    two = marks.select(F.col("node").alias("b"), F.col("packed").alias("pb"), F.col("n_shingles").alias("nb"))
    both = pairs.join(one, "a").join(two, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT)

    def run(batches):
        for batch in batches:
            keep = np.flatnonzero(_likely(batch["pa"], batch["pb"]))
            yield [batch["a"][i] for i in keep], [batch["b"][i] for i in keep]

    return map_rows(both.select("a", "b", "pa", "pb"), run, "a long, b long")


_GROUP = ("bucket", "x", "y")
_MEMBER = ("block", "node", "cell")


def _grouped(batches, columns):
    """Rows of each (bucket, x, y), which arrive one after another; None after each batch."""
    group, rows = None, []
    for batch in batches:
        for *key, row in zip(*(batch[k] for k in _GROUP), zip(*(batch[k] for k in columns), strict=True), strict=True):
            if key != group:
                if rows:
                    yield group, rows
                group, rows = key, []
            rows.append(row)
        yield None, None
    if rows:
        yield group, rows
    yield None, None


def _partners(x: int, y: int, block: np.ndarray, cells: np.ndarray, sizes: np.ndarray):
    """For each member of block x the members of block y of other cells whose sizes allow the similarity, each pair once."""
    for i in np.flatnonzero(block == x).tolist():
        other = (block == y) & (cells != cells[i]) & (np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * PERCENT)
        if x == y:
            other[: i + 1] = False
        js = np.flatnonzero(other)
        if len(js):
            yield i, js


def _likely_members(batches):
    """Of each pair of blocks the members that have a likely partner in another cell, from signatures alone."""
    out = [[] for _ in range(6)]
    for group, rows in _grouped(batches, (*_MEMBER, "n_shingles", "packed")):
        if group is None:
            yield tuple(out)
            out = [[] for _ in range(6)]
            continue
        if len({r[2] for r in rows}) < 2:
            continue
        block, _, cells, sizes = (np.array([r[k] for r in rows], np.int64) for k in range(4))
        packed = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(len(rows), -1)
        hit = np.zeros(len(rows), bool)
        for i, js in _partners(group[1], group[2], block, cells, sizes):
            near = js[_estimates(packed[js], packed[i][None]) >= _least_estimate()]
            if len(near):
                hit[i] = True
                hit[near] = True
        for i in np.flatnonzero(hit).tolist():
            for column, value in zip(out, (*group, *rows[i][:3]), strict=True):
                column.append(value)


def _links_of_blocks(batches):
    """Links between the cells of a pair of blocks, confirmed on full sets. Cells that are joined already need no more, so
    there are fewer links than cells."""
    known = _WordHash()
    out = [[], []]
    for group, rows in _grouped(batches, (*_MEMBER, "text")):
        if group is None:
            yield tuple(out)
            out = [[], []]
            if len(known) > REMEMBER:
                known = _WordHash()
            continue
        sets = shingle_sets([r[3] for r in rows], known)
        block, ids, cells = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        sizes = np.array([len(s) for s in sets], np.int64)
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        mark = np.zeros(codes.max() + 1, np.int64)
        root = cells.copy()
        for i, js in _partners(group[1], group[2], block, cells, sizes):
            js = js[root[js] != root[i]]
            if not len(js):
                continue
            mine = codes[starts[i] : starts[i] + sizes[i]]
            mark[mine] = 1
            ends = np.cumsum(sizes[js])
            flat = np.arange(ends[-1]) + np.repeat(starts[js] - (ends - sizes[js]), sizes[js])
            both = np.add.reduceat(mark[codes[flat]], ends - sizes[js])
            mark[mine] = 0
            for j in js[100 * both >= PERCENT * (sizes[i] + sizes[js] - both)].tolist():
                if root[i] != root[j]:
                    out[0].append(int(min(ids[i], ids[j])))
                    out[1].append(int(max(ids[i], ids[j])))
                    root[root == root[j]] = root[i]


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs with 100 * intersection >= PERCENT * union on full sets. A pair meets its first text, then its second."""
    one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches):
        known = _WordHash()
        for batch in batches:
            a, b, keep = batch["a"], batch["b"], []
            held: dict[tuple, np.ndarray] = {}

            def sets_of(doc, text, held=held):
                if (doc, text) not in held:
                    if len(held) > 500:
                        held.clear()
                    held[doc, text] = shingle_sets([text], known)[0]
                return held[doc, text]

            if len(known) > REMEMBER:
                known = _WordHash()
            for i in range(len(a)):
                x, y = sets_of(a[i], batch["ta"][i]), sets_of(b[i], batch["tb"][i])
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield [x for x, k in zip(a, keep, strict=True) if k], [x for x, k in zip(b, keep, strict=True) if k]

    return map_rows(two.select("a", "b", "ta", "tb"), run, "a long, b long")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the wanted (node, doc_id, set_key). Where an id stands on several rows, a row with that set counts."""
    rows = text_rows(docs).join(wanted, "doc_id")

    def run(batches):
        known, last = _WordHash(), None
        for batch in batches:
            keep = []
            if len(known) > REMEMBER:
                known = _WordHash()
            for i, (node, text, key) in enumerate(zip(batch["node"], batch["text"], batch["set_key"], strict=True)):
                if node != last and hashlib.blake2b(shingle_sets([text], known)[0].tobytes(), digest_size=16).digest() == key:
                    keep.append(i)
                    last = node
            yield [batch["node"][i] for i in keep], [batch["text"][i] for i in keep]

    return map_rows(rows.select("node", "text", "set_key").sortWithinPartitions("node"), run, "node long, text string")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key) of every document; text_key is xxhash64 of its text."""
    known = stored(profiles(docs), "minhash")
    named = known.where("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("first"))
    leaders = named.join(classes, "set_key").where("doc_id = first").dropDuplicates(["set_key"])
    # the number of a class is fixed as it is written, and no result depends on it
    leaders = leaders.select(F.monotonically_increasing_id().alias("node"), "doc_id", "n_shingles", "set_key", "bands", "packed")
    leaders = stored(leaders, "leaders")
    marks = leaders.select("node", "n_shingles", "packed")

    members = leaders.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1")
    members = stored(members.join(shared, "bucket"), "buckets")
    # the texts of all that may become candidates, read once
    wanted = members.select("node").distinct().join(leaders.select("node", "doc_id", "set_key"), "node")
    texts = stored(_texts(docs, wanted), "texts")
    pairs = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(_confirm(_near(pairs, marks), texts), "links")
    tree = components(links)
    cells = members.join(tree, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("cell"))
    several = cells.groupBy("bucket").agg(F.min("cell").alias("low"), F.max("cell").alias("high")).where("low <> high").select("bucket")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    cut = cells.join(several, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.select("bucket", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "node", "cell")
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def side_by_side(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, *_GROUP).sortWithinPartitions(*_GROUP)

    kinds = "bucket long, x int, y int, block int, node long, cell long"
    likely = stored(map_rows(side_by_side(met.join(marks, "node")), _likely_members, kinds), "likely")
    across = map_rows(side_by_side(likely.join(texts, "node")), _links_of_blocks, "a long, b long").distinct()
    links = stored(links.unionByName(across), "links")
    tree = components(links)

    joined = tree.join(leaders.select("node", "doc_id", "set_key"), "node")
    least = joined.groupBy("component").agg(F.min("doc_id").alias("least"))
    named_by = joined.join(least, "component").select("set_key", "least")
    heads = classes.join(named_by, "set_key", "left").select("set_key", F.coalesce("least", "first").alias("component"))
    every = known.select("doc_id", "text_key", "n_shingles", "set_key").join(heads, "set_key", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return every.select("doc_id", "n_shingles", own.alias("component_id"), "text_key").select("doc_id", "n_shingles", "component_id", kept, "text_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows, all columns, of one document of each group; of rows that repeat id and text one stays, null ids all."""
    lost = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")).distinct()
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__id"), F.xxhash64(F.col("text").cast("string")).alias("__text"))
    left = rows.join(lost, ["__id", "__text"], "left_anti")
    copy = F.row_number().over(W.partitionBy("__id", "__text").orderBy(F.lit(1)))
    # rows without an id share no key: they stay as they are
    one = left.where("__id is not null").withColumn("__copy", copy).where("__copy = 1").select("__row")
    return one.unionByName(left.where("__id is null").select("__row")).select("__row.*")


def op4(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_key")
