"""Near-duplicates, repeated bytes, vectors and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from itinera.llm import covertree, minhash, postings, suffix
from itinera.llm.common import SLICE, components, lowest, map_rows, unsigned


def _vocabulary(rng, n=400):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def _documents(seed=1):
    """Texts with copies, near copies, shared passages, a hot text, short, empty, null and long ones."""
    rng = random.Random(seed)
    words = _vocabulary(rng)
    say = lambda n: [rng.choice(words) for _ in range(n)]
    passage = say(70)
    texts: list[str | None] = [None, "", " \n", "one", "One", "a b c d", "A b  c d", "a b c d e", "é" * 300, "x" * 700, " ".join(say(5_000))]
    for _ in range(12):
        base = say(rng.randint(20, 120))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    texts += [" ".join(say(30) + passage + say(rng.randint(1, 60))) for _ in range(15)]
    texts += [" ".join(passage[:60])] * 20
    texts += [" ".join(say(2) + passage[:20]) for _ in range(10)]
    rng.shuffle(texts)
    return texts


def _frame(spark, texts):
    rows = [(i, t, "k", 1, b"x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, bucket string, share int, text_key binary")


def _near_brute(texts):
    def shingles(t):
        words = (t or "").encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("block", [3, 1_000])
def test_near_duplicates_are_the_brute_ones(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = _documents()
    found = minhash.near_duplicates(_frame(spark, texts)).collect()
    expected = _near_brute(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_edges(spark):
    schema = "doc_id long, text string, extra int"
    rows = [(None, "a b c", 1), (None, "a b c", 1), (3, "a b c", 1), (3, "a b c", 1), (3, "other words here", 2), (9, "A B C", 1), (10, None, 1)]
    df = spark.createDataFrame(rows, schema)
    found = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert found == {(None, None, True): 2, (3, 3, True): 3, (9, 3, False): 1, (10, 10, True): 1}
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == {(None, "a b c"): 2, (3, "a b c"): 1, (3, "other words here"): 1, (10, None): 1}
    assert minhash.near_duplicates(df.limit(0)).collect() == [] and minhash.keep_one(df.limit(0)).collect() == []


def test_near_duplicates_of_an_id_with_two_texts(spark):
    def text(k, last):
        return " ".join([f"{k}{i}" for i in range(60)] + [last])

    rows = [(3, text("a", "x")), (5, text("a", "y")), (3, text("b", "x")), (7, text("b", "y"))]
    rows += [(20, text("c", "x")), (10, text("c", "y")), (20, text("d", "x")), (30, text("d", "y")), (40, text("e", "x"))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [
        (3, 3, True), (3, 3, True), (5, 3, False), (7, 3, False), (10, 10, True), (20, 10, False), (20, 20, True), (30, 20, False), (40, 40, True)
    ]


def test_estimate_is_near_the_similarity():
    known = minhash._WordHash()
    a, b = minhash.shingle_sets([" ".join(map(str, range(1000))), " ".join(map(str, range(150, 1150)))], known)
    pack = minhash._pack(minhash._minima([a, b]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(minhash.estimate(pack[0].tobytes(), pack[1].tobytes()) - true) < 0.2
    assert minhash.estimate(pack[0].tobytes(), pack[0].tobytes()) == 1


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(500, 500)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_suffix_array_is_the_sorted_one():
    rng = random.Random(3)
    for _ in range(1_500):
        text = [rng.randint(1, rng.randint(1, 5)) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def _repeats_brute(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    starts = Counter(b[j : j + length] for b in raw for j in range(len(b) - length + 1))
    out = []
    for b in raw:
        mark = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if starts[b[j : j + length]] > 1:
                mark[j : j + length] = True
        runs = int((np.diff(np.r_[0, mark.astype(int)]) == 1).sum())
        rest = bytes(np.frombuffer(b, np.uint8)[~mark]) if b else b""
        out.append((len(b), int(mark.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize(("block", "limit"), [(6_000_000, 20_000), (2_000, 20_000), (2_000, 3)])
def test_repeated_bytes_are_the_brute_ones(spark, tmp_path, monkeypatch, block, limit):
    monkeypatch.setattr(suffix, "BLOCK", block)
    monkeypatch.setattr(suffix, "LIMIT", limit)
    texts = _documents(5) + ["é" * 99 + "tail" * 60 + "\x00" * 250, "head " + "é" * 100 + "x"]
    _frame(spark, texts).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = suffix.op6(spark, str(tmp_path)).collect()
    expected = _repeats_brute(texts)
    assert {r.doc_id: tuple(r)[1:] for r in found} == dict(enumerate(expected))


def test_contexts_are_ordered_by_suffix_arrays_of_their_bytes(monkeypatch):
    rng, made, build = random.Random(13), [], suffix.suffix_array
    monkeypatch.setattr(suffix, "suffix_array", lambda text: made.append(text) or build(text))
    monkeypatch.setattr(suffix, "SYMBOLS", 400)
    n = 300
    gram = np.array([rng.choice([3, 5, 2**63, rng.randrange(2**64)]) for _ in range(n)], np.uint64)
    rest = [bytes(rng.choice([0, 1, 255]) for _ in range(rng.choice([0, 1, 4, 136]))) for _ in range(n)]
    right = np.frombuffer(b"".join((b"g" * suffix.GRAM + r).ljust(200, b"\0") for r in rest), np.uint8).reshape(n, 200)
    order = suffix._right_order(gram, right, np.array([suffix.GRAM + len(r) for r in rest]))
    assert sorted(order.tolist()) == list(range(n))
    by = defaultdict(list)
    for i in order.tolist():
        by[int(gram[i])].append(i)
    assert sum(int(gram[a]) != int(gram[b]) for a, b in zip(order, order[1:], strict=False)) == len(by) - 1
    for mine in by.values():
        assert [rest[i] for i in mine] == sorted(rest[i] for i in mine)
    counts = Counter(gram.tolist())
    expected = sum(len(r) + 2 for r, g in zip(rest, gram.tolist(), strict=True) if counts[g] > 1)
    assert sum(len(text) - 1 for text in made) == expected  # every byte behind a gram is a symbol


def test_windows_behind_contexts_that_end_early():
    head, after = b"g" * suffix.GRAM, b"t" * 86
    ends = [after + bytes(50), after + bytes(20), after + bytes(50)]
    for order in itertools.permutations(range(3)):
        repeated, own = suffix.equal_windows(np.ones(3, np.uint64), np.zeros(3, np.int64), [head + ends[i] for i in order], 200)
        assert repeated[:, 0].tolist() == own[:, 0].tolist() == [i != 1 for i in order]


def test_repeats_of_texts_with_nul_bytes(spark):
    rng, texts = random.Random(12), []
    for order in [*itertools.permutations(range(3))] * 4:
        t = "".join(rng.choice("abcdefgh") for _ in range(150))
        three = [t + "\x00" * 200 + "a", "b" * 100 + t + "\x00" * 20, t + "\x00" * 200 + "c"]
        texts += [three[i] for i in order]
    rows = spark.sparkContext.parallelize(list(enumerate(texts)), len(texts) // 2)  # so blocks do not hold equal contexts
    found = suffix.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in found} == {i: e[3] for i, e in enumerate(_repeats_brute(texts))}


@pytest.mark.parametrize("parts", [2, 4, 6, 8])
def test_hot_gram_is_split_over_blocks_of_many_tasks(parts):
    text = "".join(random.Random(14).choice("abcdefgh") for _ in range(200)).encode()
    found = suffix._Grams([text], 200)
    gram = int(found.hash[found.occurrences()[0][0]].view(np.int64))
    shares = Counter()
    for task in range(64):  # each with one small block
        rows = pd.DataFrame({"block": [task << 32], "seal": [1], "row": [0], "n": [1], "text": [zlib.compress(text)]})
        grams = pd.DataFrame({"gram": [gram], "block": [task << 32], "seal": [1], "total": [suffix.LIMIT * parts]})
        shares.update(suffix._contexts(200, 1000)(rows, grams)["share"].tolist())
    assert len(shares) == parts and max(shares.values()) <= 2 * 64 / parts


def test_drop_repeats_keeps_rows(spark):
    texts = [*_documents(6), None]
    df = _frame(spark, texts).unionByName(spark.createDataFrame([(None, "y" * 10, "k", 1, b"x"), (0, "z", "k", 1, b"x")], _frame(spark, ["a"]).schema))
    out = suffix.drop_repeats(df)
    assert out.columns == df.columns and out.count() == df.count()
    gone = {i: e[1] for i, e in enumerate(_repeats_brute(texts))}
    for r in out.where("doc_id > 0").collect():
        if not gone[r.doc_id]:
            assert r.text == texts[r.doc_id]
        elif texts[r.doc_id].isascii():
            assert len(r.text) == len(texts[r.doc_id]) - gone[r.doc_id]
    assert suffix.drop_repeats(df.limit(0)).collect() == []


def _vectors(seed=1, n=300, dims=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dims)) * rng.choice([0.02, 0.1, 1.0], n)[:, None]
    x = (x * rng.choice([0.5, 1.0, 3.0], n)[:, None]).astype(np.float32)
    x[::17] = x[5]
    rows = [(i, v.tolist(), None if i % 23 == 0 else int(rng.integers(0, 3)), "x") for i, v in enumerate(x)]
    rows += [(n, None, 1, "x"), (n + 1, [0.0] * dims, 1, "x"), (n + 2, [float("nan")] * dims, 1, "x"), (n + 3, [1.0, None] * (dims // 2), 1, "x"), (n + 5, [float("inf")] * dims, 1, "x")]
    return rows, "vec_id long, embedding array<float>, label int, class string"


def _usable(rows):
    return [r for r in rows if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]


@pytest.mark.parametrize(("block", "direct"), [(2048, 16_384), (10, 4)])
def test_links_are_the_brute_ones(spark, monkeypatch, block, direct):
    monkeypatch.setattr(covertree, "BLOCK", block)
    monkeypatch.setattr(covertree, "DIRECT", direct)
    rows, schema = _vectors()
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.links(spark.createDataFrame(rows, schema)).collect()}
    good = [r for r in _usable(rows) if r[2] is not None]
    x = np.array([r[1] for r in good], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.98) & (np.array([r[2] for r in good])[:, None] == np.array([r[2] for r in good]))
    np.fill_diagonal(near, False)
    ids = np.array([r[0] for r in good])
    least = ids.copy()
    while True:
        new = np.array([min([least[i], *least[np.flatnonzero(near[i])]]) for i in range(len(ids))])
        if (new == least).all():
            break
        least = new
    expected = {r[0]: (0, r[0], True) for r in rows}
    expected |= {int(i): (int(near[k].sum()), int(least[k]), int(least[k]) == int(i)) for k, i in enumerate(ids)}
    assert near.any() and found == expected


def test_links_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (4, [1.0, 0.0], 2)], schema)
    assert Counter(tuple(r) for r in covertree.links(df).collect()) == {(1, 2, 1, True): 2, (None, 2, None, True): 1, (4, 0, 4, True): 1}
    assert covertree.links(df.limit(0)).collect() == []


def test_tree_covers_and_nests():
    rows, _ = _vectors(4)
    unit = covertree._unit([np.array(r[1], "<f8").tobytes() for r in _usable(rows)])
    order, nodes = covertree.build_tree(unit)
    unit = unit[order]
    assert sorted(order.tolist()) == list(range(len(unit)))
    for lo, hi, radius, first, n in nodes:
        lo, hi, first, n = int(lo), int(hi), int(first), int(n)
        far = np.sqrt(np.maximum(0, 2 - 2 * unit[lo:hi] @ unit[lo])).max()
        assert far <= radius + 1e-7
        if n:
            kids = nodes[first : first + n]
            assert int(kids[0][0]) == lo and int(kids[-1][1]) == hi and (kids[:, 2] <= radius / 2 + 1e-6).all()


def test_nearest_finds_the_brute_ones(spark):
    rows, schema = _vectors(2, n=600)
    df = spark.createDataFrame([*rows, rows[40]], schema)
    found = postings.nearest(df, F.col("vec_id") % 20 == 0, k=20)
    assert postings.recall(found, df, F.col("vec_id") % 20 == 0) >= 0.9
    by = defaultdict(list)
    for r in found.collect():
        by[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = _usable(rows)
    x, ids = np.array([r[1] for r in good], np.float64), np.array([r[0] for r in good])
    assert set(by) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, got in by.items():
        got.sort()
        scores = dict(zip(ids.tolist(), x @ x[ids == q][0], strict=True))
        assert [g[0] for g in got] == list(range(1, 21)) and q not in {g[1] for g in got}
        assert all(np.isclose(g[2], scores[g[1]], rtol=1e-12) for g in got)
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        true = sorted((-round(s, 9), i) for i, s in scores.items() if i != q)[:20]
        hits += len({i for _, i in true} & {g[1] for g in got})
    assert hits / (20 * len(by)) >= 0.9


def test_wide_batches_come_in_slices_and_words_are_forgotten(spark, monkeypatch):
    texts = [f"{i} " + "x" * 100_000 for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    sizes = map_rows(df, lambda batches: (([sum(map(len, b["text"]))],) for b in batches), "chars long").collect()
    assert sum(r.chars for r in sizes) == sum(map(len, texts)) and max(r.chars for r in sizes) <= 2 * SLICE
    most = []

    class Counted(minhash._WordHash):
        def __missing__(self, word):
            got = super().__missing__(word)
            most.append(len(self))
            return got

    monkeypatch.setattr(minhash, "REMEMBER", 50)
    monkeypatch.setattr(minhash, "_WordHash", Counted)
    monkeypatch.setattr(minhash, "map_rows", lambda df, run, schema: run)
    wanted = spark.createDataFrame([(1, 1, b"")], "node long, doc_id long, set_key binary")
    run = minhash._texts(df, wanted)
    for _ in run({"node": [i], "text": [f"a{i} b{i} c{i}"], "set_key": [b""]} for i in range(100)):
        pass
    assert most and max(most) <= 60


def test_sample_is_the_first_by_hash_whatever_its_size(spark):
    rows = spark.range(3_000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))  # a third of one key
    hashed = F.xxhash64("k")
    for n in (1, 10, 900, 5_000):
        found = [r.id for r in lowest(rows, unsigned(hashed), [hashed, "id"], n).collect()]
        assert found == [r.id for r in rows.orderBy(hashed, "id").limit(n).collect()]
    assert lowest(rows.limit(0), unsigned(hashed), [hashed, "id"], 5).collect() == []
    keyed = rows.select("id", F.unhex(F.md5(F.col("id").cast("string"))).alias("key"), F.col("id").cast("string").cast("binary").alias("vec"))
    assert postings._first(keyed, 50) == [bytes(r.vec) for r in keyed.orderBy("key").limit(50).collect()]


def test_centroids_assigned_in_blocks_are_the_nearest(monkeypatch):
    rng = np.random.default_rng(4)
    x, points, charge = rng.normal(size=(500, 6)), rng.normal(size=(40, 6)), rng.random(40)
    expected = (((x[:, None] - points) ** 2).sum(axis=2) + charge).argmin(axis=1)
    for cells in (1, 1000, 1 << 22):
        monkeypatch.setattr(postings, "_CELLS", cells)
        assert (postings._assigned(x, points, charge) == expected).all()


def test_nearest_in_small_batches(spark, monkeypatch):
    rows, schema = _vectors(3, n=300)
    df = spark.createDataFrame(rows, schema)
    ask = F.col("vec_id") % 20 == 0
    whole = sorted(map(tuple, postings.nearest(df, ask).collect()))
    monkeypatch.setattr(postings, "_CELLS", 64)
    assert sorted(map(tuple, postings.nearest(df, ask).collect())) == whole


def _recall(spark, x):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    ask = F.col("vec_id") % 20 == 0
    return postings.recall(postings.nearest(df, ask), df, ask)


def test_nearest_of_queries_that_stand_apart(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 32)) * 0.01 + 5 * rng.normal(size=(30, 32))[rng.integers(0, 30, 3000)]
    apart = rng.normal(size=(150, 32))
    x[::20] = 8 * apart / np.linalg.norm(apart, axis=1, keepdims=True)  # many have a centroid to themselves
    assert _recall(spark, x) >= 0.97


def test_nearest_of_vectors_whose_squares_underflow(spark):
    assert _recall(spark, 1e-170 * np.random.default_rng(7).normal(size=(400, 8))) >= 0.9  # lengths were 0


def test_nearest_edges(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [0.5, 0.1]), (None, [9.0, 9.0])], schema)
    got = sorted(tuple(r)[:3] for r in postings.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 3), (0, 2, 20), (0, 3, 5), (20, 1, 0), (20, 2, 3), (20, 3, 5)]
    assert postings.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert postings.nearest(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).collect() == []


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    secret = "password = hunter2hunter2"
    extra = spark.createDataFrame([(10**6, f"keep this text with {secret} in it", "en", "s", 30), (10**6 + 1, None, None, None, None)], docs.schema)
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "secrets", "packing"]
    rows = docs.unionByName(extra).cache()
    before = {r.doc_id: r.text for r in rows.collect()}
    near = stages["near_duplicates"](spark, rows, folder)
    assert near.columns == columns
    ids, texts = sorted(before), [before[i] for i in sorted(before)]
    expected = {ids[i] for i, (_, c) in _near_brute(texts).items() if c == i}
    assert {r.doc_id for r in near.collect()} == expected
    cut = stages["repeats"](spark, rows, folder)
    gone = dict(zip(ids, _repeats_brute(texts), strict=True))
    for r in cut.collect():
        if not gone[r.doc_id][1]:
            assert r.text == before[r.doc_id]
        if r.text is not None:
            assert r.n_chars == len(r.text)
    masked = {r.doc_id: r.text for r in stages["secrets"](spark, rows, folder).collect()}
    assert masked[10**6] == "keep this text with [REDACTED] in it" and set(masked) == set(ids)
    clean = stages["toxicity"](spark, rows, folder)
    assert clean.columns == columns and 0 < clean.count() <= len(ids)
    packed = corpus_pipeline.run(spark, folder)
    assert packed.count() > 0 and {"doc_id", "sequence_id", "ids"} <= set(packed.columns)
    none = rows.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0, name
