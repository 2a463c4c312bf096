"""Periodic runs, pivots and packages against brute force, the standard library's reader and SQL."""

from __future__ import annotations

import glob
import hashlib
import io
import random
import zipfile
import zlib

import numpy as np
import pytest

from itinera.llm import ptolemy, runs, webarchive
from itinera.session import scratch_path


# --- runs of words ---------------------------------------------------------------------------------------------------


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, copied):
    words = [w for w in (text or "").encode().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split()]
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if copied and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    longest = min(((s, e - s, q) for s, e, q in found), key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()
    rest = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *four, hashlib.sha256(listed).hexdigest(), hashlib.sha256(rest).hexdigest())


def periodic_texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(0, 5)):
            k = rng.choice([1, 2, 3, 6, 40])
            unit = [f"w{rng.randrange(k)}é" for _ in range(rng.randrange(1, 9))]
            words += [f"w{rng.randrange(k)}" for _ in range(rng.randrange(0, 8))] + (unit * 14)[: rng.randrange(1, 80)]
        words *= rng.choice([1, 1, 1, 5])
        yield rng.choice([" ", "\n", " \t", "\x0b", " "]).join(words)


ODD = [None, "", " \n", "a", "a a a a a", "a a a a a a", "a b a b a b", "a b a b a b a b", "a a a a a a a a", "a a a a a a b " * 4, "x" * 50_000]


@pytest.mark.parametrize("chunk", [40, 300_000])
def test_runs_are_the_brute_ones(spark, monkeypatch, chunk):
    monkeypatch.setattr(runs, "CHUNK", chunk)
    texts = ODD + list(periodic_texts(chunk, 250))
    rows = [(i, t, "n", 1) for i, t in enumerate(texts)] + [(None, "z z z z z z z", "n", 2), (7, texts[7], "n", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, n_runs int")
    for copied in (True, False):
        found = runs.collapse_runs(docs, runs.with_copied_tail if copied else None).collect()
        expected = [brute_row(i, t, copied) for i, t, *_ in rows]
        assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_long_texts_of_few_words_have_few_steps():
    for words, run in ((["a"] * 60_000, (0, 60_000, 1)), (["a", "b"] * 40_000, (0, 80_000, 2)), ((["a"] * 300 + ["b"]) * 100, (0, 30_100, 301))):
        numbers = np.unique(words, return_inverse=True)[1]
        found = runs.find_runs(numbers, np.array([0, len(words)]))[0]
        assert max(found, key=lambda r: r[1] - r[0]) == run


def test_grammar_derives_the_text_and_no_pair_comes_twice():
    rng = random.Random(3)
    words = np.array([rng.randrange(4) for _ in range(3_000)])
    rules, places, cuts, _ = runs.compress(words, np.array([0, len(words)]))
    for start, boundary, end in rules.T.tolist():
        assert start < boundary < end and end - start >= runs.LEAST
    for rule, at in places.T.tolist():
        start, _, end = rules[:, rule]
        assert (words[at : at + end - start] == words[start:end]).all()
    parts = [tuple(words[a:b]) for a, b in zip([0, *sorted(cuts)], [*sorted(cuts), len(words)], strict=True)]
    pairs = [(a, b) for a, b in zip(parts, parts[1:], strict=False) if a != b]
    assert len(pairs) == len(set(pairs))


def test_runs_of_nothing(spark):
    assert runs.collapse_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# --- pivots ----------------------------------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, dims=64):
    kept = [(i, [int(np.floor(256 * np.float64(c))) for c in v]) for i, v in rows if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    hashed = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), np.array(x, "<i4").tobytes(), x) for i, x in kept if i is not None)
    centroids = [x for _, _, x in hashed[:k]]
    away = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    nearest = lambda: [min((away(x, c), j) for j, c in enumerate(centroids)) for _, x in kept]
    for _ in range(rounds):
        mine = nearest()
        for j in range(len(centroids)):
            members = [x for (_, x), (_, c) in zip(kept, mine, strict=True) if c == j]
            if members:
                centroids[j] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    last = nearest()
    own = {j: sum(d for d, c in last if c == j) for _, j in last}
    return sorted(((i, c, d, own[c], sum(own.values()), centroids[c]) for (i, _), (d, c) in zip(kept, last, strict=True)), key=str)


@pytest.mark.parametrize("spread", [0.02, 1.0, 30_000.0])
def test_clusters_are_the_plain_ones(spark, spread):
    rng = np.random.default_rng(int(spread * 100))
    middles = rng.normal(size=(6, 64))
    rows = [(i, (middles[i % 6] + spread * rng.normal(size=64)).tolist()) for i in range(120)]
    rows += [(200, None), (201, [1.0] * 63), (202, [1.0] * 65), (203, [None] + [1.0] * 63), (204, [float("nan")] + [0.0] * 63), (205, [float("inf")] * 64), (206, [])]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (207, [0.0] * 64), (208, [0.0] * 64), (209, [-0.0] * 64)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cluster int, x int")
    for k, rounds in ((9, 3), (1, 1), (500, 1)):
        found = sorted((tuple(r) for r in ptolemy.cluster_vectors(frame, k, rounds).collect()), key=str)
        assert found == plain_clusters(rows, k, rounds)


def test_bounds_stay_below_and_prune():
    rng = np.random.default_rng(4)
    middles = rng.integers(-4_000, 4_000, (20, 64))
    x = (middles[rng.integers(0, 20, 2_000)] + rng.integers(-40, 40, (2_000, 64))).astype(np.int64)
    bounds = ptolemy.Bounds(middles, 8)
    below = bounds.below(bounds.distances(x), middles)
    true = np.sqrt(np.stack([ptolemy.squared(x, c) for c in middles], axis=1))
    assert (below <= true).all()
    cluster, near, measured = ptolemy.assign(x, bounds.distances(x), middles, bounds)
    assert (cluster == true.argmin(axis=1)).all() and measured < 5 * len(x)


def test_no_vectors_and_too_large_ones(spark):
    schema = "vec_id long, embedding array<double>"
    assert ptolemy.cluster_vectors(spark.createDataFrame([], schema)).collect() == []
    with pytest.raises(Exception, match="too large"):
        ptolemy.cluster_vectors(spark.createDataFrame([(1, [1e300] * 64)], schema)).collect()


# --- packages --------------------------------------------------------------------------------------------------------


def page_rows():
    rng = random.Random(9)
    rows = [(i, f"http://h{i}.example/ä b?\n{i}", "<p>" + "é~" * rng.randrange(0, 3_000)) for i in range(60)]
    rows += [(100 + i, None, "same") for i in range(50)] + [(5, "u", "same"), (5, "u", "same"), (None, "u", "same"), (None, "", "alone")]
    rows += [(200, "u", None), (201, "u", ""), (202, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (203, "u", "PK\x05\x06" + "\x00" * 40), (204, "u", "x" * 200_000)]
    return rows


def expected_pages(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(html or "") if len(data) >= least else None
        again = to is not None and to != i
        out.append((i, len(data), webarchive.payload_digest(data), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("member,least,parts", [(8 << 20, 0, 1), (2_000, 5, 3)])
def test_packages_return_what_was_written(spark, monkeypatch, member, least, parts):
    monkeypatch.setattr(webarchive, "MEMBER", member)
    monkeypatch.setattr(webarchive, "RANGE", 3_000)
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "k", True) for r in rows], "page_id long, url string, html string, key string, revisit boolean")
    folder = scratch_path(spark, "packages")
    webarchive.write_packages(pages.repartition(parts), folder, least)
    found = webarchive.read_packages(spark, folder)
    assert sorted((tuple(r) for r in found.drop("url", "payload").collect()), key=str) == expected_pages(rows, least)
    texts = {(r.page_id, bytes(r.payload).decode()) for r in found.where("record_type = 'response'").collect()}
    assert texts <= {(i, html or "") for i, _, html in rows} and {t for _, t in texts} == {html or "" for _, _, html in rows}
    for path in glob.glob(folder.removeprefix("file:") + "/part-*"):
        with zipfile.ZipFile(path) as package:  # another reader agrees
            assert package.testzip() is None
            mine = webarchive.central_directory(webarchive.Ranges(path))
            assert {i.filename: (i.compress_type, i.file_size, i.header_offset, i.CRC) for i in package.infolist()} == mine


def test_packages_by_other_writers():
    records = [webarchive.warc_record(i, "http://a/", b"p%d" % i * 9_000) for i in range(4)]
    for zipped in (True, False):
        file = io.BytesIO(b"stub before the archive")
        with zipfile.ZipFile(file, "a", zipfile.ZIP_STORED) as package:
            data = b"".join(zlib.compress(r, wbits=31) if zipped else r for r in records)
            package.writestr("archive/ü.warc" + ".gz" * zipped, data)
            package.writestr("archive/notes.txt", "no records")
            package.comment = b"with PK\x05\x06 in its comment"
        ranges = webarchive.Ranges("", file.getvalue())
        lists = list(webarchive.record_ranges(ranges))
        payloads = [r["payload"] for part in lists for r in webarchive.read_records(ranges, part)]
        assert payloads == [b"p%d" % i * 9_000 for i in range(4)]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("archive/a.warc", records[0])
    with pytest.raises(ValueError, match="compressed"):
        list(webarchive.record_ranges(webarchive.Ranges("", packed.getvalue())))
    with pytest.raises(ValueError, match="central directory"):
        webarchive.central_directory(webarchive.Ranges("", b"no archive" * 9))


def test_packages_that_only_spark_opens(spark, monkeypatch):
    monkeypatch.setattr(webarchive.Ranges, "opens", staticmethod(lambda path: False))
    rows = page_rows()
    folder = scratch_path(spark, "packages")
    webarchive.write_packages(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    found = webarchive.read_packages(spark, folder, payloads=False).drop("url")
    assert sorted(map(tuple, found.collect()), key=str) == expected_pages(rows)


def test_broken_payloads_are_noticed(spark):
    folder = scratch_path(spark, "packages")
    webarchive.write_packages(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert webarchive.read_packages(spark, folder).collect() == []
    record = webarchive.parse_record(webarchive.warc_record(1, "u", b"abc"))
    record["payload"] = b"abd"
    with pytest.raises(ValueError, match="digest"):
        webarchive._facts(record)
