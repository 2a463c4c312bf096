"""Steps of op6_suffix."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from itinera.llm import suffix


def test_equal_records_enter_the_suffix_array_once(monkeypatch):
    rng, made, build = random.Random(21), [], suffix.suffix_array
    monkeypatch.setattr(suffix, "suffix_array", lambda text: made.append(text) or build(text))
    head, ends = b"g" * suffix.GRAM, [bytes(rng.choices(b"abc", k=136)) for _ in range(3)]
    lefts = [bytes(rng.choices(b"xyz", k=40)) for _ in range(20)]
    contexts = [left + head + end for left in lefts for end in ends] + [lefts[0][1:] + head + ends[0]]
    left = np.array([len(c) - 200 for c in contexts])
    order = rng.sample(range(len(contexts)), len(contexts))
    repeated, own = suffix.equal_windows(np.ones(len(contexts), np.uint64), left[order], [contexts[i] for i in order], 200)
    windows = Counter(contexts[i][a : a + 200] for i in range(len(contexts)) for a in range(len(contexts[i]) - 199))
    for i, row in zip(order, repeated, strict=True):
        for d in range(int(left[i]) + 1):
            assert row[d] == (windows[contexts[i][left[i] - d :][:200]] > 1)
    assert sum(len(text) - 1 for text in made) == sum(len(e) + 2 for e in ends)  # before, each of the 61 occurrences had its own


def test_repeated_grams_across_batches():
    rng = random.Random(22)
    rows = sorted((rng.randrange(-20, 20), rng.choice([1, 1, 2]), block, 7) for block in range(30) for _ in range(3))
    rows = sorted(rows + [(block, 0, block, 7) for block in range(30)], key=lambda r: r[0])
    totals = Counter()
    for gram, n, _, _ in rows:
        totals[gram] += n
    expected = sorted((g, b, s, totals[g] if n else 0) for g, n, b, s in rows if not n or totals[g] > 1)
    for size in (1, 2, 7, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows[i : i + size]], pa.int64()) for c in range(4)], ["gram", "n", "block", "seal"]) for i in range(0, len(rows), size)]
        found = [tuple(int(x) for x in row) for out in suffix._repeated([batches[0].slice(0, 0), *batches]) for row in zip(*out, strict=True)]
        assert sorted(found) == expected
