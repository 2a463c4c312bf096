"""Periodic runs of words, found on a grammar of the text.

Re-Pair replaces pairs of neighbouring symbols that repeat within a document by nonterminals, most frequent pairs first.
Pairs of one round are those that no more frequent pair overlaps, so a round does at once what single steps would do one
after another. What no pair compresses any more is the document's last sequence.

Every maximal run lies in some nonterminal (or in the whole text) so that it crosses the boundary between its two parts
(or between two symbols of the last sequence). So each nonterminal is looked at once, at its first place in the text, for
runs across its boundary: of such a run, two periods or more lie left or right of the boundary and form a square that ends or
starts there. Squares are read off names of word strings of 1, 2, 4, ... words: a period q with L <= q < 2L makes the L
words at the boundary come again q words on. What is found moves to all places where the nonterminal was derived; pieces
that a nonterminal's edge cut are merged into the maximal interval, and of several periods of one interval the smallest counts.

Documents are handled in chunks of about ``CHUNK`` words as arrays; a longer document is a chunk of its own.

Edge cases: a null text has no words, and texts without words have no runs (four nulls, digests of nothing); a null id
counts as an empty decimal text; repeated rows each give a row; an empty table gives an empty result; very long texts are
read whole; among longest runs the smaller start, then the smaller period counts; other columns are not read.
"""

from __future__ import annotations

import zlib
from hashlib import sha256
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itinera.llm.common import map_rows

CHUNK = 300_000
#: A run has at least this many words and this many periods.
LEAST, PERIODS = 6, 4


def compress(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of every document (words from bounds[d] up to bounds[d + 1]; no word number is in two documents).

    Gives ``rules`` (first place: start, boundary, end), ``places`` (rule, start) of every derivation, ``cuts``, the
    boundaries within the last sequences, and their documents. Rules shorter than a run are left out: none fits in.
    """
    symbol, start = words.astype(np.int64), np.arange(len(words))
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = start + 1
    last = np.zeros(len(words), bool)
    last[bounds[1:][np.diff(bounds) > 0] - 1] = True
    live = ~last  # the pair that starts here may repeat
    fresh = int(symbol.max()) + 1 if len(symbol) else 0
    rules, places, cuts, cut_docs = [], [], [], []
    n_rules = 0

    def leave(mask):
        inner = start[mask] > bounds[doc[mask]]
        cuts.append(start[mask][inner])
        cut_docs.append(doc[mask][inner])

    while True:
        at = np.flatnonzero(live)
        if not len(at):
            break
        _, kind, total = np.unique(symbol[at] * fresh + symbol[at + 1], return_inverse=True, return_counts=True)
        # aaaa holds (a, a) at every place, but each a goes into one pair: every second place counts
        follows = np.zeros(len(at), bool)
        follows[1:] = (at[1:] == at[:-1] + 1) & (kind[1:] == kind[:-1])
        head = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
        odd = (np.arange(len(at)) - head) % 2 == 1
        total = total - np.bincount(kind[odd], minlength=len(total))
        repeated = total[kind] >= 2
        live[at[~repeated]] = False
        use = repeated & ~odd
        at, kind = at[use], kind[use]
        if not len(at):
            continue
        rank = np.empty(len(total), np.int64)
        rank[np.lexsort((np.arange(len(total)), -total))] = np.arange(len(total))
        # of two pairs that share a symbol the more frequent one goes first, and the other waits at all its places
        touch = np.flatnonzero(at[1:] == at[:-1] + 1)
        one, two = kind[touch], kind[touch + 1]
        waits = np.zeros(len(total), bool)
        waits[np.where(rank[one] > rank[two], one, two)] = True
        go = ~waits[kind]
        at, kind = at[go], kind[go]
        chosen, first, kind = np.unique(kind, return_index=True, return_inverse=True)
        stop = end[at + 1]
        long = stop - start[at] >= LEAST
        if long.any():
            number = np.cumsum(long[first]) - 1 + n_rules
            rules.append(np.stack([start[at[first]], start[at[first] + 1], stop[first]])[:, long[first]])
            places.append(np.stack([number[kind[long]], start[at[long]]]))
            n_rules += int(long[first].sum())
        symbol[at] = fresh + kind
        fresh += len(chosen)
        end[at] = stop
        last[at] = last[at + 1]
        live[at] = ~last[at]
        before = at[at > 0] - 1
        live[before] = ~last[before]
        stays = np.ones(len(symbol), bool)
        stays[at + 1] = False
        if 4 * np.count_nonzero(live) < len(live):  # documents that are done leave
            busy = np.zeros(len(bounds) - 1, bool)
            busy[doc[live & stays]] = True
            leave(stays & ~busy[doc])
            stays &= busy[doc]
        symbol, start, end, last, live, doc = (x[stays] for x in (symbol, start, end, last, live, doc))
    leave(np.ones(len(start), bool))
    join = lambda parts, empty: np.concatenate(parts, axis=-1) if parts else np.zeros(empty, np.int64)
    return join(rules, (3, 0)), join(places, (2, 0)), join(cuts, 0), join(cut_docs, 0)


def squares(words: np.ndarray, cut: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into ``cut``, period, start of a square) of all squares that end or start at a cut and lie in [low, high)."""
    name = words.astype(np.int64)
    seen = np.bincount(name) if len(name) else np.zeros(0, int)
    name[seen[name] < 2] = -1
    size, found = 1, []
    while True:
        at = np.flatnonzero(name >= 0)
        if not len(at):
            break
        order = at[np.argsort(name[at], kind="stable")]
        place = np.full(len(name), -1)
        place[order] = np.arange(len(order))
        # names that come again within half their length have a period p, and so has all they cover: every q on the way is
        # a multiple of p and not the smallest period, so the search starts behind the chain
        linked = (name[order[1:]] == name[order[:-1]]) & (2 * np.diff(order) <= size)
        numbers = np.arange(len(order))
        first = np.maximum.accumulate(np.where(np.r_[False, linked], 0, numbers))
        final = np.minimum.accumulate(np.where(np.r_[linked, False], len(order), numbers)[::-1])[::-1]
        # right of the cut (step 1): the names there come again q words on; left of it (step -1): q words before
        for step in (1, -1):
            probe = cut if step > 0 else cut - size
            fits = np.flatnonzero((cut + 2 * size <= high) if step > 0 else (cut - 2 * size >= low))
            fits = fits[name[probe[fits]] >= 0]
            here = probe[fits]
            to = (final if step > 0 else first)[place[here]] + step
            while len(fits):
                inside = (to >= 0) & (to < len(order))
                fits, here, to = fits[inside], here[inside], to[inside]
                other = order[to]
                q = (other - here) * step
                near = (name[other] == name[here]) & (q < 2 * size)
                fits, here, to, q = fits[near], here[near], to[near], q[near]
                c = cut[fits]
                a = c if step > 0 else c - 2 * q  # the square would be [a, a + 2q)
                whole = np.flatnonzero((q >= size) & (a >= low[fits]) & (a + 2 * q <= high[fits]))
                a, p = a[whole], q[whole]
                x, y = name[a], name[a + p - size]
                good = (x >= 0) & (x == name[a + p]) & (y >= 0) & (y == name[a + 2 * p - size])
                found.append(np.stack([fits[whole][good], p[good], a[good]]))
                to = to + step
        left, right = name[: max(0, len(name) - size)], name[size:]
        both = np.flatnonzero((left >= 0) & (right >= 0))
        _, kind, total = np.unique(left[both] * (int(name.max()) + 1) + right[both], return_inverse=True, return_counts=True)
        name = np.full(len(name), -1)
        name[both] = np.where(total[kind] > 1, kind, -1)
        size *= 2
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    return tuple(np.concatenate(found, axis=1))


def _reach(words: np.ndarray, a: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The interval with period q around the square [a, a + 2q), within [low, high)."""
    end, width = a + 2 * q, 16
    while end < high:
        part = words[end : min(high, end + width)]
        off = np.flatnonzero(part != words[end - q : end - q + len(part)])
        if len(off):
            end += int(off[0])
            break
        end, width = end + len(part), width * 2
    start, width = a, 16
    while start > low:
        part = words[max(low, start - width) : start]
        off = np.flatnonzero(part != words[start + q - len(part) : start + q])
        if len(off):
            start -= len(part) - 1 - int(off[-1])
            break
        start, width = start - len(part), width * 2
    return start, end


def find_runs(words: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each document its runs (start, end, period), by start and period, counted from its first word."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    rules, places, cuts, cut_docs = compress(words, bounds)
    n_rules = rules.shape[1]
    cut = np.concatenate([rules[1], cuts])
    low = np.concatenate([rules[0], bounds[cut_docs]])
    high = np.concatenate([rules[2], bounds[cut_docs + 1]])
    pieces: set[tuple[int, int, int]] = set()  # (period, start, end) anywhere in the chunk
    within: dict[int, set[tuple[int, int, int]]] = {}  # the same for rules, at their first place
    for i, q, a in zip(*(x.tolist() for x in squares(words, cut, low, high)), strict=True):
        start, end = _reach(words, a, q, int(low[i]), int(high[i]))
        if end - start >= max(LEAST, PERIODS * q):
            (within.setdefault(i, set()) if i < n_rules else pieces).add((q, start, end))
    if within:
        wanted = np.isin(places[0], list(within))
        for rule, at in zip(places[0][wanted].tolist(), places[1][wanted].tolist(), strict=True):
            shift = at - int(rules[0][rule])
            pieces.update((q, s + shift, e + shift) for q, s, e in within[rule])
    merged: dict[tuple[int, int], int] = {}
    held = None
    for q, s, e in [*sorted(pieces), (0, 0, 0)]:
        if held and held[0] == q and s + q <= held[2]:  # parts of one run share a period at least
            held = (q, held[1], max(e, held[2]))
            continue
        if held:
            key = held[1:]
            merged[key] = min(held[0], merged.get(key, held[0]))
        held = (q, s, e)
    for (s, e), q in merged.items():
        d = int(np.searchsorted(bounds, s, side="right")) - 1
        out[d].append((s - int(bounds[d]), e - int(bounds[d]), q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def with_copied_tail(words: list, doc_id) -> list:
    """The contract's planted period: of every tenth id the words from a certain one on repeat the first few of them."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def _digests(words: list, runs: list) -> tuple:
    """n_runs to collapsed_sha256 of one document."""
    if not runs:
        return 0, None, None, None, None, sha256().hexdigest(), sha256(b" ".join(words)).hexdigest()
    start, end, period = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]))
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = np.ones(len(words), bool)
    for s, e, q in runs:
        kept[s + q : e] = False
    rest = [words[i] for i in np.flatnonzero(kept).tolist()]
    length = end - start
    return len(runs), start, length, period, 1000 * length // period, sha256(listed.encode()).hexdigest(), sha256(b" ".join(rest)).hexdigest()


def _chunk(ids: list, texts: list[list]) -> list[tuple]:
    number = count()
    numbers: list[int] = []
    for words in texts:  # every document numbers its own words
        own: dict[bytes, int] = {}
        numbers += [own[w] if w in own else own.setdefault(w, next(number)) for w in words]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return [(i, *_digests(t, r)) for i, t, r in zip(ids, texts, find_runs(np.array(numbers, np.int64), bounds), strict=True)]


SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def collapse_runs(docs: DataFrame, prepare=None) -> DataFrame:
    """One row per document: its runs counted and digested, the longest one, and the digest of the text without copies of
    periods. Words are bytes between ASCII white space. ``prepare(words, doc_id)`` may change a document's words first."""

    def rows(batches):
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = bytes(text or b"").split()
                words = prepare(words, doc_id) if prepare else words
                if ids and size + len(words) > CHUNK:
                    yield tuple(map(list, zip(*_chunk(ids, texts), strict=True)))
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                size += len(words)
            if ids:
                yield tuple(map(list, zip(*_chunk(ids, texts), strict=True)))

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_rows(read, rows, SCHEMA)


def op12(spark, sf_dir: str) -> DataFrame:
    return collapse_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_copied_tail)
