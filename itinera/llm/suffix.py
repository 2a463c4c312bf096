"""Removal of repeated byte strings, through suffix arrays that are built by grouping.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else as well. A suffix array of all texts in
one place would find these strings; here it is cut into pieces that workers can build independently:

1. Every window of ``length`` bytes names one 64-byte gram in it, the one of least hash. Equal windows name equal grams
   at equal offsets, so only windows around equal grams need to meet. A task cuts its rows into blocks, skips copies
   within a block and sends each distinct gram of a block once; grams of one occurrence in all are done with.
2. The blocks meet their repeated grams again and send, for each occurrence, the bytes around it that its windows cover
   (not the texts). Copies of such a context within a block are told there.
3. The contexts of a share make strings, some grams each, one record an occurrence: the gram, the bytes behind it and an
   end. Their suffix arrays are built by grouping suffixes by their Lyndon prefixes and emitting each group's order
   (``suffix_array``). Neighbours in it share the longest run of bytes behind the gram; together with the bytes before
   the gram this tells which windows are equal.
   Contexts that are equal in several blocks enter once, and so do records that are equal behind one gram.
4. A gram with more than ``LIMIT`` occurrences is split over several shares. Windows that stay single in a share are
   then compared by a digest of their bytes across its shares, so that nothing is lost by the split.
5. The intervals of a text, which is addressed by its SHA-256, are merged and joined to all rows with this text.

Blocks are cut twice from the same rows; a checksum fails the job if their order differed.

Edge cases: a null text is empty; texts shorter than ``length`` lose nothing; rows with equal texts of at least
``length`` bytes lose all of it, and so do repeated rows; ids are not looked at, so null or repeated ids change nothing;
other columns are kept by ``drop_repeats`` and not read by ``op6``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.llm.common import map_rows, squeeze, stored, unsqueeze
from itinera.llm.words import places

LENGTH = 200
GRAM = 64
#: Bytes of a block and of the texts that are hashed at a time.
BLOCK, PART = 6_000_000, 1_000_000
#: Contexts of a share on average, and the most occurrences of a gram in one share.
SHARE, LIMIT = 20_000, 20_000
#: Symbols of a suffix array, about; more only where one gram's contexts are.
SYMBOLS = 300_000
#: Negative share numbers over which blocks spread the intervals that they know already.
SURE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(2**64 - 1)


# ---- the suffix array ------------------------------------------------------------------------------------------------


def suffix_array(text: list[int]) -> list[int]:
    """Positions of all suffixes in order, in linear time. The last symbol must be the only least one.

    First suffixes are grouped by their Lyndon prefixes: groups are taken in descending order, and the previous smaller
    positions that their members point to are split off their own groups, those with more pointers further up. Then the
    order is emitted from the least suffix on: whatever points to an emitted suffix is next in its group.
    """
    n = len(text)
    _, symbol, many = np.unique(text, return_inverse=True, return_counts=True)
    positions, ends = np.argsort(symbol, kind="stable").tolist(), np.cumsum(many).tolist()
    members = [positions[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    group = symbol.tolist()
    count = len(members)
    below = list(range(-1, count - 1))  # the next lower group
    above = [*range(1, count), -1]
    done = [False] * count
    order = []  # groups from the highest
    prev = [-1] * n
    g = count - 1
    while g != -1:
        mine = [i for i in members[g] if group[i] == g]
        members[g] = mine
        done[g] = True
        order.append(g)
        found = []
        for i in mine:
            p = i - 1
            while p >= 0 and done[group[p]]:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                found.append(p)
        if found:
            if len(found) == 1 or len(set(found)) == len(found):
                levels = [found]
            else:
                pointers = Counter(found)
                most = max(pointers.values())
                levels = [[] for _ in range(most)]
                for p, k in pointers.items():
                    levels[most - k].append(p)
            for level in levels:
                split: dict[int, int] = {}
                for p in level:
                    old = group[p]
                    new = split.get(old)
                    if new is None:
                        new = split[old] = len(members)
                        members.append([])
                        done.append(False)
                        up = above[old]
                        above.append(up)
                        below.append(old)
                        above[old] = new
                        if up != -1:
                            below[up] = new
                    members[new].append(p)
                    group[p] = new
        g = below[g]
    start = [0] * len(members)
    at = 0
    for g in reversed(order):
        start[g] = at
        at += len(members[g])
    out = [-1] * n
    out[0] = n - 1
    placed = [False] * n
    placed[n - 1] = True
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not placed[j]:
            placed[j] = True
            s = start[group[j]]
            out[s] = j
            start[group[j]] = s + 1
            j = prev[j]
    return out


# ---- grams that windows name -----------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of every ``width`` neighbours, by doubling; shorter by width - 1."""
    n, step = len(x) - width + 1, 1
    while step * 2 <= width:
        x = best(x[:-step], x[step:])
        step *= 2
    return best(x[:n], x[width - step : width - step + n]) if step < width else x[:n]


class _Grams:
    """Of texts laid end to end: the hash of the gram at each position and the grams that their windows name."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        self.reach = length - GRAM + 1  # grams in a window
        self.joined = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        n = len(self.joined)
        self.hash = self.least = np.zeros(0, np.uint64)
        self.named = np.zeros(0, np.int64)
        if n < length:
            return
        with np.errstate(over="ignore"):
            x, step, factor = self.joined.astype(np.uint64) + np.uint64(1), 1, _BASE
            while step < GRAM:
                x = x[:-step] * factor + x[step:]
                factor *= factor
                step *= 2
            x = _mixed(x)
        x[x == 0] = 1
        least = _sliding(x, self.reach, np.minimum)
        valid = np.ones(n + 1, bool)  # windows that end within their text
        for e in ends.tolist():
            valid[max(0, e - length + 1) : e] = False
        least[~valid[: len(least)]] = 0
        pad = np.zeros(self.reach - 1, np.uint64)
        self.hash, self.least = x, least
        # a gram is named if the greatest of the minima of the windows that hold it is its own hash
        self.named = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), self.reach, np.maximum) == x)

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position of the gram, first and last start of the windows that name it), leftmost gram on ties."""
        starts = np.flatnonzero(self.least)
        if not len(starts):
            return (np.zeros(0, np.int64),) * 3
        named = np.zeros(len(self.hash), np.int32)
        named[self.named] = 1
        index = (np.cumsum(named, dtype=np.int32) - named)[starts]  # of the first gram in the window
        values, wanted = self.hash[self.named], self.least[starts]
        open_ = np.flatnonzero(values[index] != wanted)
        while len(open_):
            index[open_] += 1
            open_ = open_[values[index[open_]] != wanted[open_]]
        at = self.named[index]
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
        last = np.r_[first[1:], len(starts)] - 1
        return at[first], starts[first], starts[last]


def _parts(texts: list[bytes]):
    """Ranges of texts of about PART bytes."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= PART):
            size += len(texts[upto])
            upto += 1
        yield at, upto
        at = upto


def _key(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()[:16]


def _key_of(column: str) -> Column:
    text = F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _blocks(batches):
    """(block, seal, distinct texts, rows of each) of a task's rows, in their order."""
    task, serial = TaskContext.get().partitionId(), 0
    seen: dict[bytes, int] = {}
    texts, size = [], 0

    def close():
        seal = 0
        for k, n in seen.items():
            seal = zlib.crc32(k + n.to_bytes(8, "little"), seal)
        return (task << 32) + serial, seal, texts, list(seen.items())

    for batch in batches:
        for text in batch["text"]:
            raw = (text or "").encode("utf-8", "surrogatepass")
            k = _key(raw)
            if k in seen:
                seen[k] += 1
                continue
            seen[k] = 1
            texts.append(raw)
            size += len(raw) + 64
            if size >= BLOCK:
                yield close()
                serial += 1
                seen, texts, size = {}, [], 0
    if seen:
        yield close()


def _gram_rows(length: int):
    """Each distinct gram of a block with its number of occurrences, and a row with number 0 for the block itself."""

    def run(batches):
        for block, seal, texts, _ in _blocks(batches):
            found = [np.zeros(0, np.uint64)]
            for a, b in _parts(texts):
                grams = _Grams(texts[a:b], length)
                found.append(grams.hash[grams.named])
            grams, n = np.unique(np.concatenate(found), return_counts=True)
            yield np.append(grams.view(np.int64), block), np.append(n, 0), np.full(len(grams) + 1, block), np.full(len(grams) + 1, seal)

    return run


def _repeated(batches):
    """Rows come sorted by gram; those of grams with more than one occurrence go back to their blocks with the total."""

    def solve(gram, n, block, seal):
        first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        total = np.repeat(np.add.reduceat(n, first), np.diff(np.r_[first, len(gram)]))
        total[n == 0] = 0
        keep = (n == 0) | (total > 1)
        return gram[keep], block[keep], seal[keep], total[keep]

    rest = [np.zeros(0, np.int64)] * 4
    for batch in batches:
        rows = [np.concatenate([old, batch.column(c).to_numpy()]) for old, c in zip(rest, ("gram", "n", "block", "seal"), strict=True)]
        if not len(rows[0]):
            continue
        edge = int(np.searchsorted(rows[0], rows[0][-1]))  # the last gram may go on in the next batch
        rest = [x[edge:] for x in rows]
        if edge:
            yield solve(*(x[:edge] for x in rows))
    if len(rest[0]):
        yield solve(*rest)


def _text_rows(batches):
    for block, seal, texts, rows in _blocks(batches):
        yield [block] * len(texts), [seal] * len(texts), list(range(len(texts))), [n for _, n in rows], [zlib.compress(t, 1) for t in texts]


def _contexts(length: int, shares: int):
    """Of a block: intervals known already (kind 0) and contexts of repeated grams, packed by share (kind 1)."""

    def run(rows: pd.DataFrame, grams: pd.DataFrame) -> pd.DataFrame:
        out = {k: [] for k in ("share", "keys", "froms", "tos", "packed")}
        if len(rows) == 0 or set(rows["seal"]) != set(grams["seal"]):
            raise RuntimeError("the input gave its rows in another order when it was read again")
        rows = rows.sort_values("row")
        block = int(rows["block"].iloc[0])
        texts = [zlib.decompress(t) for t in rows["text"]]
        keys = [_key(t) for t in texts]
        sure = [(k, 0, len(t)) for k, t, n in zip(keys, texts, rows["n"], strict=True) if n > 1 and len(t) >= length]
        grams = grams[grams["total"] > 0]
        known = grams["gram"].to_numpy(np.int64).view(np.uint64)
        split = np.maximum(1, -(-grams["total"].to_numpy(np.int64) // LIMIT))
        by = np.argsort(known)
        known, split = known[by], split[by]
        seen: dict[bytes, list] = {}
        for a, b in _parts(texts) if len(known) else ():
            found = _Grams(texts[a:b], length)
            at, first, last = found.occurrences()
            value = found.hash[at]
            place = np.minimum(np.searchsorted(known, value), len(known) - 1)
            hit = np.flatnonzero(known[place] == value)
            begins = np.cumsum([0] + [len(t) for t in texts[a:b]])
            owner = np.searchsorted(begins, at[hit], side="right") - 1
            whole = found.joined.tobytes()
            for i, o in zip(hit.tolist(), owner.tolist(), strict=True):
                lo, hi, p = int(first[i]), int(last[i]), int(at[i])
                ctx = whole[lo : hi + length]
                start = lo - int(begins[o])
                item = seen.setdefault((int(value[i]), p - lo, ctx), [int(split[place[i]]), 0])
                item[1] += 1
                item.append((keys[a + o], start))
        packed, mixed = defaultdict(list), zlib.crc32(block.to_bytes(8, "little"))  # neither tasks nor serials count evenly
        for (gram, left, ctx), (parts, n, *places) in seen.items():
            if n > 1:  # all of these windows are repeated within the block
                sure.extend((k, s, s + len(ctx)) for k, s in places)
            share = (gram * 0x9E3779B97F4A7C15 % 2**64 + mixed % parts * 0x632BE59BD9B4E019) % 2**64 * shares >> 64
            packed[share].append((gram, left, parts, n, *places[0], ctx))
        if sure:
            out["share"].append(-1 - mixed % SURE)
            out["keys"].append([k for k, _, _ in sure])
            out["froms"].append([a for _, a, _ in sure])
            out["tos"].append([b for _, _, b in sure])
            out["packed"].append(None)
        for share, items in packed.items():
            out["share"].append(share)
            out["keys"].append([x[4] for x in items])
            out["froms"].append([x[5] for x in items])
            out["tos"].append([])
            numbers = np.array([(x[0], x[1], x[2], x[3], len(x[6])) for x in items], np.uint64)
            out["packed"].append(squeeze(numbers.T.tobytes() + b"".join(x[6] for x in items), 1))
        return pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in out.items()})  # also without rows

    return run


# ---- equal windows of a share ----------------------------------------------------------------------------------------


def _right_order(gram: np.ndarray, right: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Occurrences in the order of (gram, bytes from the gram on), from suffix arrays of their records.

    A record is the gram's symbol, the bytes behind the gram, as many as the context has (``behind`` counts from the gram
    on), and an end below all bytes. Whole grams go together, about SYMBOLS symbols at a time; one alone is in order.
    """
    by = np.argsort(gram, kind="stable")
    first = np.flatnonzero(np.r_[True, gram[by][1:] != gram[by][:-1]])
    sizes = behind[by] - GRAM + 2
    upto = np.cumsum(sizes)
    out, at = [], 0
    edges = [*first[1:].tolist(), len(by)]
    for k, edge in enumerate(edges):
        if k + 1 < len(edges) and upto[edges[k + 1] - 1] - (upto[at - 1] if at else 0) <= SYMBOLS:
            continue
        mine = by[at:edge]
        at = edge
        _, g, n = np.unique(gram[mine], return_inverse=True, return_counts=True)
        out.append(mine[n[g] == 1])
        mine, g = mine[n[g] > 1], g[n[g] > 1]
        if not len(mine):
            continue
        end = behind[mine, None] - GRAM + 1
        column = np.arange(right.shape[1] - GRAM + 2)
        symbols = np.zeros((len(mine), len(column)), np.int64)
        symbols[:, 0] = g + 258
        symbols[:, 1:-1] = right[mine, GRAM:].astype(np.int64) + 2
        symbols[column == end] = 1
        flat = symbols[column <= end]
        record = np.full(len(flat) + 1, -1)
        record[np.r_[0, np.cumsum(end.ravel() + 1)[:-1]]] = np.arange(len(mine))
        order = record[suffix_array([*flat.tolist(), 0])]
        out.append(mine[order[order >= 0]])
    return np.concatenate(out) if out else by


def equal_windows(gram: np.ndarray, left: np.ndarray, contexts: list[bytes], length: int):
    """(occurrences, length - GRAM + 1) booleans: whether the window that starts that many bytes before the gram is
    one of the occurrence's own and equal to another occurrence's; and, alike, whether it is one of its own at all."""
    m, reach = len(contexts), length - GRAM + 1
    sizes = np.array([len(c) for c in contexts])
    behind = sizes - left
    flat = np.frombuffer(b"".join(contexts) + bytes(2 * length), np.uint8)
    begin = np.cumsum(sizes) - sizes
    right = flat[(begin + left)[:, None] + np.arange(length)]
    right = np.where(np.arange(length) < behind[:, None], right, 0).astype(np.uint8)
    # equal records stand side by side, so that one of them is enough
    distinct: dict[tuple, int] = {}
    record = np.fromiter((distinct.setdefault((g, n, r.tobytes()), len(distinct)) for g, n, r in zip(gram.tolist(), behind.tolist(), right, strict=True)), np.int64, m)
    by = np.argsort(record, kind="stable")
    ends = np.cumsum(np.bincount(record, minlength=len(distinct)))
    first = np.r_[0, ends[:-1]][: len(ends)]
    kept = by[first]
    order = _right_order(gram[kept], right[kept], behind[kept])
    order = by[places(first[order], (ends - first)[order])]
    sorted_right = right[order]
    differ = sorted_right[1:] != sorted_right[:-1]
    same = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    same = np.minimum(same, np.minimum(behind[order][1:], behind[order][:-1]))
    same[gram[order][1:] != gram[order][:-1]] = 0
    # a window that starts d bytes before the gram has length - d bytes from it on
    own = (np.arange(reach) <= left[:, None]) & (length - np.arange(reach) <= behind[:, None])
    repeated = np.zeros((m, reach), bool)
    before = np.zeros(m, np.uint64)
    pos = begin + left
    with np.errstate(over="ignore"):
        for d in range(reach):
            if d:
                deep = d <= left
                byte = flat[np.where(deep, pos - d, 0)].astype(np.uint64)
                before = np.where(deep, _mixed(before * _BASE + byte + np.uint64(1)), before)
            joined = same >= length - d
            run = np.r_[0, np.cumsum(~joined)]
            near = np.r_[False, joined] | np.r_[joined, False]
            live = np.flatnonzero(near & own[order, d])
            if len(live) < 2:
                continue
            who = order[live]
            key = _mixed(before[who] + _mixed((run[live].astype(np.uint64) + np.uint64(1)) * _BASE))
            by = np.argsort(key, kind="stable")
            k = key[by]
            twin = k[1:] == k[:-1]
            hit = np.r_[False, twin] | np.r_[twin, False]
            repeated[who[by[hit]], d] = True
    return repeated, own


def _resolve(length: int):
    """Shares come sorted; each is put together and solved. Rows: intervals, or windows that other shares may hold too."""

    def solve(rows):
        keys, starts, numbers, contexts = [], [], [], []
        for row_keys, row_starts, packed in rows:
            raw = unsqueeze(packed)
            part = np.frombuffer(raw[: len(row_keys) * 40], np.uint64).reshape(5, -1)
            at = len(row_keys) * 40
            for n in part[4].tolist():
                contexts.append(raw[at : at + n])
                at += n
            keys += row_keys
            starts += row_starts
            numbers.append(part)
        numbers = np.concatenate(numbers, axis=1)
        gram, left, parts = numbers[0], numbers[1].astype(np.int64), numbers[2]
        start = np.array(starts, np.int64)
        # equal contexts of several blocks go into the array once; all windows of theirs are repeated
        distinct: dict[tuple, int] = {}
        member = np.array([distinct.setdefault(x, len(distinct)) for x in zip(gram.tolist(), left.tolist(), contexts, strict=True)])
        first = np.unique(member, return_index=True)[1]
        some, own = equal_windows(gram[first], left[first], [contexts[i] for i in first.tolist()], length)
        several = np.bincount(member) > 1
        some[several] = own[several]
        repeated, own = some[member], own[member]
        out = [[], [], [], []]
        some = np.flatnonzero(repeated.any(axis=1))
        nearest = repeated[some].argmax(axis=1)
        furthest = repeated.shape[1] - 1 - repeated[some][:, ::-1].argmax(axis=1)
        # windows of a context overlap, so their union is one interval
        for i, near, far in zip(some.tolist(), nearest.tolist(), furthest.tolist(), strict=True):
            at = int(start[i] + left[i])
            out[0].append(keys[i])
            out[1].append(at - far)
            out[2].append(at - near + length)
            out[3].append(None)
        for i in first[parts[first] > 1].tolist():
            for d in np.flatnonzero(own[i]).tolist():
                a = int(left[i]) - d
                digest = hashlib.blake2b(contexts[i][a : a + length], digest_size=16).digest()
                out[0].append(keys[i])
                out[1].append(int(start[i]) + a)
                out[2].append(int(start[i]) + a + length)
                out[3].append(digest)
        return tuple(out)

    def run(batches):
        share, rows = None, []
        for batch in batches:
            for s, *row in zip(batch["share"], batch["keys"], batch["froms"], batch["packed"], strict=True):
                if s != share:
                    if rows:
                        yield solve(rows)
                    share, rows = s, []
                rows.append(row)
        if rows:
            yield solve(rows)

    return run


def _merge(batches):
    """Intervals come sorted by text and start; one row a text with its maximal runs."""
    key, spans = None, []
    for batch in batches:
        out = [[], []]
        for k, a, b in zip(batch["text_key"], batch["start"], batch["end"], strict=True):
            if k != key:
                if key is not None:
                    out[0].append(key)
                    out[1].append(spans)
                key, spans = k, []
            if spans and a <= spans[-1]["end"]:
                spans[-1]["end"] = max(spans[-1]["end"], b)
            else:
                spans.append({"start": a, "end": b})
        yield tuple(out)
    if key is not None:
        yield [key], [spans]


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(text_key, spans) of every text that loses bytes: its maximal runs of repeated bytes, ends exclusive."""
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col("text").cast("string").alias("text"))
    grams = map_rows(texts, _gram_rows(length), "gram long, n long, block long, seal long")
    grams = grams.repartition(parts, "gram").sortWithinPartitions("gram")
    back = stored(map_rows(grams, _repeated, "gram long, block long, seal long, total long", lists=False), "grams")
    shares = max(16, -(-back.where("total > 0").count() // SHARE))
    rows = map_rows(texts, _text_rows, "block long, seal long, row int, n long, text binary")
    made = rows.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(
        _contexts(length, shares), "share int, keys array<binary>, froms array<long>, tos array<long>, packed binary"
    )
    # shares are numbered from 0; below 0 are intervals that a block knows already
    made = made.repartition(parts, "share").sortWithinPartitions("share")
    span = "text_key binary, start long, end long, window binary"

    def sure_or_solve(batches):
        def later():
            for batch in batches:
                now = [i for i, s in enumerate(batch["share"]) if s < 0]
                for i in now:
                    ready.append((batch["keys"][i], batch["froms"][i], batch["tos"][i], [None] * len(batch["keys"][i])))
                yield {k: [v for i, v in enumerate(vs) if batch["share"][i] >= 0] for k, vs in batch.items()}

        ready: list[tuple] = []
        for rows in _resolve(length)(later()):
            yield rows
            while ready:
                yield ready.pop()
        while ready:
            yield ready.pop()

    found = stored(map_rows(made, sure_or_solve, span), "intervals")
    # windows of grams that were split over shares: equal digests in two places
    split = found.where("window is not null")
    twice = split.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    intervals = found.where("window is null").select("text_key", "start", "end").unionByName(split.join(twice, "window").select("text_key", "start", "end"))
    intervals = intervals.repartition(parts, "text_key").sortWithinPartitions("text_key", "start")
    return stored(map_rows(intervals, _merge, "text_key binary, spans array<struct<start:long,end:long>>"), "spans")


def _kept(text: str | None, spans) -> bytes:
    raw, out, at = (text or "").encode("utf-8", "surrogatepass"), [], 0
    for s in spans or ():
        out.append(raw[at : s["start"]])
        at = s["end"]
    return b"".join(out) + raw[at:]


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same rows and columns without the repeated bytes of the text; characters cut in half go as well."""
    spans = repeated_spans(docs, length)
    keyed = docs.select(F.struct("*").alias("row"), _key_of("text").alias("text_key"))
    joined = keyed.join(spans, "text_key", "left")
    cut = F.udf(lambda text, spans: _kept(text, spans).decode("utf-8", "ignore"), "string")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(cut("row.text", "spans"))
    return joined.select(*[(text if n == "text" else F.col(f"row.`{n}`")).alias(n) for n in docs.columns])


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    joined = docs.withColumn("text_key", _key_of("text")).join(repeated_spans(docs), "text_key", "left").select("doc_id", "text", "spans")

    def digest(batches):
        for batch in batches:
            size, gone, runs, kept = [], [], [], []
            for text, spans in zip(batch["text"], batch["spans"], strict=True):
                rest = _kept(text, spans)
                gone.append(sum(s["end"] - s["start"] for s in spans or ()))
                size.append(len(rest) + gone[-1])
                runs.append(len(spans or ()))
                kept.append(hashlib.sha256(rest).hexdigest())
            yield batch["doc_id"], size, gone, runs, kept

    return map_rows(joined, digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
