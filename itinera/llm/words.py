"""Words as Arrow arrays: cut from texts, taken by number, encoded many at a time and remembered with their ids."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from itinera.llm.common import WHITE

_WIDE = [c.encode() for c in map(chr, range(0x80, 0x3001)) if re.match(f"[{WHITE}]", c)]
_TWO = np.array([int.from_bytes(c, "big") for c in _WIDE if len(c) == 2])
_THREE = np.array([int.from_bytes(c, "big") for c in _WIDE if len(c) == 3])
#: Whether a byte is white space by itself.
SPACE = np.isin(np.arange(256), [*range(9, 14), 32])
#: Bytes of words that are encoded as one text.
TOGETHER = 200_000


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of an array of strings or bytes without nulls."""
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    if not len(array):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def spans(offsets: np.ndarray, data) -> pa.Array:
    """Bytes between neighbouring offsets."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def offsets_of(sizes) -> np.ndarray:
    """Offsets of spans of these sizes, one behind the other."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every span, one span behind the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def ends_white(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character before each position is white space."""
    last = data[ends - 1]
    out = SPACE[last]
    high = np.flatnonzero(last >= 0x80)
    at = ends[high]
    two = data[at - 2].astype(np.int64) << 8 | last[high]
    out[high] = np.isin(two, _TWO) | np.isin(data[at - 3].astype(np.int64) << 16 | two, _THREE)
    return out


def cut_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(the first word's number of each text and an end, all words): a word begins with a text, or where white space of one
    byte follows any other character than white space."""
    offsets, data = flat(texts.fill_null(""))
    begins = SPACE[data]
    begins[1:] &= ~begins[:-1].copy()
    at = np.flatnonzero(begins)
    begins[at[ends_white(data, at)]] = False
    begins[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    starts = np.flatnonzero(begins)
    return np.searchsorted(starts, offsets), spans(np.append(starts, len(data)), data)


def encode_each(coder, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each word, all ids), every word encoded by itself."""
    sizes, ids = np.zeros(len(words), np.int64), []
    for at in range(0, len(words), 20_000):
        texts = [w.decode() for w in words[at : at + 20_000].to_pylist()]
        for i, e in enumerate(coder.encode_batch_fast(texts, add_special_tokens=False), at):
            got = e.ids
            sizes[i] = len(got)
            ids += got
    return sizes, np.array(ids, np.uint32)


def encode_together(coder, words: pa.Array, fit: np.ndarray, between: bytes, last: Callable) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`encode_each`; words that ``fit`` are encoded many in one text, with ``between`` in between.

    ``last(ids, ends)`` gives the positions of the words' last ids in that text's ids, where ``ends`` are the ends of the words in
    its bytes, or None if they cannot be told apart; the words are then encoded one by one.
    """
    sizes = np.zeros(len(words), np.int64)
    order, parts = [], []

    def one_by_one(which):
        n, ids = encode_each(coder, words.take(pa.array(which)))
        sizes[which] = n
        order.append(which)
        parts.append(ids)

    offsets, _ = flat(words)
    many = np.flatnonzero(fit)
    share = np.cumsum((offsets[1:] - offsets[:-1])[many]) // TOGETHER
    for which in np.split(many, np.flatnonzero(np.diff(share)) + 1) if len(many) else ():
        mine = words.take(pa.array(which)).to_pylist()
        ids = np.array(coder.encode_batch_fast([between.join(mine).decode()], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.cumsum(np.fromiter(map(len, mine), np.int64, len(mine)) + len(between)) - len(between)
        at = last(ids, ends)
        if at is None:
            one_by_one(which)
            continue
        sizes[which] = np.diff(at, prepend=-1)
        order.append(which)
        parts.append(ids)
    if not fit.all():
        one_by_one(np.flatnonzero(~fit))
    if not order:
        return sizes, np.zeros(0, np.uint32)
    order, ids = np.concatenate(order), np.concatenate(parts)
    found = np.zeros(len(words), np.int64)
    found[order] = np.cumsum(sizes[order]) - sizes[order]
    return sizes, ids[places(found, sizes)]


class Memory:
    """Words met so far with their ids; ``encode(words)`` gives (number of ids of each, all ids) of new ones."""

    def __init__(self, encode: Callable, most: int | None = None):
        self.encode, self.most = encode, most
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, words: pa.Array) -> np.ndarray:
        """The number of each of these distinct words, by which ``starts`` and ``sizes`` tell its span of ``ids``, until the next call."""
        if self.most is not None and len(self.known) > self.most:
            self.__init__(self.encode, self.most)
        at = self._numbers(words)
        new = np.flatnonzero(at >= len(self.starts))
        if len(new):
            sizes, ids = self.encode(words.take(pa.array(new)))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, ids])
        return at

    def _numbers(self, words: pa.Array) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words.to_pylist()), np.int64, len(words))

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, ids of all): each distinct word is looked up once."""
        coded = words.dictionary_encode()
        at = self.find(coded.dictionary)[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        return sizes, self.ids[places(self.starts[at], sizes)]


class ArrayMemory(Memory):
    """The same with the words in one array, not an object each. Every call hashes them anew, so calls should be few and large."""

    def __init__(self, encode: Callable, most: int | None = None):
        super().__init__(encode, most)
        self.known = pa.array([], pa.large_binary())

    def _numbers(self, words: pa.Array) -> np.ndarray:
        at = pc.index_in(words, value_set=self.known)
        new = at.is_null()
        at = at.fill_null(0).to_numpy().astype(np.int64)
        which = np.flatnonzero(new.to_numpy(zero_copy_only=False))
        at[which] = len(self.known) + np.arange(len(which))
        self.known = pa.concat_arrays([self.known, words.filter(new)])
        return at
