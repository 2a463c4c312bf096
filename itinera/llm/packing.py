"""Harmonic packing of documents into sequences of a fixed capacity.

A document's length modulo the capacity C puts it in the class k = C // length: the lengths in (C / (k + 1), C / k].
A bin of class k takes exactly k documents, whatever their lengths, so classes and workers need to know nothing of each
other and nothing is shuffled. What such bins leave free is then filled by cutting the documents of incomplete bins and,
after them, of the last bins. The remainder of a window is cut at powers of two, where a sequence needs no padding.

A task packs its rows in windows of ``window`` tokens, which bounds its memory. Sequence ids join the number of the
partition and a running number: a retried task gives the same ids as long as its input partition has the same rows.

Edge cases: a null text is an empty one, and every document has at least the closing id; repeated rows are packed each
for itself; a null id is kept; a text longer than a window makes a window of its own; an empty table gives no piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from itinera.llm.common import map_rows, text_rows
from itinera.llm.vocab import public_path, tokenizer
from itinera.llm.words import ArrayMemory, encode_together, flat, offsets_of, places, spans

CAPACITY = 4096
VOCABULARY = "word_bpe_49k.json"
END = 2
#: Stems that a worker remembers before it forgets them all; results do not depend on it.
REMEMBER = 800_000
#: Bytes of texts that are encoded at a time, or a batch more.
PART = 4_000_000
#: Words whose ids are put together at a time.
GATHER = 200_000
#: Punctuation that is cut off words before they are encoded.
MARKS = ".,!?;:*&%$#|\"()-"
#: Words that surely end in a letter or digit (a capital I with a dot becomes a letter and a mark), words of letters whose
#: lower case is as many letters, and words without marks that join a letter.
CLOSED = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0400-\u0481\u048a-\u04ff]$"
LETTERS = "^[a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u017f\u03b1-\u03c9\u0400-\u045f\u4e00-\u9fa5]+$"
LATIN = "^[\\x00-\u00ff]+$"


def pack_window(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) pieces that cover all documents; only whole or power-of-two sequences."""
    pieces: list[tuple[int, int, int, int, int]] = []
    bins: list[list[tuple[int, int, int]]] = []  # (document, start, length)
    classes: dict[int, list[tuple[int, int, int]]] = {}
    for doc, n in enumerate(lengths):
        whole, rest = divmod(n, capacity)
        bins.extend([(doc, i * capacity, capacity)] for i in range(whole))
        if rest:
            classes.setdefault(capacity // rest, []).append((doc, whole * capacity, rest))
    loose: list[tuple[int, int, int]] = []
    for k in sorted(classes):
        items = classes[k]
        full = len(items) - len(items) % k
        bins.extend(items[i : i + k] for i in range(0, full, k))
        loose.extend(items[full:])
    loose.reverse()
    free = [capacity - sum(x[2] for x in b) for b in bins]
    at = 0
    while at < len(bins):
        room = free[at]
        while room:
            if not loose:
                if len(bins) - 1 <= at:
                    break
                loose.extend(bins.pop())
                free.pop()
                continue
            doc, start, n = loose.pop()
            take = min(n, room)
            bins[at].append((doc, start, take))
            if take < n:
                loose.append((doc, start + take, n - take))
            room -= take
        free[at] = room
        at += 1
    if bins and free[-1]:  # no documents are left to fill it with
        loose.extend(reversed(bins.pop()))
    rest = sum(x[2] for x in loose)
    while rest:  # whole sequences, then one for each power of two in the remainder
        size = capacity if rest >= capacity else 1 << (rest.bit_length() - 1)
        filled: list[tuple[int, int, int]] = []
        room = size
        while room:
            doc, start, n = loose.pop()
            take = min(n, room)
            filled.append((doc, start, take))
            if take < n:
                loose.append((doc, start + take, n - take))
            room -= take
        bins.append(filled)
        rest -= size
    for sequence, b in enumerate(bins):
        offset = 0
        for doc, start, n in b:
            pieces.append((doc, start, n, sequence, offset))
            offset += n
    return pieces


class WordCoder:
    """Token ids of whole texts, as arrays of unsigned 32-bit numbers.

    The tokenizer never joins across white space, so each word is encoded once and remembered. Nor does it join a letter
    or digit with punctuation behind it, and it lower-cases: words that differ only there share one encoding, that of their
    stem. Stems of letters alone are encoded many in one text; the ids that end a word tell them apart.
    """

    def __init__(self, path: str):
        self.coder = tokenizer(path)
        self.closing = np.zeros(self.coder.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.coder.get_vocab(with_added_tokens=False).items():
            self.closing[i] = token.endswith("</w>")
        self.stems = ArrayMemory(self._encode, REMEMBER)

    def _last(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        at = np.flatnonzero(self.closing[ids])
        return at if len(at) == len(ends) and at[-1] == len(ids) - 1 else None

    def _encode(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        fit = pc.match_substring_regex(stems.cast(pa.large_string()), LETTERS).to_numpy(zero_copy_only=False)
        return encode_together(self.coder, stems, fit, b" ", self._last)

    @staticmethod
    def _stems(words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Of each word a spelling with the same ids, cut before closing punctuation, and that punctuation; only where the
        tokenizer surely cuts as well. What holds "<|" may hold the string of a special token."""
        stems = pc.utf8_rtrim(words, MARKS)
        sure = pc.and_(pc.match_substring_regex(stems, CLOSED), pc.invert(pc.match_substring(words, "<|")))
        stems = pc.if_else(sure, stems, words)
        low = pc.if_else(pc.and_(pc.match_substring_regex(stems, LATIN), pc.invert(pc.match_substring(stems, "<|"))), pc.utf8_lower(stems), stems)
        ends, data = flat(words)
        sizes = pc.binary_length(stems).to_numpy()
        rest = np.diff(ends) - sizes
        return low.cast(pa.large_binary()), spans(offsets_of(rest), data[places(ends[:-1] + sizes, rest)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets of the texts' ids, ids): words are split at white space of one byte and numbered as arrays; only distinct words
        are looked at."""
        split = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        numbered = split.flatten().dictionary_encode()
        stems, tails = self._stems(numbered.dictionary)
        both = pa.concat_arrays([stems, tails]).dictionary_encode()  # looked up together, as the memory may forget
        at = self.stems.find(both.dictionary)[both.indices.to_numpy()].reshape(2, -1).T.ravel()
        sizes = self.stems.sizes[at]
        ids = self.stems.ids[places(self.stems.starts[at], sizes)]
        ends = offsets_of(sizes)[::2]
        sizes = np.diff(ends)
        at = numbered.indices.to_numpy()
        upto = offsets_of(sizes[at])
        out = np.empty(upto[-1], np.uint32)
        for x in range(0, len(at), GATHER):
            some = at[x : x + GATHER]
            out[upto[x] : upto[x + len(some)]] = ids[places(ends[some], sizes[some])]
        offsets = split.offsets.to_numpy()
        return upto[offsets - offsets[0]], out


_CODERS: dict[str, WordCoder] = {}


def pack_documents(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, window: int = 4_000_000, with_ids: bool = True
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids little-endian unsigned 32-bit])."""
    path = path or public_path(VOCABULARY)
    close = int(end).to_bytes(4, "little")

    def flush(names, codes, task, base):
        out = [[] for _ in range(8 if with_ids else 7)]
        top = 0
        for doc, start, n, sequence, offset in pack_window([len(c) // 4 for c in codes], capacity):
            ids = codes[doc][4 * start : 4 * (start + n)]
            row = (names[doc], start, n, zlib.crc32(ids), len(codes[doc]) // 4, (task << 36) + base + sequence, offset, ids)
            for column, value in zip(out, row, strict=False):
                column.append(value)
            top = sequence + 1
        return tuple(out), base + top

    def parts(batches):
        names, texts = [], []
        for batch in batches:
            names.append(batch.column("doc_id"))
            texts.append(batch.column("text").cast(pa.large_string()))
            if sum(x.nbytes for x in texts) >= PART:
                yield pa.concat_arrays(names), pa.concat_arrays(texts)
                names, texts = [], []
        if texts:
            yield pa.concat_arrays(names), pa.concat_arrays(texts)

    def run(batches):
        coder = _CODERS.get(path) or _CODERS.setdefault(path, WordCoder(path))
        task = TaskContext.get().partitionId()
        names, codes, held, base = [], [], 0, 0
        for ids, texts in parts(batches):
            ends, found = coder.encode(texts)
            found = found.tobytes()
            pa.default_memory_pool().release_unused()  # workers stay and share an executor's memory
            for name, x, y in zip(ids.to_pylist(), ends.tolist(), ends[1:].tolist(), strict=False):
                names.append(name)
                codes.append(found[4 * x : 4 * y] + close)
                held += y - x + 1
                if held >= window:
                    out, base = flush(names, codes, task, base)
                    yield out
                    names, codes, held = [], [], 0
        if names:
            out, base = flush(names, codes, task, base)
            yield out

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return map_rows(text_rows(docs), run, schema + (", ids binary" if with_ids else ""), lists=False)


def op5(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
