"""Byte-pair encoding and decoding through a distinct-word table.

The tokenizer's first step never joins text across a change from other characters to white space, so a text can be cut
there into words (white space stays with the word behind it) and each word encoded by itself. It is cut at white space of one
byte; wider white space stays inside a word.

encode: a task cuts its rows into blocks of bounded size and numbers each block's distinct words. The words go out by a
hash, as one row for each block and share of the hash; sorted by share, so that a task streams over all blocks while it
holds one share of the word table, in which each distinct word is encoded once. The ids come back by block and are
joined to the texts by position. Texts themselves are not shuffled, only word numbers (few bytes a word) are.

decode: ids meet their pieces in a join with the id-to-piece table (as long as the vocabulary, so a broadcast), once for
each distinct id of all texts, whatever the number of tasks and blocks. The words' ids are stored before it, so that no
word is encoded twice. The pieces that were met, one packed row, go with each block, which puts its texts together by position.

A block's word numbering is made twice, for the words and for the numbers; both carry its checksum, and the join fails
loudly if an input gave its rows in another order the second time.

Edge cases: a null text is an empty one and has no ids; white space alone is a word; the strings of special tokens become
their ids, as the library does; a null id and repeated rows each keep a row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import map_rows, squeeze, stored, text_rows, unsqueeze
from itinera.llm.vocab import public_path, tokenizer
from itinera.llm.words import SPACE, Memory, cut_words, encode_together, ends_white, flat, offsets_of, places, spans

VOCABULARY = "byte_bpe_50k.json"
#: Bytes of text in a block; it bounds what a task holds.
BLOCK = 12_000_000
#: Most shares of the word table; a share's words are all that a task remembers.
SHARES = 4096


@cache
def _pieces(path: str) -> list[bytes]:
    """Bytes of each id: the id-to-piece table of a byte-level vocabulary."""
    loaded = tokenizer(path)
    # the byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ... in order
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    out = [b""] * loaded.get_vocab_size(with_added_tokens=True)
    for token, i in loaded.get_vocab(with_added_tokens=True).items():
        out[i] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
    return out


def piece_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, piece): one row an id of the vocabulary."""
    path = path or public_path(VOCABULARY)
    return spark.createDataFrame(list(enumerate(_pieces(path))), "id int, piece binary")


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte planes, compressed: small numbers cost a byte or two."""
    return squeeze(np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _pack_ids(ids: np.ndarray) -> bytes:
    """Ids as they are, with two bytes each if that is enough: frequent ones and their neighbours are found again."""
    width = b"2" if not len(ids) or ids.max() < 1 << 16 else b"4"
    return width + squeeze(ids.astype("<u" + width.decode()).tobytes())


def _unpack_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(unsqueeze(packed[1:]), "<u" + packed[:1].decode()).astype("<u4")


def _blocks(batches):
    """(block, ids of its rows, number of each row's first word and an end, words by number, numbers of all words);
    frequent words have small numbers."""
    task, serial = TaskContext.get().partitionId(), 0
    held, size = [], 0

    def close():
        names, texts = (pa.concat_arrays([b.column(c) for b in held]) for c in ("doc_id", "text"))
        first, words = cut_words(texts)
        coded = words.dictionary_encode()
        numbers = coded.indices.to_numpy()
        by = np.argsort(-np.bincount(numbers, minlength=len(coded.dictionary)), kind="stable")
        rank = np.empty(len(by), np.uint32)
        rank[by] = np.arange(len(by))
        return (task << 32) + serial, names, first, coded.dictionary.take(pa.array(by)), rank[numbers]

    for batch in batches:
        while len(batch):
            sizes = size + np.cumsum(np.diff(flat(batch.column("text").fill_null(""))[0]) + 16)
            n = int(np.searchsorted(sizes, BLOCK)) + 1
            held.append(batch.slice(0, n))
            size = int(sizes[min(n, len(sizes)) - 1])
            batch = batch.slice(n)
            if size >= BLOCK:
                yield close()
                serial += 1
                held, size = [], 0
    if held:
        yield close()


def _seal(words: pa.Array) -> int:
    ends, data = flat(words)
    return zlib.crc32(data, zlib.crc32(ends[1:].tobytes())) if len(words) else 0


def _share_of(words: pa.Array, shares: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words.to_pylist()), np.int64, len(words)) % shares


def _word_rows(shares: int):
    """A block's words by share; those of a share in the order of their numbers."""

    def run(batches):
        for block, _, _, words, _ in _blocks(batches):
            if not len(words):
                continue
            share = _share_of(words, shares)
            by = np.argsort(share, kind="stable")
            keys, first = np.unique(share[by], return_index=True)
            edges = [*zip(first.tolist(), [*first[1:].tolist(), len(by)], strict=True)]
            ends, data = flat(words.take(pa.array(by)))
            yield (
                [block] * len(keys),
                [_seal(words)] * len(keys),
                keys.tolist(),
                [squeeze(data[ends[a] : ends[b]].tobytes()) for a, b in edges],
                [_pack(np.diff(ends[a : b + 1])) for a, b in edges],
            )

    return run


def _number_rows(shares: int):
    """One row a block: ids of its rows, how many words each has, the numbers of all words, and each number's share."""

    def run(batches):
        for block, names, first, words, numbers in _blocks(batches):
            yield [block], [_seal(words)], [names.to_pylist()], [_pack(np.diff(first))], [_pack(numbers)], [_pack(_share_of(words, shares))]

    return run


def _encoder(path: str):
    """Ids of distinct words. Those that begin with white space and end with other characters are encoded many in one text,
    as the tokenizer cuts it there anyway; the bytes of the ids tell where each ends."""
    coder = tokenizer(path)
    length = np.array([len(p) for p in _pieces(path)], np.int64)

    def last(ids, ends):
        upto = np.cumsum(length[ids])
        at = np.searchsorted(upto, ends)
        return at if len(upto) and upto[-1] == ends[-1] and (upto[at] == ends).all() else None

    def encode(words: pa.Array):
        ends, data = flat(words)
        fit = SPACE[data[ends[:-1]]] & ~ends_white(data, ends[1:]) & ~pc.match_substring(words, "<|").to_numpy(zero_copy_only=False)
        return encode_together(coder, words, fit, b"", last)

    return encode


def _encode_words(path: str, distinct: bool):
    """Rows of words with their ids; with ``distinct`` also a row for each id that the words of the task have, once."""

    def run(batches):
        encode = _encoder(path)
        seen = np.zeros(len(_pieces(path)), bool)
        share, memory = None, None
        for batch in batches:
            shares = batch.column("share").to_numpy()
            edges = np.flatnonzero(np.diff(shares, prepend=-1, append=-1)).tolist()
            lens, ids = [], []
            for a, b in zip(edges, edges[1:], strict=False):
                if shares[a] != share:
                    share, memory = shares[a], Memory(encode)
                sizes = [_unpack(x) for x in batch.column("lens").slice(a, b - a).to_pylist()]
                data = b"".join(map(unsqueeze, batch.column("words").slice(a, b - a).to_pylist()))
                counts, got = memory.of(spans(offsets_of(np.concatenate(sizes)), data))
                ends = offsets_of([*map(len, sizes)])
                upto = offsets_of(counts)[ends]
                lens += [_pack(counts[x:y]) for x, y in zip(ends, ends[1:], strict=False)]
                ids += [_pack_ids(got[x:y]) for x, y in zip(upto, upto[1:], strict=False)]
                if distinct:
                    seen[got] = True
            n = len(batch)
            yield batch.column("block"), batch.column("seal"), batch.column("share"), lens, ids, [None] * n
        if distinct:
            ids = np.flatnonzero(seen)
            none = [None] * len(ids)
            yield none, none, none, none, none, ids

    return run


def _by_position(rows: pa.Table, words: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: its rows' ids, the first word of each row and an end, the place of each word's ids, the first id at each
    place and an end, and all ids."""
    if len(rows) != 1 or set(rows["seal"].to_pylist()) != (set(words["seal"].to_pylist()) if len(words) else {_seal(pa.array([], pa.large_binary()))}):
        raise RuntimeError("the input gave its rows in another order when it was read again")
    row = rows.to_pylist()[0]
    words = words.sort_by("share")
    owner = _unpack(row["owner"])
    lens, ids = (np.concatenate([np.zeros(0, "<u4"), *map(read, words[c].to_pylist())]) for read, c in ((_unpack, "lens"), (_unpack_ids, "ids")))
    place = np.empty(len(lens), np.int64)
    place[np.argsort(owner, kind="stable")] = np.arange(len(lens))
    first = offsets_of(_unpack(row["counts"]))
    return pa.array(row["names"], pa.int64()), first, place[_unpack(row["codes"])], offsets_of(lens), ids


def _coded(docs: DataFrame, path: str, distinct: bool):
    """The two sides of the join by block: its rows with word numbers, and words with their ids; the latter with ``distinct``
    also hold a row for each id of a partition's words (its other columns are null)."""
    rows = text_rows(docs)
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = min(SHARES, 4 * parts)
    words = map_rows(rows, _word_rows(shares), "block long, seal long, share int, words binary, lens binary", lists=False)
    words = words.repartition(parts, "share").sortWithinPartitions("share")
    coded = map_rows(words, _encode_words(path, distinct), "block long, seal long, share int, lens binary, ids binary, id int", lists=False)
    numbers = map_rows(rows, _number_rows(shares), "block long, seal long, names array<long>, counts binary, codes binary, owner binary", lists=False)
    return numbers, coded


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""
    path = path or public_path(VOCABULARY)

    def join(rows: pa.Table, words: pa.Table) -> pa.Table:
        names, first, place, upto, ids = _by_position(rows, words)
        sizes = upto[place + 1] - upto[place]
        ends = offsets_of(sizes)[first]
        found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[places(upto[place], sizes)], pa.int32()))
        return pa.table({"doc_id": names, "ids": found})

    numbers, coded = _coded(docs, path, distinct=False)
    return numbers.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(join, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids array<int>): whole id sequences, special tokens kept; null ids give an empty text.

    Runs of 4,096 ids meet the piece table; only then are a row's pieces put together, by position.
    """
    spark = encoded.sparkSession
    run = 4096
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "ids"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("ids") - 1, F.lit(0)), F.lit(run))
    cut = rows.select("row", "doc_id", F.explode(starts).alias("at"), "ids").select("row", "doc_id", "at", F.slice("ids", F.col("at") + 1, run).alias("ids"))
    cut = cut.groupBy("row", "at").agg(F.first("doc_id").alias("doc_id"), F.first("ids").alias("ids"), F.count("*").alias("copies"))
    each = cut.select("row", "at", "doc_id", "copies", F.posexplode_outer("ids").alias("pos", "id"))
    pieces = F.broadcast(piece_table(spark, path))  # as many rows as the vocabulary
    joined = each.join(pieces, "id", "left")
    order = F.array_sort(F.collect_list(F.struct((F.col("at") + F.coalesce("pos", F.lit(0))).alias("pos"), F.coalesce("piece", F.lit(b"")).alias("piece"))))
    whole = joined.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("copies").alias("copies"), order.alias("pieces"))
    text = F.udf(lambda pieces: b"".join(bytes(p["piece"]) for p in pieces).decode("utf-8", "replace"), "string")
    one = whole.select("doc_id", "copies", text("pieces").alias("text"))
    return one.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc_id", "text")


def _packed_pieces(batches):
    """One row with the ids of the rows, the lengths of their pieces and the pieces: at most the vocabulary."""
    ids, pieces = [], []
    for batch in batches:
        ids += batch["id"]
        pieces += batch["piece"]
    yield [_pack(np.array(ids, np.uint32))], [_pack(np.fromiter(map(len, pieces), np.uint32, len(pieces)))], [squeeze(b"".join(pieces))]


@cache
def _decimals(size: int) -> pa.Array:
    return pa.array([b"%d," % i for i in range(size)], pa.large_binary())


def encode_decode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the ids of each distinct word of a block, and the pieces that these ids
    met in the id-to-piece table, are joined back by position. Encodes when it is called."""
    path = path or public_path(VOCABULARY)

    def join(rows: pa.Table, words: pa.Table) -> pa.Table:
        names, first, place, upto, ids = _by_position(rows, words)
        out = {"doc_id": names, "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        if len(ids):
            met, lens, joined = (rows[c][0].as_py() for c in ("met", "lens", "pieces"))
            met = _unpack(met)
            at = np.full(int(max(met.max(), ids.max())) + 1, -1)
            at[met] = np.arange(len(met))
            pieces = spans(offsets_of(_unpack(lens)), unsqueeze(joined)).take(pa.array(at[ids]))
            decimals = _decimals(-(-len(at) // 65536) * 65536).take(pa.array(ids))
            # from ids to words, and on to all words in their order
            (ends, digits), (sizes, texts) = (flat(spans(x[upto], y).take(pa.array(place))) for x, y in (flat(decimals), flat(pieces)))
        else:
            ends = sizes = np.zeros(1, np.int64)
            digits = texts = np.zeros(0, np.uint8)
        out["n_tokens"] = np.diff(offsets_of(upto[place + 1] - upto[place])[first])
        ends, sizes = ends[first].tolist(), sizes[first].tolist()
        for a, b in zip(ends, ends[1:], strict=False):
            out["ids_sha256"].append(hashlib.sha256(digits[a : max(a, b - 1)]).hexdigest())
        for a, b in zip(sizes, sizes[1:], strict=False):
            text = texts[a:b].tobytes()
            try:
                text.decode()
            except UnicodeDecodeError:  # as the library's decoder does
                text = text.decode("utf-8", "replace").encode()
            out["decoded_sha256"].append(hashlib.sha256(text).hexdigest())
        return pa.table(out)

    numbers, coded = _coded(docs, path, distinct=True)
    coded = stored(coded, "coded")
    ids = coded.where("id is not null").select("id").distinct()
    met = ids.join(F.broadcast(piece_table(docs.sparkSession, path)), "id", "left")  # as many rows as the vocabulary, at most
    pieces = map_rows(met.repartition(1), _packed_pieces, "met binary, lens binary, pieces binary")
    numbers = numbers.join(F.broadcast(pieces), F.lit(True), "left")  # one row
    words = coded.where("id is null").drop("id")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return numbers.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(join, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    return encode_decode_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
