"""Words as Arrow arrays, and what op2_bpe and op5_packing do with them, against the library and plain Python."""

from __future__ import annotations

import gc
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from itinera.llm import bpe, packing, words
from itinera.llm.common import WHITE
from itinera.llm.vocab import public_path, tokenizer

TEXTS = ["", None, " ", "a", "  a  b ", "a  b  c ", "　 x　　 y", "  ", "don't we'll", "é́ ́ Σ", "\x1c \x1cq", "日本語、 テスト 😀\n\n", " <|endoftext|> z<|endoftext|>"]


def test_cut_words_never_splits_white_space():
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice(" \t\n\x1c\x85    　aé日") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    first, cut = words.cut_words(pa.array(texts, pa.string()).slice(3))
    for i, text in enumerate(texts[3:]):
        mine = [w.decode() for w in cut[int(first[i]) : int(first[i + 1])].to_pylist()]
        text = text or ""
        assert "".join(mine) == text
        ends = np.cumsum([len(w) for w in mine]).tolist()[:-1]
        inside = {m.start() for m in re.finditer(f"(?<=[^{WHITE}])[\t-\r ]", text)}
        assert set(ends) == inside


def test_words_encoded_together_have_the_ids_of_each():
    rng = random.Random(5)
    _, cut = words.cut_words(pa.array([*TEXTS, *("".join(rng.choice("  \n ab'sé日1.<|") for _ in range(40)) for _ in range(400))], pa.string()))
    cut = cut.unique()
    path = public_path(bpe.VOCABULARY)
    for got, expected in zip(bpe._encoder(path)(cut), words.encode_each(tokenizer(path), cut), strict=True):
        assert got.tolist() == expected.tolist()


def test_memory_finds_old_and_new_words():
    calls = []

    def encode(new):
        calls.append(new.to_pylist())
        return np.array([len(w) for w in calls[-1]]), np.array([c for w in calls[-1] for c in w], np.uint32)

    memory = words.Memory(encode, most=3)
    for texts in ([b"ab", b"", b"ab"], [b"c", b"ab"], [b"d", b"e", b"", b"d"], [b"ab", b"d"]):
        sizes, ids = memory.of(pa.array(texts, pa.large_binary()))
        assert sizes.tolist() == [len(t) for t in texts] and bytes(ids.tolist()) == b"".join(texts)
    assert calls == [[b"ab", b""], [b"c"], [b"d", b"e"], [b"ab", b"d"]]  # forgotten before the last call, as there were five


@pytest.mark.parametrize("parts", ["4", "32"])
def test_distinct_ids_meet_the_piece_table_once_in_all(spark, monkeypatch, parts):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("qxzjkv0", k=6)) for _ in range(30)) for _ in range(60)]  # many words of few ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    ids = {i for r in bpe.encode(docs).collect() for i in r.ids}
    made, join = [], type(docs).join

    def counted(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if isinstance(on, str) and on == "id":
            made.append(out.where("id is not null").count())
        return out

    monkeypatch.setattr(type(docs), "join", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        bpe.encode_decode_digests(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert made == [len(ids)]


def _packing_ids(coder, texts):
    ends, ids = coder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]


def test_packing_has_the_ids_of_the_library():
    rng = random.Random(7)
    marks = ["W̊", "ẘ", "İ", "İ", "K", "µ", "ſ", "ŉ", "Σ", "ς", "ђ", "Ђ", "ǅ", "ß", "Ⅰ", "²", "一", "\U0001f600", "'s", "'T", "<|endoftext|>", "<|", "|>"]
    letters = [*"aAbBéÉzZ09.,!?-(|\x1c\x85 　", *marks]
    texts = TEXTS + [" \t\n  ".join("".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 8))) for _ in range(3000)]
    path = public_path(packing.VOCABULARY)
    expected = [e.ids for e in tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert _packing_ids(packing.WordCoder(path), texts) == expected


def test_packing_encodes_words_of_letters_in_few_texts(monkeypatch):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdeé", k=7)) + rng.choice(["", ".", ",)"]) for _ in range(500)) for _ in range(40)]
    coder = packing.WordCoder(public_path(packing.VOCABULARY))
    expected, inner, calls = [e.ids for e in coder.coder.encode_batch(texts, add_special_tokens=False)], coder.coder, []

    class Counted:
        def encode_batch_fast(self, texts, add_special_tokens):
            calls.append(len(texts))
            return inner.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    coder.coder = Counted()
    assert _packing_ids(coder, texts) == expected
    assert sum(calls) < 20  # 20,000 words; before, every stem was a text of its own


def test_packing_forgets_without_a_trace(monkeypatch):
    texts = [f"a{i} word{chr(97 + i % 26)}x{i}." for i in range(300)]
    path = public_path(packing.VOCABULARY)
    monkeypatch.setattr(packing, "REMEMBER", 50)
    coder = packing.WordCoder(path)
    expected = [e.ids for e in tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    assert sum((_packing_ids(coder, texts[i : i + 40]) for i in range(0, 300, 40)), []) == expected


def _memory_of(run):
    """(bytes held after, most bytes of Python and numpy meanwhile)."""
    gc.collect()
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        run()
        gc.collect()
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    return held + pa.total_allocated_bytes() - before, most


def test_packing_takes_little_memory_of_a_worker():
    rng = random.Random(9)
    coder = packing.WordCoder(public_path(packing.VOCABULARY))
    stems = sorted({"".join(rng.choices("abcdefghij", k=8)) for _ in range(60_000)})
    new = pa.array([" ".join(stems)], pa.large_string())
    held, _ = _memory_of(lambda: coder.encode(new))
    assert held < 80 * len(stems)  # of each stem its letters, its ids and where they are
    common = pa.array([" ".join(rng.choices(stems[:100], k=800_000))], pa.large_string())
    ends, ids = coder.encode(common)
    _, most = _memory_of(lambda: coder.encode(common))
    assert most < 20 * len(ids)  # ids are put together part by part
    sizes = np.diff(coder.encode(pa.array(stems[:100], pa.large_string()))[0])
    number = {w: i for i, w in enumerate(stems[:100])}
    assert ends.tolist() == [0, sum(int(sizes[number[w]]) for w in common[0].as_py().split())]


def test_array_memory_has_what_memory_has():
    def encode(new):
        found = new.to_pylist()
        return np.array([len(w) for w in found], np.int64), np.array([c for w in found for c in w], np.uint32)

    rng = random.Random(10)
    plain, small = words.Memory(encode, most=40), words.ArrayMemory(encode, most=40)
    for _ in range(60):
        some = pa.array([bytes(rng.choices(b"ab\0", k=rng.randint(0, 4))) for _ in range(rng.randint(0, 30))], pa.large_binary())
        for a, b in zip(plain.of(some), small.of(some), strict=True):
            assert a.tolist() == b.tolist()
        assert len(plain.known) == len(small.known)
