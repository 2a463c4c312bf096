"""Language of code-switched text by a linear-chain conditional random field.

The words of a text are a chain; each word's label is a language. Emissions sum the weights of a word's features (its
beginnings and ends, its letter n-grams and, for words frequent in one language, the word itself: the lexicon), and
learned transitions say how readily the language changes between neighbours. Forward-backward gives every word's
probabilities over the whole text; a document's language has the highest mean probability over all its words.

The model is fitted by gradient ascent on a bounded sample of labelled rows (``sample``, texts of up to ``longest``
characters, in the order of a hash of the id). As those texts mostly hold one language each, the training chains string
spans of several texts together, so that changes occur. Prediction reads whole texts in one pass without a shuffle.

Edge cases: a text that is null, empty or without letters is ``und`` with score 0; rows without a label, an id or a text
are not learned from; ties between languages go to the first by name; without any labelled row all texts are ``und``;
repeated rows keep a row each; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itinera.llm.common import crc32_of, lowest, map_rows, text_rows, unsigned

SAMPLE = 2_000
LONGEST = 20_000
#: Slots of the hashed features.
SLOTS = 1 << 17
#: Words of a training chain, and the shortest and longest span of one text in it.
CHAIN, SPAN = 64, (4, 24)
#: Most chain cells of a forward-backward pass.
CELLS = 400_000
#: Tokens a worker remembers before it starts anew; results do not depend on it.
REMEMBER = 800_000
UNKNOWN = "und"

_LETTERS = re.compile(r"[\W\d_]+")


def word_of(token: str) -> str:
    """The lower-case letters of a token; fractions, superscripts and circled numbers are none."""
    word = _LETTERS.sub("", token.lower())
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slots, positions of their words): hash slots of affixes, letter n-grams and the word itself as a lexicon entry."""
    framed = "".join(f"<{w}>" for w in words)
    code = np.frombuffer(framed.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 2)
    start = end - size - 2
    owner = np.repeat(np.arange(len(words)), size + 2)
    room = end[owner] - np.arange(len(code))  # characters from here to the end of the frame
    slots, owners = [], []

    def add(hashes: np.ndarray, kind: int, who: np.ndarray) -> None:
        slots.append((_mixed(hashes + np.uint64(kind) * np.uint64(0x632BE59BD9B4E019)) % np.uint64(SLOTS)).astype(np.int64))
        owners.append(who)

    with np.errstate(over="ignore"):
        run = np.zeros(len(code), np.uint64)  # hash of the n characters from each position on
        for n in (1, 2, 3, 4):
            run = run * np.uint64(0x9E3779B97F4A7C15) + np.r_[code[n - 1 :], np.zeros(n - 1, np.uint64)]
            long = np.flatnonzero(size >= n)
            add(run[start[long] + 1], 10 + n, long)
            add(run[end[long] - 1 - n], 20 + n, long)
            if n in (2, 3):
                inside = np.flatnonzero(room >= n)
                add(run[inside], 30 + n, owner[inside])
        whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
        add(whole, 40, np.arange(len(words)))
    return np.concatenate(slots), np.concatenate(owners)


def _emissions(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Scores (words, labels): sums damped by the root of the number of features, so that length alone is no evidence."""
    slots, owner = features(words)
    n = np.bincount(owner, minlength=len(words))
    total = np.stack([np.bincount(owner, weights[slots, k], len(words)) for k in range(weights.shape[1])], 1)
    return (total / np.sqrt(n)[:, None]).astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    labels: tuple[str, ...]
    weights: np.ndarray  # by slot and label
    change: np.ndarray  # log-weights of a label after a label
    start: np.ndarray


def _pass(emit: np.ndarray, mask: np.ndarray, change: np.ndarray, start: np.ndarray):
    """Forward-backward over chains of equal or smaller length: emit (T, B, L), mask (T, B) true on words.

    Gives word posteriors (T, B, L), summed posteriors of neighbouring labels (L, L) and the log-likelihood's normaliser.
    """
    steps, chains, labels = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e = np.exp(emit - top)
    a = np.exp(change)
    alpha = np.empty_like(e)
    scale = np.ones((steps, chains), e.dtype)
    now = np.exp(start) * e[0]
    for t in range(steps):
        if t:
            now = np.where(mask[t, :, None], (alpha[t - 1] @ a) * e[t], alpha[t - 1])
        scale[t] = now.sum(axis=1)
        alpha[t] = now / scale[t][:, None]
    gamma = np.empty_like(e)
    pairs = np.zeros((labels, labels))
    beta = np.ones((chains, labels), e.dtype)
    for t in range(steps - 1, -1, -1):
        gamma[t] = alpha[t] * beta
        if t:
            live = mask[t, :, None]
            back = e[t] * beta / scale[t][:, None]
            pairs += a * ((alpha[t - 1] * live).T @ (back * live))
            beta = np.where(live, back @ a.T, beta)
    gamma /= np.maximum(gamma.sum(axis=2, keepdims=True), 1e-30)
    return gamma, pairs, float((np.log(scale) * mask).sum() + (top[:, :, 0] * mask).sum())


def _chains(texts: list[str], labels: list[int], words: dict[str, int]):
    """Training chains (N, CHAIN) of word numbers and labels: spans of texts in an order that a fixed seed gives."""
    rng = np.random.default_rng(7)
    spans = []
    for text, label in zip(texts, labels, strict=True):
        ids = [words.setdefault(w, len(words)) for w in map(word_of, text.split()) if w]
        at = 0
        while at < len(ids):
            n = int(rng.integers(SPAN[0], SPAN[1] + 1))
            spans.append((ids[at : at + n], label))
            at += n
    order = rng.permutation(len(spans))
    flat = [i for s in order for i in spans[s][0]]
    gold = [spans[s][1] for s in order for _ in spans[s][0]]
    n = len(flat) // CHAIN * CHAIN
    if not n:  # less than one chain: repeat it
        times = -(-CHAIN // max(1, len(flat)))
        flat, gold, n = flat * times, gold * times, CHAIN
    return np.array(flat[:n]).reshape(-1, CHAIN), np.array(gold[:n]).reshape(-1, CHAIN)


def fit(docs: DataFrame, sample: int = SAMPLE, longest: int = LONGEST, rounds: int = 40) -> LanguageModel:
    """Fit on at most ``sample`` rows (doc_id, text, lang) of the documents given."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("doc_id is not null and text is not null and lang is not null").where(F.length("text") <= longest)
    hashed = F.xxhash64("doc_id")
    table = lowest(rows, unsigned(hashed), [hashed, "doc_id", "text", "lang"], sample).select("text", "lang").toArrow()
    texts, langs = table.column("text").to_pylist(), table.column("lang").to_pylist()
    names = tuple(sorted(set(langs)))
    words: dict[str, int] = {}
    letters = any(word_of(t) for text in texts for t in text.split())
    if not names or not letters:
        return LanguageModel((), np.zeros((SLOTS, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    chain, gold = _chains(texts, [names.index(x) for x in langs], words)
    flat, word = features(list(words))
    share = 1 / np.sqrt(np.bincount(word, minlength=len(words)))
    labels = len(names)
    w, change, start = np.zeros((SLOTS, labels)), np.eye(labels), np.zeros(labels)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, change, start)]
    mask = np.ones((CHAIN, len(chain)), bool)
    onehot = np.eye(labels)
    for t in range(1, rounds + 1):
        score = np.stack([np.bincount(word, w[flat, k], len(words)) for k in range(labels)], 1) * share[:, None]
        gamma, pairs, _ = _pass(score[chain.T], mask, change, start)
        miss = gamma - onehot[gold.T]
        by_word = np.stack([np.bincount(chain.T.ravel(), miss[:, :, k].ravel(), len(words)) for k in range(labels)], 1) * share[:, None]
        grad_w = np.stack([np.bincount(flat, by_word[word, k], SLOTS) for k in range(labels)], 1) / chain.size
        seen = np.zeros((labels, labels))
        np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        grads = [grad_w + 1e-6 * w, (pairs - seen) / chain.size, (gamma[0] - onehot[gold[:, 0]]).mean(axis=0) / CHAIN]
        for x, g, (m, v), rate in zip((w, change, start), grads, moments, (0.2, 0.1, 0.1), strict=True):
            m[:] = 0.9 * m + 0.1 * g
            v[:] = 0.99 * v + 0.01 * g * g
            x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return LanguageModel(names, w.astype(np.float32), change, start)


class _Emissions:
    """A growing table of the emissions of words; row 0 is for tokens without letters."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.tokens: dict[str, int] = {}
        self.words: dict[str, int] = {"": 0}
        self.table = np.zeros((1024, len(model.labels)), np.float32)

    def chains(self, texts: list[str | None]) -> list[np.ndarray]:
        """Table rows of the words of each text."""
        split = [(t or "").split() for t in texts]
        here: set[str] = set()
        here.update(*split)
        fresh = []
        for token in here.difference(self.tokens):
            word = word_of(token)
            row = self.words.get(word)
            if row is None:
                row = self.words[word] = len(self.words)
                fresh.append(word)
            self.tokens[token] = row
        if fresh:
            first = len(self.words) - len(fresh)
            while len(self.table) < len(self.words):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            for at in range(0, len(fresh), 100_000):
                part = fresh[at : at + 100_000]
                self.table[first + at : first + at + len(part)] = _emissions(part, self.model.weights)
        out = []
        for tokens in split:
            rows = np.fromiter(map(self.tokens.__getitem__, tokens), np.int64, len(tokens))
            out.append(rows[rows > 0])
        return out


# The worker's table, kept from task to task; by the model's checksum.
_KNOWN: dict[int, _Emissions] = {}


def _known(model: LanguageModel, seal: int) -> _Emissions:
    if seal not in _KNOWN or len(_KNOWN[seal].tokens) > REMEMBER:
        _KNOWN.clear()
        _KNOWN[seal] = _Emissions(model)
    return _KNOWN[seal]


def _groups(lengths: list[int]) -> list[list[int]]:
    """Positions by falling length, in groups of at most CELLS cells (one chain at least)."""
    order = sorted((i for i, n in enumerate(lengths) if n), key=lambda i: -lengths[i])
    out: list[list[int]] = []
    for i in order:
        if not out or (len(out[-1]) + 1) * lengths[out[-1][0]] > CELLS:
            out.append([])
        out[-1].append(i)
    return out


def word_posteriors(model: LanguageModel, chains: list[np.ndarray], table: np.ndarray):
    """For each group of chains of emission rows: (positions, word posteriors (T, B, L), mask (T, B))."""
    for group in _groups([len(c) for c in chains]):
        rows = np.zeros((len(chains[group[0]]), len(group)), np.int64)
        mask = np.zeros(rows.shape, bool)
        for k, i in enumerate(group):
            rows[: len(chains[i]), k] = chains[i]
            mask[: len(chains[i]), k] = True
        gamma, _, _ = _pass(table[rows], mask, model.change.astype(np.float32), model.start.astype(np.float32))
        yield group, gamma, mask


def predict(docs: DataFrame, model: LanguageModel, with_words: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score[, words array<string>: the label of each word that has letters])."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of slots
    seal = zlib.crc32(model.weights.tobytes(), zlib.crc32(model.change.tobytes()))

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch["text"]
            at = 0
            while at < len(texts):  # a bounded share of the batch at a time
                upto, chars = at, 0
                while upto < len(texts) and (upto == at or chars < 8_000_000):
                    chars += len(texts[upto] or "")
                    upto += 1
                langs, scores = [UNKNOWN] * (upto - at), [0.0] * (upto - at)
                said = [[] for _ in range(upto - at)]
                if model.labels:
                    known = _known(model, seal)
                    chains = known.chains(texts[at:upto])
                    table = known.table
                    for group, gamma, mask in word_posteriors(model, chains, table):
                        mean = (gamma * mask[:, :, None]).sum(axis=0) / mask.sum(axis=0)[:, None]
                        best = mean.argmax(axis=1)
                        for k, i in enumerate(group):
                            langs[i], scores[i] = model.labels[best[k]], float(min(1.0, mean[k, best[k]]))
                            if with_words:
                                said[i] = [model.labels[x] for x in gamma[mask[:, k], k].argmax(axis=1)]
                yield (batch["doc_id"][at:upto], langs, scores, said) if with_words else (batch["doc_id"][at:upto], langs, scores)
                at = upto

    return map_rows(text_rows(docs), run, "doc_id long, lang_pred string, score double" + (", words array<string>" if with_words else ""))


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = crc32_of() % 4 == 2
    model = fit(docs.where(~held))
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
