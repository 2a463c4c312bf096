"""Toxicity by multiple-instance learning.

Only documents are labelled. A sentence's probability is a logistic function of its words and their beginnings; a
document is toxic if at least one sentence is, so its probability is the noisy-or 1 - prod(1 - p) of its sentences. The
gradient of the document's likelihood decides by itself which sentences carry the label, and the same sentence scores
later locate them.

The model is fitted on a bounded sample of labelled ids (``sample``, texts of up to ``longest`` characters, in the order of
a hash of the id), whose features are made in tasks. Scoring reads every sentence of every text, in one pass without a shuffle.

Edge cases: a null or empty text is one empty sentence and gets the model's base rate; a null or missing label is not
learned from; of repeated labels for an id the larger holds, of repeated texts the smallest is learned from; null ids are scored and never learned from; without any
labelled row every score is 0; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itinera.llm.common import crc32_of, lowest, map_rows, stored, text_rows, unsigned

SAMPLE = 10_000
LONGEST = 30_000
#: Documents of the sample that must hold a feature.
LEAST = 4
#: Lengths of the word beginnings that are features besides the words.
BEGINNINGS = (3, 4, 5)
#: Slots of the hashed features.
SLOTS = 1 << 20
#: Documents of a step of the gradient's sum, which bounds the memory of fitting.
STEP = 500
#: Tokens a worker remembers before it starts anew, with their weights or with the slots of their features; results do not
#: depend on it.
REMEMBER, REMEMBER_SLOTS = 500_000, 50_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_LETTERS = re.compile(r"[\W\d_]+")


def _features(token: str) -> list[int]:
    """Slots of a token's word and of its beginnings."""
    word = _LETTERS.sub("", token.lower())
    if not word:
        return []
    names = (word, *(word[:n] + "*" for n in BEGINNINGS if n < len(word)))
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % SLOTS for x in names]


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by slot and the weight of a sentence as such."""

    weights: dict[int, float]
    base: float


def _bags(docs: DataFrame, labels: DataFrame, sample: int, longest: int) -> DataFrame:
    """(doc_id, toxic, sentences, slots, rows) of the sample, stored: of each document the slots of its sentences, which of the
    sentences each is in, and their number. Texts stay in the tasks."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    hashed = F.xxhash64("doc_id")
    chosen = lowest(known, unsigned(hashed), [hashed, "doc_id"], sample)  # so many ids at most, hence the broadcast
    texts = text_rows(docs).where(F.length("text") <= longest).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def run(batches):
        slots = _Slots()
        for batch in batches:
            columns, rows, sentences = [], [], []
            for text in batch["text"]:
                column, row = array("i"), array("i")
                bag = _SENTENCE.findall(text) or [""]
                for i, sentence in enumerate(bag):
                    mine = sorted({f for t in set(sentence.split()) for f in slots[t]})  # a feature counts once a sentence
                    column.extend(mine)
                    row.extend([i] * len(mine))
                columns.append(column.tobytes())
                rows.append(row.tobytes())
                sentences.append(len(bag))
                if len(slots) > REMEMBER_SLOTS:
                    slots = _Slots()
            yield batch["doc_id"], batch["toxic"], sentences, columns, rows

    return stored(map_rows(one, run, "doc_id long, toxic int, sentences int, slots binary, rows binary"), "bags")


def _common_slots(bags: DataFrame) -> np.ndarray:
    """Slots that enough documents hold, in order; there are ``SLOTS`` at most."""

    def run(batches):
        held = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for slots in batch["slots"]:
                held[np.unique(np.frombuffer(slots, np.int32))] += 1
        some = np.flatnonzero(held)
        yield some.tolist(), held[some].tolist()

    counts = map_rows(bags.select("slots"), run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    return np.sort(counts.where(F.col("n") >= LEAST).select("slot").toArrow().column("slot").to_numpy())


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST, rounds: int = 240) -> ToxicityModel:
    """Fit on at most ``sample`` labelled rows of the documents given, one an id. The driver sees numbers of common slots only."""
    bags = _bags(docs, labels, sample, longest)
    used = _common_slots(bags)
    number = np.full(SLOTS, -1, np.int32)
    number[used] = np.arange(len(used))

    def run(batches):
        for batch in batches:
            columns, rows = [], []
            for slots, row in zip(batch["slots"], batch["rows"], strict=True):
                column = number[np.frombuffer(slots, np.int32)]
                columns.append(column[column >= 0].tobytes())
                rows.append(np.frombuffer(row, np.int32)[column >= 0].tobytes())
            yield batch["doc_id"], batch["toxic"], batch["sentences"], columns, rows

    table = map_rows(bags, run, "doc_id long, toxic int, sentences int, slots binary, rows binary").toArrow()  # ``sample`` rows
    if not table.num_rows:
        return ToxicityModel({}, -1000.0)
    table = table.sort_by("doc_id")
    toxic, sentences = table.column("toxic").to_numpy().astype(float), table.column("sentences").to_numpy()
    steps = []
    for at in range(0, len(toxic), STEP):
        part = table.slice(at, STEP)
        mine = sentences[at : at + STEP]
        base = np.cumsum([0, *mine])
        column = np.frombuffer(b"".join(part.column("slots").to_pylist()), np.int32)
        row = np.concatenate([np.frombuffer(r, np.int32) + b for r, b in zip(part.column("rows").to_pylist(), base[:-1], strict=True)])
        steps.append((column, row.astype(np.int32), np.repeat(np.arange(len(mine)), mine), toxic[at : at + STEP]))
    del table
    weights, base = _maximise(steps, len(used), rounds)
    return ToxicityModel({int(f): float(w) for f, w in zip(used, weights, strict=True) if abs(w) > 1e-3}, float(base))


class _Slots(dict):
    def __missing__(self, token: str) -> list[int]:
        got = self[token] = _features(token)
        return got


def _gradient(w: np.ndarray, steps: list[tuple]) -> np.ndarray:
    """Of the negative log-likelihood: a document's is -log(1 - prod(1 - p)) if it is toxic, else -sum(log(1 - p))."""
    grad = np.zeros_like(w)
    for column, row, document, toxic in steps:
        z = w[-1] + np.bincount(row, w[column], len(document))
        some = np.maximum(np.bincount(document, np.logaddexp(0, z), len(toxic)), 1e-12)
        pull = np.where(toxic > 0, -1 / np.expm1(np.minimum(some, 50)), 1.0)
        slope = pull[document] / (1 + np.exp(-z))
        grad[:-1] += np.bincount(column, slope[row], len(w) - 1)
        grad[-1] += slope.sum()
    return grad


def _maximise(steps: list[tuple], features: int, rounds: int):
    """Gradient ascent (Adam) on the noisy-or likelihood, with a soft threshold that keeps rare chance words at 0."""
    n = sum(len(s[3]) for s in steps)
    w = np.zeros(features + 1)  # the last is the base
    w[-1] = -5.0
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        grad = _gradient(w, steps) / n
        grad[:-1] += 2e-5 * w[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
        rate = 0.3 * min(1.0, 2 * (1 - t / (rounds + 1)))
        w -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-6)
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - 0.04 * rate, 0)
    return w[:-1], w[-1]


class _Weights(dict):
    """Weight of each token, worked out when first seen."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model.weights

    def __missing__(self, token: str) -> float:
        got = sum(self.model.get(f, 0.0) for f in _features(token))
        self[token] = got
        return got


def _sentence_scores(text: str, known: _Weights, base: float) -> tuple[list[tuple[int, int]], np.ndarray]:
    spans, z = [], []
    for m in _SENTENCE.finditer(text):
        tokens = m.group().split()
        # each word counts once a sentence, as when it was learned
        z.append(sum(map(known.__getitem__, set(tokens))))
        spans.append(m.span())
    if not spans:
        return [(0, 0)], np.array([base])
    return spans, np.array(z) + base


def score(docs: DataFrame, model: ToxicityModel, bar: float = 0.5) -> DataFrame:
    """(doc_id, score, sentences): every document's probability, and the spans and scores of sentences at or above ``bar``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as many features as the bounded sample has

    def run(batches):
        model = shared.value
        known = _Weights(model)
        for batch in batches:
            if len(known) > REMEMBER:
                known = _Weights(model)
            scores, found = [], []
            for text in batch["text"]:
                spans, z = _sentence_scores(text or "", known, model.base)
                scores.append(float(-np.expm1(-np.logaddexp(0, z).sum())))
                if z.max() >= 0 or bar < 0.5:
                    p = 1 / (1 + np.exp(-z))
                    found.append([{"start": a, "end": b, "score": float(x)} for (a, b), x in zip(spans, p, strict=True) if x >= bar])
                else:
                    found.append([])
            yield batch["doc_id"], scores, found

    return map_rows(text_rows(docs), run, "doc_id long, score double, sentences array<struct<start:int,end:int,score:double>>")


def keep_clean(docs: DataFrame, model: ToxicityModel, bar: float = 0.5) -> DataFrame:
    """The rows, all columns, whose score is below ``bar``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        model = shared.value
        known = _Weights(model)
        for batch in batches:
            if len(known) > REMEMBER:
                known = _Weights(model)
            keep = []
            for text in batch.column("text").to_pylist():
                z = _sentence_scores(text or "", known, model.base)[1]
                keep.append(bool(-np.expm1(-np.logaddexp(0, z).sum()) < bar))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = crc32_of() % 5 == 0
    model = fit(docs.where(~held), labels.where(~held))
    scored = score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
