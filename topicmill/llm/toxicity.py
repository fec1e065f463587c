"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters the network as its own vector (words that the training texts repeat)
beside the mean vector of its character trigrams, so unseen forms are read by their
letters. The network reads overlapping windows of a text's words in both directions
and pools its states by attention; a text's score is that of its most toxic window.
It is trained in numpy on the driver from a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicmill.llm.common import Sent
from topicmill.llm.word_tokens import texts_of

#: Words of at most this many letters; longer ones are read in parts.
LETTERS = 24
WORDS = re.compile(r"[^\W\d_]{1,24}|\d{1,24}")
GRAMS = 1 << 13
#: Words a worker keeps projections of before it starts anew.
REMEMBERED = 150_000


@dataclass
class Settings:
    """``sample_toxic`` and ``sample_clean`` bound the labelled documents that are read
    for training, ``vocabulary`` the words with a vector of their own. Small samples are
    read again until ``least_steps`` steps are made."""

    window: int = 48
    stride: int = 24
    hidden: int = 8
    width: int = 8
    vocabulary: int = 8192
    least_documents: int = 3
    sample_toxic: int = 1000
    sample_clean: int = 2000
    rounds: int = 6
    least_steps: int = 300
    batch: int = 64
    rate: float = 0.01
    seed: int = 42


@dataclass
class Model:
    settings: Settings
    words: dict[str, int]
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0
    wordless: float = 0.0


def split_words(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def trigrams(words: list[str]) -> np.ndarray:
    """Hashed letter trigrams of each word, with its ends; -1 fills up."""
    codes = np.array(words, f"U{LETTERS}").view(np.uint32).reshape(len(words), LETTERS).astype(np.int64)
    codes = np.concatenate((np.full((len(words), 1), 1), codes, np.zeros((len(words), 1), np.int64)), axis=1)
    hashed = (codes[:, :-2] * 1_000_003 + codes[:, 1:-1] * 8191 + codes[:, 2:]) * 2_654_435_761 >> 11
    return np.where(codes[:, 1:-1] > 0, hashed % GRAMS, -1)


def vectors(weights: dict, word_ids: np.ndarray, grams: np.ndarray) -> np.ndarray:
    shown = grams >= 0
    total = np.where(shown[..., None], weights["gram"][grams], 0).sum(1) / np.maximum(1, shown.sum(1))[:, None]
    return np.concatenate((weights["word"][word_ids], total.astype(np.float32)), axis=1)


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(weights: dict, inputs: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logit of each window. ``inputs``: windows × words × both directions' 3 gates; ``mask``: real words."""
    size, hidden = inputs.shape[0], weights["recur0"].shape[0]
    length = inputs.shape[1]
    states = np.zeros((length, size, 2 * hidden), np.float32)
    trail: list = [[None] * length, [None] * length]
    for way in (0, 1):
        h = np.zeros((size, hidden), np.float32)
        columns = inputs[:, :, way * 3 * hidden : (way + 1) * 3 * hidden]
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            x, m = columns[:, t], mask[:, t, None]
            a = h @ weights[f"recur{way}"]
            gates = _sigmoid(x[:, : 2 * hidden] + a[:, : 2 * hidden])
            z, r = gates[:, :hidden], gates[:, hidden:]
            n = np.tanh(x[:, 2 * hidden :] + r * a[:, 2 * hidden :])
            if keep:
                trail[way][t] = (h, z, r, n, a[:, 2 * hidden :])
            h = h + m * (1 - z) * (n - h)
            states[t, :, way * hidden : (way + 1) * hidden] = h
    look = np.tanh(states @ weights["look"])
    strength = np.where(mask.T > 0, look @ weights["ask"], -1e9)
    share = np.exp(strength - strength.max(0)) * (mask.T > 0)
    share /= np.maximum(share.sum(0), 1e-9)
    pooled = (share[..., None] * states).sum(0)
    logit = pooled @ weights["out"] + weights["bias"][0]
    return (logit, (states, look, share, pooled, trail)) if keep else logit


def backward(weights: dict, mask: np.ndarray, kept: tuple, dlogit: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the weights and of the inputs."""
    states, look, share, pooled, trail = kept
    length, size, hidden = states.shape[0], states.shape[1], weights["recur0"].shape[0]
    grads = {"out": pooled.T @ dlogit, "bias": np.array([dlogit.sum()], np.float32)}
    dpooled = dlogit[:, None] * weights["out"]
    dshare = (states * dpooled).sum(-1)
    dstrength = share * (dshare - (share * dshare).sum(0))
    grads["ask"] = np.einsum("tbk,tb->k", look, dstrength)
    dlook = dstrength[..., None] * weights["ask"] * (1 - look**2)
    grads["look"] = np.einsum("tbi,tbj->ij", states, dlook)
    dstates = share[..., None] * dpooled + dlook @ weights["look"].T
    dinputs = np.zeros((size, length, 6 * hidden), np.float32)
    for way in (0, 1):
        recur = weights[f"recur{way}"]
        grads[f"recur{way}"] = np.zeros_like(recur)
        dh = np.zeros((size, hidden), np.float32)
        for t in range(length - 1, -1, -1) if way == 0 else range(length):
            h, z, r, n, a_n = trail[way][t]
            m = mask[:, t, None]
            dh = dh + dstates[t, :, way * hidden : (way + 1) * hidden]
            dn = dh * m * (1 - z) * (1 - n * n)
            dz = dh * m * (h - n) * z * (1 - z)
            dr = dn * a_n * r * (1 - r)
            da = np.concatenate((dz, dr, dn * r), axis=1)
            dinputs[:, t, way * 3 * hidden : (way + 1) * 3 * hidden] = np.concatenate((dz, dr, dn), axis=1)
            grads[f"recur{way}"] += h.T @ da
            dh = dh * (1 - m * (1 - z)) + da @ recur.T
    return grads, dinputs


def windows(count: int, settings: Settings) -> list[int]:
    """Starts of the windows over ``count`` words; every word lies in one, most in two."""
    last = max(0, count - settings.window)
    return [*range(0, last, settings.stride), last]


def train(texts: list[str], labels: list[int], settings: Settings) -> Model:
    """Fit on whole texts; each round learns from the most toxic window of each text so far."""
    rng = np.random.default_rng(settings.seed)
    split = [split_words(t) for t in texts]
    seen = Counter(w for words in split for w in set(words))
    often = sorted((w for w, n in seen.items() if n >= settings.least_documents), key=lambda w: (-seen[w], w))
    model = Model(settings, {w: i + 1 for i, w in enumerate(often[: settings.vocabulary])})
    names = sorted(seen)
    row = {w: i + 1 for i, w in enumerate(names)}
    word_ids = np.array([0, *(model.words.get(w, 0) for w in names)])
    grams = np.concatenate((np.full((1, LETTERS), -1), trigrams(names))) if names else np.full((1, LETTERS), -1)
    h, d = settings.hidden, settings.width
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    weights = model.weights = {
        "word": 0.1 * rng.standard_normal((len(model.words) + 1, d)).astype(np.float32),
        "gram": 0.3 * rng.standard_normal((GRAMS, d)).astype(np.float32),
        "enter": draw(2 * d, 6 * h),
        "gate": np.zeros(6 * h, np.float32),
        "recur0": draw(h, 3 * h),
        "recur1": draw(h, 3 * h),
        "look": draw(2 * h, h),
        "ask": draw(h),
        "out": draw(2 * h),
        "bias": np.zeros(1, np.float32),
    }
    places = [(i, s) for i, words in enumerate(split) for s in windows(len(words), settings)]
    owner = np.array([i for i, _ in places])
    ids = np.zeros((len(places), settings.window), np.int64)
    for k, (i, s) in enumerate(places):
        part = split[i][s : s + settings.window]
        ids[k, : len(part)] = [row[w] for w in part]
    truth = np.array(labels, np.float32)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    step = 0
    best = np.array([rng.choice(np.flatnonzero(owner == i)) for i in range(len(texts))])
    steps_a_round = -(-len(texts) // settings.batch)
    for turn in range(max(settings.rounds, -(-settings.least_steps // steps_a_round))):
        if turn * steps_a_round // 50 > (turn - 1) * steps_a_round // 50:
            best = _best(_logits(weights, ids, word_ids, grams), owner, len(texts))
        order = rng.permutation(len(texts))
        for at in range(0, len(order), settings.batch):
            docs = order[at : at + settings.batch]
            part = ids[best[docs]]
            distinct, where = np.unique(part, return_inverse=True)
            where = where.reshape(part.shape)
            x = vectors(weights, word_ids[distinct], grams[distinct])
            inputs = (x @ weights["enter"] + weights["gate"])[where]
            mask = (part > 0).astype(np.float32)
            logit, kept = forward(weights, inputs, mask, keep=True)
            dlogit = ((_sigmoid(logit) - truth[docs]) / len(docs)).astype(np.float32)
            grads, dinputs = backward(weights, mask, kept, dlogit)
            per_word = np.zeros((len(distinct), 6 * h), np.float32)
            np.add.at(per_word, where.ravel(), dinputs.reshape(-1, 6 * h))
            grads["enter"], grads["gate"] = x.T @ per_word, per_word.sum(0)
            dx = per_word @ weights["enter"].T
            grads["word"] = np.zeros_like(weights["word"])
            np.add.at(grads["word"], word_ids[distinct], dx[:, :d])
            grads["gram"] = np.zeros_like(weights["gram"])
            shown = grams[distinct] >= 0
            each = dx[:, d:] / np.maximum(1, shown.sum(1))[:, None]
            rows, columns = np.nonzero(shown)
            np.add.at(grads["gram"], grams[distinct][rows, columns], each[rows])
            step += 1
            for k, g in grads.items():
                first, second = moments[k]
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                weights[k] -= settings.rate * (first / (1 - 0.9**step)) / (
                    np.sqrt(second / (1 - 0.999**step)) + 1e-8
                )
    logits = _logits(weights, ids, word_ids, grams)
    model.wordless = min(0.49, float(truth.mean()))
    _calibrate(model, logits[_best(logits, owner, len(texts))].astype(float), truth)
    return model


def _logits(weights: dict, ids: np.ndarray, word_ids: np.ndarray, grams: np.ndarray) -> np.ndarray:
    found = []
    projected = [
        vectors(weights, word_ids[a : a + 8192], grams[a : a + 8192]) @ weights["enter"] + weights["gate"]
        for a in range(0, len(word_ids), 8192)
    ]
    projected = np.concatenate(projected)
    for at in range(0, len(ids), 2048):
        part = ids[at : at + 2048]
        found.append(forward(weights, projected[part], (part > 0).astype(np.float32)))
    return np.concatenate(found)


def _best(logits: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """The window with the highest logit of each text; windows lie in the order of texts."""
    order = np.lexsort((-logits, owner))
    return order[np.searchsorted(owner, np.arange(count))]


def _calibrate(model: Model, logits: np.ndarray, truth: np.ndarray) -> None:
    """Fit scale and shift of the texts' logits; each class weighs the same."""
    centre, spread = logits.mean(), logits.std() + 1e-6
    x, scale, shift = (logits - centre) / spread, 1.0, 0.0
    weight = np.where(truth > 0, 0.5 / truth.sum(), 0.5 / (1 - truth).sum())
    for _ in range(300):
        error = (_sigmoid(scale * x + shift) - truth) * weight
        scale, shift = scale - 4 * ((error * x).sum() + 1e-3 * scale), shift - 4 * error.sum()
    scale = max(scale, 1e-3)
    model.scale, model.shift = scale / spread, shift - scale * centre / spread


class Scorer:
    """Scores texts in a worker; remembers the network's input of each word."""

    def __init__(self, model: Model):
        self._model, self._rows = model, {}
        self._table = np.zeros((1, 6 * model.settings.hidden), np.float32)

    def _learn(self, new: list[str]) -> None:
        weights, parts = self._model.weights, [self._table]
        for at in range(0, len(new), 8192):
            some = new[at : at + 8192]
            known = np.array([self._model.words.get(w, 0) for w in some])
            parts.append(vectors(weights, known, trigrams(some)) @ weights["enter"] + weights["gate"])
        base = len(self._table)
        self._rows.update((w, base + i) for i, w in enumerate(new))
        self._table = np.concatenate(parts)

    def score(self, texts: list[str | None]) -> list[float]:
        settings = self._model.settings
        split = [split_words(t) for t in texts]
        words = set().union(*split)
        new = words.difference(self._rows)
        if len(self._rows) + len(new) > REMEMBERED:
            self._rows, self._table, new = {}, self._table[:1], words
        if new:
            self._learn(sorted(new))
        owner, parts = [], []
        for i, part in enumerate(split):
            ids = np.fromiter(map(self._rows.__getitem__, part), np.int64, len(part))
            if len(ids) < settings.window:
                ids = np.concatenate((ids, np.zeros(settings.window - len(ids), np.int64)))
            starts = np.array(windows(len(part), settings))
            parts.append(ids[starts[:, None] + np.arange(settings.window)])
            owner.append(np.full(len(starts), i))
        ids, owner = np.concatenate(parts), np.concatenate(owner)
        best = np.full(len(texts), -np.inf)
        for at in range(0, len(ids), 1024):
            part = ids[at : at + 1024]
            logits = forward(self._model.weights, self._table[part], (part > 0).astype(np.float32))
            np.maximum.at(best, owner[at : at + 1024], logits)
        scores = _sigmoid(self._model.scale * best + self._model.shift)
        return np.where([len(part) > 0 for part in split], scores, self._model.wordless).tolist()


def sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[list[str], list[int]]:
    """Whole texts and labels of the bounded training sample.

    Labelled ids whose ``crc32`` leaves a remainder modulo 5 are drawn by hash, at most
    ``sample_toxic`` and ``sample_clean`` of them; other ids never reach the training.
    """
    rows = labels.filter("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long"), "toxic")
    rows = rows.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = F.xxhash64("doc_id", F.lit(settings.seed))
    chosen = None
    for label, bound in ((1, settings.sample_toxic), (0, settings.sample_clean)):
        part = rows.filter(F.col("toxic") == label).orderBy(drawn, "doc_id").limit(bound)
        chosen = part if chosen is None else chosen.union(part)
    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
    once = found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    collected = sorted(once.collect(), key=lambda r: r["doc_id"])
    return [r["text"] or "" for r in collected], [int(r["toxic"]) for r in collected]


def toxicity(
    docs: DataFrame, labels: DataFrame, settings: Settings | None = None, column: str = "toxicity_score"
) -> DataFrame:
    """The columns of ``docs`` with the score (0 to 1) of every row in ``column``, which may not exist before.

    A text without words, a null one too, scores the share of toxic texts in the training
    sample, or 0.49 if that is higher. Texts are read whole.
    Without labelled documents of both kinds every score is 0. Repeated rows get the
    same score each; columns of ``docs`` other than the text are carried, not read.
    """
    settings = settings or Settings()
    texts, marks = sample(docs, labels, settings)
    if len(set(marks)) < 2:
        return docs.withColumn(column, F.lit(0.0))
    sent = Sent(docs.sparkSession, Scorer(train(texts, marks, settings)))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = sent.value
        for batch in batches:
            found: list[float] = []
            for at in range(0, len(batch), 128):
                found += scorer.score(texts_of(batch.iloc[at : at + 128]))
            yield pd.Series(found, dtype="float64")

    score = F.pandas_udf(run, "double")
    return docs.withColumn(column, score(F.col("text").cast("string")))


def held_out() -> Column:
    """Whether a row's ``doc_id`` belongs to the fifth that is never trained on; null ids do not."""
    text = F.col("doc_id").cast("string").cast("binary")
    return F.coalesce(F.pmod(F.crc32(text), F.lit(5)) == 0, F.lit(False))
