"""Toxicity: a support vector machine on a subsequence string kernel.

Two words are alike if they share subsequences of three characters, each weighed
down by the span it covers, so ``idxiot``, ``i-d-i-o-t`` and ``idiot`` are close
though they share few substrings.  Words are compared with a bounded set of
landmark words (Nystroem): with K the landmarks' kernel matrix, k(x) K^(-1/2) are
the features of word x, and a linear machine is trained on them.  Because the
kernel is a sum over subsequences, the trained machine folds into one table of a
weight per subsequence: scoring a word needs no landmark any more, and its cost
does not depend on their number.

Labels belong to documents, but only some sentences of a toxic document are
toxic.  Distinct sentences inherit their document's label (a sentence that is
also in a clean document is clean), and words that occur in sentences of toxic
documents far more often than in clean ones witness toxic sentences: they are the
positive examples, words of clean sentences the negative ones, to which the clean
words that score highest are added in a second round.  Counting distinct
sentences keeps groups of copies from looking like evidence.

A document's score is that of its most toxic word; runs of single letters count
as one word.  The scores of a part of the sample set aside are turned into
probabilities (Platt).  Training uses a bounded sample of labelled rows
(``MAX_TRAINING_DOCS``); scoring covers every word of every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidylake.llm.common import checkpointed, hash_key, ref

MAX_TRAINING_DOCS = 20_000
CALIBRATION_PERCENT = 25
MAX_POSITIVE, MAX_NEGATIVE, MAX_POOL, MAX_HARD = 2_000, 10_000, 60_000, 5_000
LANDMARKS = 320
MIN_SENTENCES, MIN_ODDS = 3, 25.0
# the most frequent witnesses also count with one character put in
VARIED, VARIANT_WEIGHT = 200, 0.2
SPAN, DECAY = 6, 0.85
REGULAR = 1e-4
THRESHOLD = 0.7
REMEMBERED_WORDS = 200_000  # of under 64 characters: at most 60 MB
GROUP_CHARS = 2_000_000
WINDOW = 48  # longer words are read in overlapping windows

# Look-alikes of letters inside a word.
LOOKALIKES = str.maketrans("0134578@$!|", "oieastbasii")
_INNER = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])")
_OTHER = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r"[.!?\n]+")
CLASSES = 64
_START, _END = 62, 63
# pairs of later places of a subsequence that begins at place 0
_PLACES = [(i, j) for i in range(1, SPAN) for j in range(i + 1, SPAN)]


def unit(word: str) -> str:
    """A word's letters and digits in lower case, look-alikes undone."""
    word = word.lower()
    if not word.isalnum() or not word.isalpha():
        word = _OTHER.sub("", _INNER.sub(lambda m: m.group().translate(LOOKALIKES), word))
    return word


def _codes(word: str) -> list[int]:
    # a-z are 1 to 26; all other characters share 27 to 61 by code point
    return [_START, *[o - 96 if 97 <= (o := ord(c)) <= 122 else 27 + o % 35 for c in word], _END]


def features(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subsequences of all units: (unit, subsequence, weight), each pair once."""
    rows = [_codes(u) for u in units]
    length = np.array([len(r) for r in rows], np.int64)
    width = int(length.max(initial=0)) + SPAN
    grid = np.zeros((len(rows), width), np.int64)
    grid[np.arange(width) < length[:, None]] = np.concatenate(rows) if rows else []
    keys, weights = [], []
    base = np.arange(len(rows), dtype=np.int64)[:, None] * CLASSES**3
    for i, j in _PLACES:
        a, b, c = grid[:, :width - SPAN], grid[:, i:width - SPAN + i], grid[:, j:width - SPAN + j]
        keep = c > 0
        key = base + (a * CLASSES + b) * CLASSES + c
        keys.append(key[keep])
        weights.append(np.full(len(keys[-1]), DECAY ** (j + 1)))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key)
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    key, weight = key[first], np.add.reduceat(weight, first)
    return key // CLASSES**3, key % CLASSES**3, weight


def _unit_vectors(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row, sub, weight = features(units)
    norm = np.sqrt(np.bincount(row, weight**2, len(units)))
    return row, sub, weight / norm[row]


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised kernel of all units of ``a`` with all of ``b``; ``b`` is short."""
    row, sub, weight = _unit_vectors(b)
    used, column = np.unique(sub, return_inverse=True)
    dense = np.zeros((len(used), len(b)), np.float32)
    dense[column, row] = weight
    place = np.full(CLASSES**3, -1, np.int32)
    place[used] = np.arange(len(used))
    out = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, len(a), 500):
        part = a[at:at + 500]
        row, sub, weight = _unit_vectors(part)
        seen = place[sub] >= 0
        full = np.zeros((len(part), len(used)), np.float32)
        full[row[seen], place[sub[seen]]] = weight[seen]
        out[at:at + len(part)] = full @ dense
    return out


def train_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30):
    """Linear support vector machine (squared hinge, Newton steps); the last
    coordinate is the bias.  Rows are taken in pieces, to bound the memory."""
    w = np.zeros(x.shape[1] + 1)
    ridge = REGULAR * np.eye(len(w)) * weight.sum()
    for _ in range(rounds):
        gradient, curve = ridge @ w, ridge.copy()
        for at in range(0, len(x), 2000):
            part = np.hstack([x[at:at + 2000], np.ones((len(x[at:at + 2000]), 1))])
            side, load = y[at:at + 2000], weight[at:at + 2000]
            margin = 1 - side * (part @ w)
            on = margin > 0
            part, side, load, margin = part[on], side[on], load[on], margin[on]
            gradient -= part.T @ (load * side * margin)
            curve += (part * load[:, None]).T @ part
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """A weight per subsequence, the bias, and the line that turns a document's
    highest word score into a probability."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table.astype(np.float32), float(bias)
        self.slope, self.shift = 1.0, 0.0
        self.known: dict[str, float] | None = None

    def __getstate__(self):
        return {**self.__dict__, "known": None}

    def of_units(self, units: list[str]) -> np.ndarray:
        row, sub, weight = features(units)
        norm = np.sqrt(np.bincount(row, weight**2, len(units)))
        total = np.bincount(row, weight * self.table[sub], len(units))
        return total / np.maximum(norm, 1e-12) + self.bias

    def of_words(self, words: list[str]) -> np.ndarray:
        """Scores of words; long words count by their highest window."""
        units, owner = [], []
        for i, word in enumerate(words):
            u = unit(word)
            parts = [u] if len(u) <= WINDOW else [
                u[at:at + WINDOW] for at in range(0, len(u) - WINDOW // 2, WINDOW // 2)]
            units += parts
            owner += [i] * len(parts)
        out = np.full(len(words), -np.inf)
        # equal lengths together: a batch is as wide as its longest unit
        order = sorted(range(len(units)), key=lambda i: len(units[i]))
        for at in range(0, len(order), 2000):
            part = order[at:at + 2000]
            np.maximum.at(out, [owner[i] for i in part], self.of_units([units[i] for i in part]))
        return out

    def raw(self, texts: list[str]) -> np.ndarray:
        """Highest word score of each text (without words: that of an empty word)."""
        if self.known is None:
            self.known = {}
        known, out = self.known, np.zeros(len(texts))
        empty = float(self.of_units([""])[0])
        split = [t.split() for t in texts]
        missing = list({w for words in split for w in words if w not in known})
        single = {w for w in missing if len(w) == 1}
        short = [w for w in missing if len(w) < 64]
        found = dict(zip(missing, self.of_words(missing).tolist()))
        for w in single:
            found[w] = _LETTER  # marks single characters; they count in runs
        known.update((w, found.pop(w)) for w in short)
        for i, words in enumerate(split):
            if not words:
                out[i] = empty
                continue
            if found:  # words too long to remember
                scores = np.array([known[w] if w in known else found[w] for w in words])
            else:
                scores = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
            letters = scores == _LETTER
            best = scores.max() if not letters.all() else empty
            if letters.any():
                joined = _runs(words, letters)
                if joined:
                    best = max(best, self.of_words(joined).max())
            out[i] = best
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        return out

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -500, 500)))


_LETTER = -1e300


def _runs(words: list[str], letters: np.ndarray) -> list[str]:
    """Runs of at least three single characters, each as one word."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], letters.astype(np.int8), [0]])))
    return ["".join(words[a:b]) for a, b in zip(edge[::2], edge[1::2]) if b - a >= 3]


def _grouped(texts: Iterator[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _scores(df: DataFrame, model: Model, text_col: str) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for series in batches:
            parts = [model.raw(g) for g in _grouped(t or "" for t in series)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(ref(text_col))


def _sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``sentence`` (hash), ``toxic`` and the distinct units of each sentence."""
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1)):
            hashes, units = [], []
            for sentence in _SENTENCE.split(text.as_py() or ""):
                if words := sentence.split():
                    hashes.append(xxhash.xxh3_64_intdigest(" ".join(words).encode()) >> 1)
                    units.append(sorted({u for w in words if 3 <= len(u := unit(w)) <= WINDOW}))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()),
                 pa.array([label.as_py()] * len(hashes), pa.int32()),
                 pa.array(units, pa.list_(pa.string()))], names=["sentence", "toxic", "units"])


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id's text leaves 1 mod 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic, part`` of about ``MAX_TRAINING_DOCS`` labelled documents,
    chosen by a hash of the id, none of them held out."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")).withColumn("key", hash_key(1, F.col("doc_id")))
    share = min(1.0, MAX_TRAINING_DOCS / max(1, usable.count()))
    chosen = usable.where(F.col("key") < F.lit(share * 2.0**60))
    texts = docs.select("doc_id", "text").where("text is not null")
    # the sample's size is bounded by MAX_TRAINING_DOCS
    return checkpointed(texts.join(F.broadcast(chosen), "doc_id").select(
        "text", "toxic", (hash_key(2, F.col("doc_id")) % 100).alias("part")))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from the labelled ``docs``; None where a class is missing."""
    sample = training_sample(docs, labels)
    learn = sample.where(F.col("part") >= CALIBRATION_PERCENT)
    sentences = learn.select("text", "toxic").mapInArrow(
        _sentences, "sentence long, toxic int, units array<string>").groupBy("sentence").agg(
        F.min("toxic").alias("toxic"), F.max("units").alias("units"))
    counted = checkpointed(sentences.select("toxic", F.explode("units").alias("unit")).groupBy(
        "unit").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")))
    totals = counted.agg(F.sum("bad"), F.sum("good")).first()
    if not totals[0] or not totals[1]:
        return None
    odds = (F.col("bad") / F.lit(float(totals[0]))) / ((F.col("good") + 0.5) / F.lit(float(totals[1])))
    rated = counted.withColumn("odds", odds)
    positive = rated.where((F.col("bad") >= MIN_SENTENCES) & (F.col("odds") >= MIN_ODDS)).orderBy(
        F.desc("bad"), "unit").limit(MAX_POSITIVE).collect()
    if not positive:  # few labels: the most telling words
        positive = rated.where(F.col("odds") > 1).orderBy(F.desc("odds"), "unit").limit(50).collect()
    clean = rated.where((F.col("good") > 0) & (F.col("odds") < 2)).select("unit", "good").orderBy(
        F.xxhash64("unit"), "unit").limit(MAX_POOL).toArrow()
    pool = dict(zip(clean["unit"].to_pylist(), clean["good"].to_pylist()))
    if not positive or not pool:
        return None
    model = fit({r["unit"]: r["bad"] for r in positive}, pool)
    _calibrate(model, sample.where(F.col("part") < CALIBRATION_PERCENT))
    return model


def varied(word: str) -> list[str]:
    """The word with a character put in at two inner places."""
    places = sorted({max(1, len(word) // 3), max(1, 2 * len(word) // 3)})
    return [word[:at] + "xuz"[(len(word) + at) % 3] + word[at:] for at in places]


def fit(witnesses: dict[str, int], clean: dict[str, int]) -> Model:
    """The machine for witness words and clean words with their numbers of
    sentences, both most important first."""
    pool = list(clean)
    weights = dict.fromkeys(witnesses, 0.0)
    for i, (word, n) in enumerate(witnesses.items()):
        weights[word] += n
        for other in varied(word) if i < VARIED else ():
            if other not in clean:
                weights[other] = weights.get(other, 0.0) + VARIANT_WEIGHT * n
    words, weight = list(weights), np.array(list(weights.values()))
    negative = pool[:MAX_NEGATIVE]
    half = min(LANDMARKS // 2, len(witnesses))
    landmarks = words[:half] + negative[:LANDMARKS - half]
    for _ in range(2):
        values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
        good = values > 1e-6
        root = vectors[:, good] / np.sqrt(values[good])
        x = kernel(words + negative, landmarks) @ root.astype(np.float32)
        y = np.array([1.0] * len(words) + [-1.0] * len(negative))
        less = np.sqrt([float(clean[u]) for u in negative])
        w = train_machine(x, y, np.concatenate([weight / weight.sum(), less / less.sum()]))
        beta = root @ w[:-1]
        table = np.zeros(CLASSES**3)
        row, sub, value = _unit_vectors(landmarks)
        np.add.at(table, sub, beta[row] * value)
        model = Model(table, w[-1])
        # second round: the clean words that look most toxic, as examples and landmarks
        scored = model.of_words(pool)
        hardest = [pool[i] for i in np.argsort(-scored, kind="stable")[:MAX_HARD]]
        negative = list(dict.fromkeys(pool[:MAX_NEGATIVE] + hardest))
        others = list(dict.fromkeys(hardest[:LANDMARKS // 4] + pool[:LANDMARKS]))
        landmarks = words[:half] + others[:LANDMARKS - half]
    return model


def _calibrate(model: Model, sample: DataFrame) -> None:
    """Platt's line through the bounded sample's document scores."""
    found = sample.select("toxic", _scores(sample, model, "text").alias("raw")).toPandas()
    y, x = found["toxic"].to_numpy(), found["raw"].to_numpy()
    bad, good = int((y == 1).sum()), int((y == 0).sum())
    if not bad or not good:
        model.slope, model.shift = 4.0, 0.0
        return
    t = np.where(y == 1, (bad + 1) / (bad + 2), 1 / (good + 2))
    a = np.array([1.0, 0.0])
    data = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(data @ a, -30, 30)))
        hessian = (data * (p * (1 - p))[:, None]).T @ data + 1e-4 * np.eye(2)
        step = np.linalg.solve(hessian, data.T @ (p - t) + 1e-4 * a)
        a -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    model.slope, model.shift = max(a[0], 1e-3), a[1]


def toxicity(df: DataFrame, model: Model | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``df`` with ``held_out, score, predicted`` for every row.

    ``score`` is the probability of label 1 by the whole text (null counts as
    empty; an empty text has the score of an empty word); without a model, when
    the labels lack a class, it is 0.  ``predicted`` is 1 from ``THRESHOLD`` on.
    Repeated rows score alike; a null id is not held out; input columns named like
    an output column are replaced.
    """
    out = ("held_out", "score", "predicted")
    own = [ref(c) for c in df.columns if c not in out]
    if model is None:
        score = F.lit(0.0)
    else:
        line = F.lit(float(model.slope)) * _scores(df, model, text_col) + F.lit(float(model.shift))
        score = 1 / (1 + F.exp(-F.greatest(F.least(line, F.lit(500.0)), F.lit(-500.0))))
    scored = df.select(*own, held_out(ref(id_col)).alias("held_out"), score.alias("score"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
