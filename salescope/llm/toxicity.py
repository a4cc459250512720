"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character 3- and 4-grams, each hashed to a row of an
embedding table; its vector is the bag's mean.  A window of
consecutive words is the mean of their vectors, and a linear softmax over it
gives two classes.  Table and softmax are trained jointly in numpy on labelled
documents.  Labels belong to documents, so the first steps train on random
windows and the later ones on each document's highest-scoring window; a
document's score comes from its two highest windows that don't overlap,
calibrated on the training documents.
Unseen misspellings score by the n-grams that they share with seen words.

The classes' difference is linear in the table, so scoring needs one number
per table row: that vector, whose size is fixed, is all that workers get.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from salescope.llm.common import begin, latest, prepare, text_steps, whole_text

BUCKETS, DIM, WINDOW = 1 << 17, 8, 3
#: The training sample: at most so many documents of each label, in hash order of their ids, of at most so many characters.
TOXIC_DOCS, OTHER_DOCS, SAMPLE_CHARS = 1500, 4500, 12_000
#: Random windows of a document; steps on random windows, then on highest ones; windows of a step; step size; weight decay.
RANDOM_WINDOWS = 2
RANDOM_STEPS, TOP_STEPS, STEP, RATE, DECAY = 18, 36, 2048, 300.0, 1e-6
THRESHOLD = 0.3
PUNCTUATION = ".,;:!?\"'()[]{}<>«»“”„…"
#: Words whose numbers a worker keeps; words looked up at once, characters of new words worked out at once.
CACHE_WORDS, NEW_WORDS, MEAN_CHARS = 300_000, 100_000, 1 << 18


def subwords(token: str) -> list[int]:
    """Table rows of a word's character n-grams."""
    word = f"<{token.strip(PUNCTUATION).lower()}>"
    grams = [*(word[i : i + n] for n in (3, 4) for i in range(len(word) - n + 1))] or [word]
    return [zlib.crc32(g.encode()) % BUCKETS for g in grams]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ 0xEDB88320, table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def _gram_crcs(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of the UTF-8 bytes of the 3 and of the 4 characters from each place on."""
    size = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0], np.uint32)[size] | chars >> (6 * (size - 1)).astype(np.uint32)
    far = [(n, at := np.flatnonzero(size > n), 0x80 | chars[at] >> (6 * (size[at] - 1 - n)).astype(np.uint32) & 0x3F) for n in (1, 2, 3)]
    state, out = np.full(len(chars), 0xFFFFFFFF, np.uint32), []
    for j in range(4):
        n = max(0, len(chars) - j)
        state = state[:n]
        state = _CRC[(state ^ lead[j:]) & 0xFF] ^ state >> 8
        for _, at, byte in far:
            late = int(np.searchsorted(at, j))
            own = at[late:] - j
            state[own] = _CRC[(state[own] ^ byte[late:]) & 0xFF] ^ state[own] >> 8
        out.append(~state)
    return out[2], out[3]


def word_means(rows: np.ndarray, tokens: list[str]) -> np.ndarray:
    """``rows[subwords(token)].mean()`` of each token, to the last bit."""
    words = [f"<{t.strip(PUNCTUATION).lower()}>" for t in tokens]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out, ends, low = np.empty(len(words)), np.cumsum(lengths), 0
    while low < len(words):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + MEAN_CHARS, side="right")))
        three, four = _gram_crcs(np.frombuffer("".join(words[low:high]).encode("utf-32-le"), np.uint32))
        three, four = rows[three % BUCKETS], rows[four % BUCKETS]
        size = lengths[low:high]
        starts, by = ends[low:high] - size - before, np.argsort(size, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(size[by], prepend=-1)), len(by))
        for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            own, n = by[a:b], int(size[by[a]])
            if n < 3:  # no gram: the word itself
                out[low + own] = rows[zlib.crc32(words[low + own[0]].encode()) % BUCKETS]
            else:
                at = starts[own][:, None]
                out[low + own] = np.concatenate([three[at + np.arange(n - 2)], four[at + np.arange(n - 3)]], axis=1).mean(axis=1)
        low = high
    return out


@dataclass
class Model:
    rows: np.ndarray  # one number per table row: its part of the classes' difference
    slopes: tuple[float, float]  # calibration of a document's two highest windows
    shift: float

    def scorer(self):
        """text -> score, keeping the numbers of recent words; ``scorer().many`` takes a list of texts."""
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """The number of each word; a step's new words are worked out together."""
        out, cache = np.empty(len(tokens)), self.cache
        for low in range(0, len(tokens), NEW_WORDS):
            part = tokens[low : low + NEW_WORDS]
            new = set(part).difference(cache)
            if len(cache) + len(new) > CACHE_WORDS:
                cache.clear()
                new = set(part)
            new = list(new)
            cache.update(zip(new, word_means(self.model.rows, new).tolist(), strict=True))
            out[low : low + len(part)] = np.fromiter(map(cache.__getitem__, part), float, len(part))
        return out

    def many(self, texts: list[str]) -> list[float]:
        tokens = [t.split() for t in texts]
        ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
        values = self.numbers([*chain.from_iterable(tokens)])
        top = np.array([two_highest(v) for v in np.split(values, ends[:-1])]).reshape(-1, 2) if texts else np.empty((0, 2))
        (first, second), shift = self.model.slopes, self.model.shift
        return (1 / (1 + np.exp(-np.clip(first * top[:, 0] + second * top[:, 1] + shift, -60, 60)))).tolist()

    def __call__(self, text: str) -> float:
        return self.many([text])[0]


def highest(values: np.ndarray) -> tuple[float, int]:
    """Mean and start of the window with the highest mean; (0, 0) without words."""
    if len(values) <= WINDOW:
        return (float(values.mean()) if len(values) else 0.0), 0
    sums = np.cumsum(np.concatenate(([0.0], values)))
    means = (sums[WINDOW:] - sums[:-WINDOW]) / WINDOW
    at = int(means.argmax())
    return float(means[at]), at


def two_highest(values: np.ndarray) -> tuple[float, float]:
    """Mean of the highest window and of the highest that doesn't overlap it (0 without one)."""
    first, at = highest(values)
    rest = [highest(part)[0] for part in (values[:at], values[at + WINDOW :]) if len(part) >= WINDOW]
    return first, max(rest, default=0.0)


class Trainer:
    """Joint training by gradient steps of the embedding table and the softmax."""

    def __init__(self, texts: Iterable[str], labels: np.ndarray, seed: int = 7):
        self.rng, self.labels, vocabulary = np.random.default_rng(seed), labels, {}
        self.docs = [np.array([vocabulary.setdefault(t, len(vocabulary)) for t in text.split()], dtype=np.int32) for text in texts]
        bags, sizes = array("i"), array("i")  # all words' rows end to end: the driver holds four bytes for each
        for word in vocabulary or [""]:
            own = subwords(word)
            bags.extend(own)
            sizes.append(len(own))
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.bags = np.frombuffer(bags, np.int32)
        self.table = self.rng.normal(0, 0.1, (BUCKETS, DIM))
        self.soft = np.stack([-np.ones(DIM), np.ones(DIM)]) * 0.3 + self.rng.normal(0, 0.1, (2, DIM))
        self.bias = np.zeros(2)

    def word_numbers(self) -> np.ndarray:
        row = self.table @ (self.soft[1] - self.soft[0])
        return np.add.reduceat(row[self.bags], self.starts) / self.sizes

    def windows(self, top: bool) -> tuple[np.ndarray, np.ndarray]:
        """Two windows per document (word numbers, -1 for none) and their labels."""
        values = self.word_numbers() if top else None
        out, labels = [], []
        for doc, label in zip(self.docs, self.labels, strict=True):
            if not len(doc):
                continue
            last = max(0, len(doc) - WINDOW)
            places = self.rng.integers(last + 1, size=2 if top else RANDOM_WINDOWS).tolist()
            if top:
                places[0] = highest(values[doc])[1]
            for at in places:
                row = np.full(WINDOW, -1)
                part = doc[at : at + WINDOW]
                row[: len(part)] = part
                out.append(row)
                labels.append(label)
        return np.array(out).reshape(-1, WINDOW), np.array(labels, dtype=np.int64)

    def step(self, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        used = windows >= 0
        words, at = np.unique(windows[used], return_inverse=True)
        sizes = self.sizes[words]
        firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        subs = self.bags[np.repeat(self.starts[words] - firsts, sizes) + np.arange(sizes.sum())]
        vectors = np.add.reduceat(self.table[subs], firsts) / sizes[:, None]
        counts = used.sum(1)
        ends = np.cumsum(counts)
        hidden = np.add.reduceat(vectors[at], ends - counts) / counts[:, None]
        logits = hidden @ self.soft.T + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(labels)), labels] -= 1
        p *= (weights / weights.sum())[:, None]
        d_hidden = (p @ self.soft) / counts[:, None]
        order = np.argsort(at, kind="stable")
        d_words = np.add.reduceat(np.repeat(d_hidden, counts, axis=0)[order], np.searchsorted(at[order], np.arange(len(words)))) / sizes[:, None]
        order = np.argsort(subs, kind="stable")
        rows, first = np.unique(subs[order], return_index=True)
        self.table[rows] -= RATE * (np.add.reduceat(np.repeat(d_words, sizes, axis=0)[order], first) + DECAY * self.table[rows])
        self.soft -= p.T @ hidden
        self.bias -= 0.1 * p.sum(0)

    def train(self) -> Model:
        for top, steps in ((False, RANDOM_STEPS), (True, TOP_STEPS)):
            while steps > 0:
                windows, labels = self.windows(top)
                weights = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
                order = self.rng.permutation(len(labels))
                for i in range(0, len(order), STEP)[:steps]:
                    part = order[i : i + STEP]
                    self.step(windows[part], labels[part], weights[part])
                    steps -= 1
                if not len(order):
                    break
        rows = (self.table @ (self.soft[1] - self.soft[0])).astype(np.float32)
        values = self.word_numbers()
        return Model(rows, *calibrate(np.array([two_highest(values[d]) for d in self.docs]).reshape(-1, 2), self.labels))


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[tuple[float, float], float]:
    """Slopes (none negative) and shift of a logistic curve through the labels."""
    if not len(margins):
        return (1.0, 0.0), 0.0
    scale = np.maximum(1e-6, margins.std(0))
    x, a, b = margins / scale, np.array([1.0, 0.0]), 0.0
    for _ in range(4000):
        g = 1 / (1 + np.exp(-np.clip(x @ a + b, -60, 60))) - labels
        a, b = np.maximum(0.0, a - (x.T @ g / len(g) + 1e-4 * a)), b - float(g.mean())
    return tuple((a / scale).tolist()), float(b)


def held_out(doc_id: Column) -> Column:
    """Whether labels of this row are kept from training; a null id's are not."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a bounded sample: per label the first ids in hash order."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    short = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text")).where(F.char_length("text") <= SAMPLE_CHARS)
    parts = [known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for label, n in ((1, TOXIC_DOCS), (0, OTHER_DOCS))]
    ids = parts[0].unionByName(parts[1])  # at most TOXIC_DOCS + OTHER_DOCS rows of two numbers
    rows = short.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    labelled = np.array([int(r.toxic > 0) for r in rows], dtype=np.int64)
    rows.reverse()
    trainer = Trainer((rows.pop().text for _ in labelled), labelled)  # a text goes once its words have numbers
    return trainer.train()


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a last column ``toxicity_score``; a null text counts as empty."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")

    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        score = latest("toxicity", name, model.scorer)
        for step in text_steps(batches, f"c{at}"):
            scores = pa.array(score.many([t or "" for t in step.column(at).to_pylist()]), pa.float64())
            yield pa.RecordBatch.from_arrays([*step.columns, scores], names=[f"c{i}" for i in range(len(step.columns))] + ["toxicity_score"])

    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # names may clash
    scored = plain.mapInArrow(run, StructType([*plain.schema.fields, StructField("toxicity_score", DoubleType())]))
    return scored.toDF(*names, "toxicity_score")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    A null text counts as empty; an empty text scores as a window without
    evidence.  A null doc_id stays null and is not held out; repeated rows give
    repeated results; an empty table gives no rows; without labels the table is
    untrained and every score lies near 0.5.  Only text is an input of a score.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    scored = with_score(rows, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity_score").alias("score"), (F.col("toxicity_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    scored = with_score(docs, fit(docs, labels))
    return scored.where(F.col("toxicity_score") < THRESHOLD).drop("toxicity_score")
