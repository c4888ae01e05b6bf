"""Quality classifier: a factorisation machine.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

The bracket is the sum-of-squares identity: all pairwise interactions, of rank
``RANK``, in time linear in the features of a text.  Features x: hashed
distinct words (each 1 / square root of their number), structure statistics
of the text and its length, each as one bin of ``BINS`` (their borders are
quantiles of the training sample).  The label, language, source and id never
enter.

Training rows are a bounded sample: at most ``TRAIN_ROWS`` labelled rows that
are not held out, chosen by the hash of their id; their features (not their
texts) come to the driver, some hundred numbers a row.  Scoring maps over all
rows with the broadcast model (fixed size) and shuffles nothing.

Defined cases: null text counts as empty and is scored from its statistics;
texts are scored whole; rows with a null id are scored and never held out;
repeated rows are scored alike, and learnt from once per label row; without
labelled rows of both classes every score is the share of label 1 among them
(0.5 without any); other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, functions as F

from martlane.llm.common import BATCH_ROWS, WordCache, held_out, keep_rows, labelled_sample, map_rows

TRAIN_ROWS = 12_000
BUCKETS = 1 << 14
RANK = 6
BINS = 8
EPOCHS = 6

# Byte classes of the structure statistics.
_CLASS = np.full(256, 6, np.uint8)                      # other signs
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[32, 9, 11, 12, 13]] = 3
_CLASS[10] = 4
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 5
_CLASS[128:] = 7

STATISTICS = ("bytes", "lower", "upper", "digits", "spaces", "lines", "points", "signs", "beyond_ascii", "words",
              "distinct", "repeated_next", "word_length", "upper_words", "line_length", "distinct_lines")


def statistics(text: str, words: list[str]) -> list[float]:
    """Structure of a text, in the order of STATISTICS; shares where not a size."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(len(data), 1)
    share = np.bincount(_CLASS[data], minlength=8) / n
    count = max(len(words), 1)
    lines = text.split("\n")
    return [np.log1p(len(data)), share[0], share[1], share[2], share[3], share[4], share[5], share[6], share[7],
            np.log1p(len(words)), len(set(words)) / count,
            sum([a == b for a, b in zip(words, words[1:])]) / count, len(data) / count,
            sum(map(str.isupper, words)) / count, np.log1p(len(data) / len(lines)), len(set(lines)) / len(lines)]


def bucket_cache() -> WordCache:
    """word -> bucket of its lower-cased letters and digits (-1: none)."""
    def bucket(word):
        core = "".join(filter(str.isalnum, word.lower()))
        return zlib.crc32(core.encode("utf-8", "replace")) % BUCKETS if core else -1
    return WordCache(bucket)


def word_buckets(words: list[str], cache: WordCache) -> np.ndarray:
    found = set(map(cache.__getitem__, set(words)))
    found.discard(-1)
    return np.fromiter(found, np.int64, len(found))


class Machine:
    """The parameters: bin borders, w0, w, v.  Features BUCKETS and above are bins."""

    def __init__(self, borders: np.ndarray, base: float):
        size = BUCKETS + len(STATISTICS) * BINS
        self.borders, self.base = borders, base
        self.w0 = 0.0
        self.w = np.zeros(size, np.float32)
        self.v = np.random.default_rng(3).normal(0, 0.02, (size, RANK)).astype(np.float32)
        self.constant: float | None = None

    def bins(self, stats: np.ndarray) -> np.ndarray:
        """(rows, statistics) -> feature numbers."""
        out = np.empty(stats.shape, np.int64)
        for j in range(stats.shape[1]):
            out[:, j] = BUCKETS + j * BINS + np.searchsorted(self.borders[j], stats[:, j], side="right")
        return out

    def features(self, stats: np.ndarray, buckets: list[np.ndarray]):
        """Rows as (feature numbers, values, first position of each row)."""
        index, value, start, at = [], [], [], 0
        for bins, words in zip(self.bins(stats), buckets):
            start.append(at)
            index += [bins, words]
            value += [np.ones(len(bins), np.float32),
                      np.full(len(words), 1 / np.sqrt(max(len(words), 1)), np.float32)]
            at += len(bins) + len(words)
        return np.concatenate(index), np.concatenate(value), np.array(start)

    def margin(self, index, value, start):
        """(margins, sums of v x): linear in the number of features."""
        vx = self.v[index] * value[:, None]
        sums = np.add.reduceat(vx, start)
        squares = np.add.reduceat(vx * vx, start)
        linear = np.add.reduceat(self.w[index] * value, start)
        return self.w0 + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, stats: np.ndarray, buckets: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(stats), self.constant)
        z = self.margin(*self.features(stats, buckets))[0].astype(float)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(stats: np.ndarray, buckets: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Adagrad on the logistic loss over shuffled batches, with weight decay."""
    if not len(labels) or labels.min() == labels.max():
        machine = Machine(np.zeros((len(STATISTICS), BINS - 1)), 0.5)
        machine.constant = float(labels.mean()) if len(labels) else 0.5
        return machine
    borders = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    machine = Machine(borders, float(labels.mean()))
    machine.w0 = float(np.log(machine.base / (1 - machine.base)))
    gw, gv = np.full(machine.w.shape, 1e-4, np.float32), np.full(machine.v.shape, 1e-4, np.float32)
    rng = np.random.default_rng(5)
    for epoch in range(EPOCHS):
        rate = 0.1 / (1 + 0.5 * epoch)
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), 256):
            rows = order[lo:lo + 256]
            index, value, start = machine.features(stats[rows], [buckets[r] for r in rows])
            z, sums = machine.margin(index, value, start)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            error = ((p - labels[rows]) / len(rows)).astype(np.float32)
            each = np.repeat(np.arange(len(rows)), np.diff(np.append(start, len(index))))
            push = error[each] * value
            used, where = np.unique(index, return_inverse=True)
            dw = np.bincount(where, push, len(used)).astype(np.float32) + 1e-5 * machine.w[used]
            grad = push[:, None] * (sums[each] - machine.v[index] * value[:, None])
            dv = np.stack([np.bincount(where, grad[:, f], len(used)) for f in range(RANK)], 1).astype(np.float32)
            dv += 1e-5 * machine.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            machine.w[used] -= rate * dw / np.sqrt(gw[used])
            machine.v[used] -= rate * dv / np.sqrt(gv[used])
            machine.w0 -= rate * float(error.sum())
    return machine


def _featurised(docs: DataFrame, *more: str) -> DataFrame:
    def rows(source):
        cache = bucket_cache()
        for text, *rest in source:
            text = text or ""
            words = text.split()
            yield (*rest, [float(x) for x in statistics(text, words)],
                   word_buckets(words, cache).astype(np.int32).tobytes())

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in more)
    return map_rows(docs, f"{kinds}, stats array<double>, buckets binary", rows, "text", *more)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0,
          rows: int = TRAIN_ROWS) -> Machine:
    """Fit on at most ``rows`` labelled rows of docs that are not held out."""
    sample = labelled_sample(docs, labels, "quality", modulus, remainder, rows)
    got = sorted(_featurised(sample, "doc_id", "label").collect(), key=lambda r: (r["doc_id"], r["stats"]))
    stats = np.array([r["stats"] for r in got]).reshape(len(got), len(STATISTICS))
    return fit(stats, [np.frombuffer(r["buckets"], np.int32).astype(np.int64) for r in got], np.array([r["label"] for r in got], float))


def score(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted for every row."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows(source):
        cache = bucket_cache()
        while some := list(islice(source, BATCH_ROWS)):
            texts = [t or "" for _, t in some]
            split = [t.split() for t in texts]
            stats = np.array([statistics(t, w) for t, w in zip(texts, split)])
            scores = np.concatenate([
                model.value.score(stats[lo:lo + 50], [word_buckets(w, cache) for w in split[lo:lo + 50]])
                for lo in range(0, len(some), 50)])
            for (key, _), s in zip(some, scores.tolist()):
                yield key, s, int(s >= threshold)

    return map_rows(docs, f"doc_id {id_type}, score double, predicted int", rows, "doc_id", "text")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier does not reject; null
    texts are judged as empty ones, repeated rows alike."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def test():
        cache = bucket_cache()

        def good(text):
            words = (text or "").split()
            stats = np.array([statistics(text or "", words)])
            return model.value.score(stats, [word_buckets(words, cache)])[0] >= threshold
        return good

    return keep_rows(docs, test)
