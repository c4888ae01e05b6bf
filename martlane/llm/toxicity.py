"""Toxicity by weak supervision.

Many voters look at a text: each group of lexicon words, each group of learnt
word stems, and patterns (an insult beside a pronoun, an insult in capitals,
several insults, none at all).  A generative label model with one hidden class
per text estimates, by expectation maximisation, how often each voter fires in
either class (its accuracy) and how strongly voters fire together beyond the
class (their correlation); correlated voters share their weight.  The label of
the training rows takes part as one more voter, so its errors are weighed too.
A linear (logistic) classifier over lexicon, stem and voter features is
trained on the posterior labels and scores every text.

The lexicon is a short fixed list and, since insults differ by language, words
and word beginnings learnt from the training rows: terms that texts with the
label hold far more often than the others.  Training rows are a bounded
sample: at most ``TRAIN_ROWS`` labelled rows that are not held out, by the hash
of their id, and for the term counts one text per component of near copies;
term counts are a distributed aggregation and at most
``MAX_TERMS`` terms are kept.  Labels, language, source and id never enter a
score.  Scoring maps over all rows with a model of bounded size.

Defined cases: null text counts as empty and scores like a text without any
voter for toxic; texts are scored whole; rows with a null id are scored and
never held out; repeated rows are scored alike; without labelled rows of both
classes the fixed lexicon's voters decide; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from martlane.llm import near
from martlane.llm.common import WordCache, held_out, keep_rows, labelled_sample, map_rows, stored

TRAIN_ROWS = 16_000
MAX_TERMS = 4_000
STEMS = (4, 5, 6)          # lengths of word beginnings
GROUPS = 12                # learnt terms vote in so many groups
CHANCE = 1e-7              # a learnt term's counts are less likely than this without a link to the label

# Common insults, as voters of their own.
LEXICON = ("stupid", "idiot", "moron", "loser", "trash", "scum", "worthless", "pathetic", "disgusting", "clown",
           "dumb", "fool", "jerk", "garbage", "filth", "hate")
# Pronouns of direct address and their verbs.
ADDRESS = frozenset(("you", "your", "youre", "you're", "are", "u", "ur"))

VOTERS = tuple(f"word:{w}" for w in LEXICON) + tuple(f"terms:{g}" for g in range(GROUPS)) + (
    "two_or_more", "four_or_more", "address", "shouted", "dense", "none")


def core(word: str) -> str:
    return "".join(filter(str.isalnum, word.lower()))


def terms_of(word: str) -> list[str]:
    """What a word is counted as: itself, and its beginnings marked by "*"."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)] if word else []


class Lexicon:
    """Learnt terms with their group, and the reader of a text's hits."""

    def __init__(self, terms: list[str]):
        self.terms = {t: i for i, t in enumerate(sorted(terms))}
        self.fixed = {w: i for i, w in enumerate(LEXICON)}

    def cache(self) -> WordCache:
        """word -> None, or (word, its fixed lexicon place or -1, its learnt terms)."""
        def look(word):
            w = core(word)
            fixed = self.fixed.get(w, -1)
            learnt = [self.terms[t] for t in terms_of(w) if t in self.terms]
            return (w, fixed, learnt) if fixed >= 0 or learnt else None
        return WordCache(look)

    def votes(self, text: str, cache: WordCache) -> tuple[list[int], list[int]]:
        """(voters that fire, learnt terms present) of one text."""
        words = text.split()
        found = [w for w in set(words) if cache[w] is not None]
        fired, learnt = set(), set()
        if not found:
            return [len(VOTERS) - 1], []
        hits = set(found)
        at = [i for i, w in enumerate(words) if w in hits]
        for w in found:
            _, fixed, terms = cache[w]
            if fixed >= 0:
                fired.add(fixed)
            learnt.update(terms)
            if len(w) > 2 and w.isupper():
                fired.add(len(VOTERS) - 3)
        # Terms of one word vote in the group of their first, so groups stay apart.
        fired.update(len(LEXICON) + t % GROUPS for t in learnt)
        kinds = len({cache[w][0] for w in found})
        if kinds >= 2:
            fired.add(len(VOTERS) - 6)
        if kinds >= 4:
            fired.add(len(VOTERS) - 5)
        if any(core(words[j]) in ADDRESS for i in at for j in (i - 1, i + 1) if 0 <= j < len(words)):
            fired.add(len(VOTERS) - 4)
        if len(at) * 50 >= len(words):
            fired.add(len(VOTERS) - 2)
        return sorted(fired), sorted(learnt)


class LabelModel:
    """P(class), P(voter fires | class), and the voters' shared weights."""

    def fit(self, votes: np.ndarray, labels: np.ndarray, rounds: int = 25) -> np.ndarray:
        """``votes`` (rows, voters) in {0, 1}; returns P(toxic) per row."""
        every = np.column_stack([votes, labels]).astype(float)
        n = len(every)
        posterior = np.clip(labels.astype(float), 0.02, 0.98)
        for _ in range(rounds):
            self.prior = float(np.clip(posterior.mean(), 1e-3, 1 - 1e-3))
            rate = np.stack([((1 - posterior) @ every + 0.5) / ((1 - posterior).sum() + 1),
                             (posterior @ every + 0.5) / (posterior.sum() + 1)])
            self.accuracy = rate
            # Correlation of what the class does not explain.
            residual = every - ((1 - posterior)[:, None] * rate[0] + posterior[:, None] * rate[1])
            scale = np.sqrt((residual * residual).sum(axis=0)) + 1e-9
            self.correlation = (residual.T @ residual) / np.outer(scale, scale)
            shared = np.abs(self.correlation)
            shared[shared < 2 / np.sqrt(max(n, 4))] = 0   # within chance
            np.fill_diagonal(shared, 1)
            self.weight = 1 / shared.sum(axis=1)
            lift = self.weight * (every * np.log(rate[1] / rate[0]) + (1 - every) * np.log((1 - rate[1]) / (1 - rate[0])))
            z = np.log(self.prior / (1 - self.prior)) + lift.sum(axis=1)
            new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            if np.abs(new - posterior).max() < 1e-4:
                posterior = new
                break
            posterior = new
        return posterior


class Classifier:
    """Logistic regression over voters and learnt terms (presence features)."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.weights = np.zeros(len(VOTERS) + len(lexicon.terms))
        self.bias = -3.0
        # Before any training: lexicon voters speak for toxic, "none" against.
        self.weights[:len(LEXICON)] = 2.0
        self.weights[len(VOTERS) - 1] = -1.0

    def fit(self, rows: list[tuple[list[int], list[int]]], target: np.ndarray, steps: int = 400) -> None:
        index = [v + [len(VOTERS) + t for t in learnt] for v, learnt in rows]
        column = np.fromiter((i for r in index for i in r), np.int64)
        each = np.repeat(np.arange(len(index)), [len(r) for r in index])
        w, bias = np.zeros(len(self.weights)), float(np.log(target.mean() / (1 - target.mean())))
        speed = np.zeros(len(w))
        rate = 4.0
        for _ in range(steps):
            z = bias + np.bincount(each, w[column], len(index))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(index)
            speed = 0.9 * speed - rate * (np.bincount(column, error[each], len(w)) + 1e-5 * w)
            w += speed
            bias -= rate * error.sum()
        self.weights, self.bias = w, bias

    def score(self, fired: list[int], learnt: list[int]) -> float:
        z = self.bias + self.weights[fired].sum() + self.weights[[len(VOTERS) + t for t in learnt]].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def learnt_terms(sample: DataFrame, limit: int = MAX_TERMS) -> list[str]:
    """Terms whose texts bear the label far more often than others do: at
    eight times the odds of the whole sample, and beyond chance (the share of
    labelled texts to the power of the term's, a bound on the binomial tail).

    Copies and near copies of one text would make all its words look so; of a
    component of near copies (five-word shingles, similarity 0.8 or more) the
    text with the smallest id counts.
    """
    def rows(source):
        cache = WordCache(lambda w: terms_of(core(w)))
        for text, label in source:
            words = set((text or "").split())
            yield label, sorted({t for w in words for t in cache[w] if t.rstrip("*").isalpha()})

    texts = stored(map_rows(near.keep_one(sample, width=5), "label int, terms array<string>", rows, "text", "label"),
                   "terms")
    sizes = texts.groupBy("label").count().collect()
    seen = texts.select("label", F.explode("terms").alias("term"))
    toxic = sum(r["count"] for r in sizes if r["label"] == 1)
    clean = sum(r["count"] for r in sizes if r["label"] == 0)
    if not toxic or not clean:
        return []
    counts = seen.groupBy("term").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    lift = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    enough = max(4, int(np.ceil(np.log(CHANCE) / np.log(toxic / (toxic + clean)))))
    picked = (counts.filter(F.col("t") >= enough).withColumn("lift", lift)
              .filter(F.col("lift") > float(np.log(8)))
              .orderBy((F.col("lift") * F.sqrt("t")).desc(), "term").limit(limit))
    return [r["term"] for r in picked.select("term").collect()]


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2,
          rows: int = TRAIN_ROWS) -> Classifier:
    sample = stored(labelled_sample(docs, labels, "toxic", modulus, remainder, rows), "sample")
    lexicon = Lexicon(learnt_terms(sample))

    def voted(source):
        cache = lexicon.cache()
        for text, label in source:
            yield (*lexicon.votes(text or "", cache), label)

    got = map_rows(sample, "fired array<int>, learnt array<int>, label int", voted, "text", "label").collect()
    got = sorted((list(r["fired"]), list(r["learnt"]), r["label"]) for r in got)
    classifier = Classifier(lexicon)
    labels_ = np.array([r[2] for r in got])
    if len(got) and labels_.min() != labels_.max():
        votes = np.zeros((len(got), len(VOTERS)), np.int8)
        for i, (fired, _, _) in enumerate(got):
            votes[i, fired] = 1
        posterior = LabelModel().fit(votes, labels_)
        classifier.fit([r[:2] for r in got], posterior)
    return classifier


def score(docs: DataFrame, classifier: Classifier, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted for every row."""
    model = docs.sparkSession.sparkContext.broadcast(classifier)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows(source):
        cache = model.value.lexicon.cache()
        for key, text in source:
            s = model.value.score(*model.value.lexicon.votes(text or "", cache))
            yield key, s, int(s >= threshold)

    return map_rows(docs, f"doc_id {id_type}, score double, predicted int", rows, "doc_id", "text")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier does not call toxic;
    null texts are judged as empty ones, repeated rows alike."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def test():
        lexicon = model.value.lexicon
        cache = lexicon.cache()
        return lambda text: model.value.score(*lexicon.votes(text or "", cache)) < threshold

    return keep_rows(docs, test)
