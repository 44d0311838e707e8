"""Toxicity scores, learned from confirmed toxic examples and unlabelled text."""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import give_back, map_texts, texts
from tablecheck.llm.labelled import HELD_OUT, any_sample, fold, label_ids, label_sample
from tablecheck.llm.quality_classifier import keep_scored

#: The fit: confirmed toxic rows, unlabelled rows, the longest of them in code points.
FIT_TOXIC, FIT_UNLABELLED, FIT_LONGEST = 3000, 6000, 100_000
#: Features: words and beginnings of words of these lengths, at most so many.
BEGINNINGS, FEATURES, LEAST_DOCS, LEAST_RATIO = (3, 4, 5), 2000, 3, 2.0
MEMBERS, STEPS, RATE, DECAY = 3, 300, 0.05, 1e-3
THRESHOLD = 0.5
KEPT_WORDS = 400_000

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


class ToxicityModel:
    """Linear classifiers over present features, averaged; bounded by the parameters above."""

    def __init__(self):
        self.columns: dict[str, int] = {}
        self.members: list[tuple[np.ndarray, float]] = []
        self.prior = 0.0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    def present(self, text: str) -> set[int]:
        """Columns of the features that the whole text holds."""
        known = self.__dict__.setdefault("known", {})
        if len(known) > KEPT_WORDS:
            known.clear()
        words = set(_WORD.findall(text.lower()))
        for w in words:
            if w not in known:
                known[w] = tuple(self.columns[f] for f in word_features(w) if f in self.columns)
        return set(chain.from_iterable(map(known.__getitem__, words)))

    def learn(self, toxic: list[str], unlabelled: list[str], prior: float, seed: int = 11) -> ToxicityModel:
        """Chooses features that confirmed texts hold far more often, then trains each member
        on them by the non-negative positive-unlabelled risk, on its own draw of the rows."""
        self.prior = prior
        if len(toxic) < LEAST_DOCS or not unlabelled:
            return self
        least = max(LEAST_DOCS, 0.004 * len(toxic))
        held = {f: n for f, n in self._held(toxic).items() if n >= least}
        usual = self._held(unlabelled, held)  # of these only, as others are not asked for
        ratio = {f: (n / len(toxic)) / ((usual[f] + 0.5) / len(unlabelled)) for f, n in held.items()}
        best = sorted((f for f in ratio if ratio[f] >= LEAST_RATIO), key=lambda f: (-ratio[f] * held[f] ** 0.5, f))
        self.columns = {f: k for k, f in enumerate(best[:FEATURES])}
        self.__dict__.pop("known", None)
        if not self.columns:
            return self
        p, u = ([np.fromiter(self.present(t), np.int32) for t in rows] for rows in (toxic, unlabelled))
        self.__dict__.pop("known", None)
        draw = np.random.default_rng(seed)
        for _ in range(MEMBERS):
            some = draw.integers(0, len(p), len(p)), draw.integers(0, len(u), len(u))
            self.members.append(self._train(self._matrix(p, some[0]), self._matrix(u, some[1]), prior))
        return self

    @staticmethod
    def _held(rows: list[str], of=None) -> Counter:
        """How many texts hold each feature, of all or of the given ones."""
        seen: Counter = Counter()
        for t in rows:
            found = chain.from_iterable(map(word_features, set(_WORD.findall(t.lower()))))
            seen.update(set(found) if of is None else {f for f in found if f in of})
        return seen

    def _matrix(self, rows: list[np.ndarray], drawn: np.ndarray) -> np.ndarray:
        """The drawn rows, each given by its columns; only those of one member are in memory."""
        out = np.zeros((len(drawn), len(self.columns)), np.float32)
        for k, at in enumerate(drawn):
            out[k, rows[at]] = 1
        return out

    @staticmethod
    def _train(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
        """Adam on prior * R_p+ + max(0, R_u- - prior * R_p-), sigmoid loss. While the second
        part is negative, the step goes up its slope instead, so that it can't stay there."""
        w, b = np.zeros(p.shape[1], np.float32), -1.0
        moments = [0.0, 0.0, 0.0, 0.0]
        for step in range(1, STEPS + 1):
            grads = ToxicityModel._gradients(p, u, w, b, prior)
            values = [w, b]
            for k, g in enumerate(grads):
                moments[k] = 0.9 * moments[k] + 0.1 * g
                moments[k + 2] = 0.999 * moments[k + 2] + 0.001 * g * g
                up = moments[k] / (1 - 0.9**step) / (np.sqrt(moments[k + 2] / (1 - 0.999**step)) + 1e-8)
                values[k] = values[k] - RATE * up
            w, b = values
        return w, float(b)

    @staticmethod
    def _gradients(p: np.ndarray, u: np.ndarray, w: np.ndarray, b: float, prior: float) -> tuple[np.ndarray, float]:
        """Of the risk with DECAY / 2 of the squared weights, while its second part is not negative;
        else of that part turned round."""
        sp = 1 / (1 + np.exp(-np.clip(p @ w + b, -30, 30)))  # loss of calling it toxic is 1 - sp
        su = 1 / (1 + np.exp(-np.clip(u @ w + b, -30, 30)))
        dp, du = sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        negative = su.mean() - prior * sp.mean()
        if negative >= 0:
            gp, gu = -2 * prior * dp, du
        else:
            gp, gu = prior * dp, -du
        return p.T @ gp + u.T @ gu + DECAY * w, gp.sum() + gu.sum()

    def scores(self, values: list[str]) -> np.ndarray:
        if not self.members:
            return np.full(len(values), min(self.prior, 0.49))
        out = np.empty(len(values))
        for k, text in enumerate(values):
            on = np.fromiter(self.present(text), np.int64)
            out[k] = np.mean([1 / (1 + np.exp(-np.clip(w[on].sum() + b, -30, 30))) for w, b in self.members])
        return out


def class_prior(labels: DataFrame) -> float:
    """The share of toxic rows among all labelled ones outside the held-out fold."""
    toxic, clean = (label_ids(labels, "toxic", v).count() for v in (1, 0))
    return toxic / (toxic + clean) if toxic + clean else 0.0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    prior: float | None = None,
    most_toxic: int = FIT_TOXIC,
    most_unlabelled: int = FIT_UNLABELLED,
    longest: int = FIT_LONGEST,
) -> ToxicityModel:
    """A model from at most `most_toxic` confirmed rows and `most_unlabelled` rows of any kind,
    all outside the held-out fold. Without `prior` it is taken from the labels. Without toxic
    rows no text is called toxic."""
    prior = class_prior(labels) if prior is None else prior
    toxic = [t for _, t in label_sample(docs, labels, "toxic", 1, most_toxic, longest)]
    model = ToxicityModel().learn(toxic, [t for _, t in any_sample(docs, most_unlabelled, longest)], prior)
    del toxic
    give_back()  # the driver goes on with other stages
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text, in one pass without a shuffle.

    Only the text is an input of the score. NULL and empty texts hold no feature and have the
    score of none; equal texts have equal scores; each row gives a row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda ids, values: {"doc_id": ids, "score": pa.array(shared.value.scores(values), pa.float64())}

    rows = map_texts(texts(docs), make, "doc_id bigint, score double")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return rows.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "score", predicted.alias("predicted"))


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents that the classifier does not call toxic."""
    return keep_scored(docs, model, lambda scores: scores < THRESHOLD)
