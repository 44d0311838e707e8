"""Quality scores: random-indexing word vectors, pooled per document, and a two-layer network."""

from __future__ import annotations

import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import give_back, in_slices, map_texts, ship, texts
from tablecheck.llm.labelled import HELD_OUT, fold, label_ids, label_sample

#: The fit: rows of each label, the longest of them in code points, words with a vector.
FIT_ROWS, FIT_LONGEST, VOCABULARY = 3000, 100_000, 20_000
#: Size of the vectors, and positions of an index vector that are not zero.
SIZE, SPARSE = 48, 6
#: Words on either side that count as context; documents a word must occur in.
CONTEXT, LEAST_DOCS = 2, 5
HIDDEN, STEPS, RATE, DECAY = 32, 400, 0.01, 1e-4
#: A document with a score of at least this is kept.
THRESHOLD = 0.3
#: Words that a worker remembers the vector of, and words pooled at a time.
KEPT_WORDS, CHUNK = 300_000, 1 << 16

_PARTS = re.compile(r"([^\W\d_]+)|(\d+)|((.)\4*)", re.S)


def shape(word: str) -> str:
    """The form of a word: case of its letters, digits, and punctuation with its length up to 3."""
    out = []
    for letters, digits, other, one in _PARTS.findall(word):
        if letters:
            kind = "x" if letters.islower() else "X" if letters.isupper() and len(letters) > 1 else "Xx"
            out.append(kind if letters.istitle() or kind != "Xx" else "xX")
        else:
            out.append("9" if digits else f"{one}{min(len(other), 3)}")
    return "\x00" + "".join(out)[:24]


def index_vector(token: str) -> np.ndarray:
    """A sparse vector of +1 and -1 that depends on the token alone."""
    draw = np.random.default_rng(zlib.crc32(token.encode()))
    out = np.zeros(SIZE, np.float32)
    out[draw.choice(SIZE, SPARSE, replace=False)] = draw.choice((-1.0, 1.0), SPARSE)
    return out


class QualityModel:
    """What a fit leaves: vectors, network and temperature; bounded by the parameters above."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.vectors = np.zeros((1, SIZE), np.float32)
        self.prior = 0.5
        self.net: list[np.ndarray] | None = None
        self.mean = self.scale = None
        self.temperature, self.shift = 1.0, 0.0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    # --- vectors ---

    def learn_vectors(self, values: list[str]) -> None:
        """The vector of a word is its index vector and those of the words around it, over the
        whole of each text."""
        number: dict[str, int] = {}  # each distinct word is held once, a text is the numbers of its words
        coded = [np.fromiter((number.setdefault(w, len(number)) for w in t.split()), np.int32) for t in values]
        words = list(number)
        del number
        form_number: dict[str, int] = {}
        form_of = np.fromiter((form_number.setdefault(shape(w), len(form_number)) for w in words), np.int32, len(words))
        forms = list(form_number)
        seen, seen_form = np.zeros(len(words), np.int64), np.zeros(len(forms), np.int64)
        for row in coded:
            own = np.unique(row)
            seen[own] += 1
            seen_form[np.unique(form_of[own])] += 1
        kept = sorted((k for k in np.flatnonzero(seen >= LEAST_DOCS) if len(words[k]) <= 40), key=lambda k: (-seen[k], words[k]))
        kept_forms = sorted(np.flatnonzero(seen_form >= LEAST_DOCS), key=lambda k: (-seen_form[k], forms[k]))
        names = [*(forms[k] for k in kept_forms[: VOCABULARY // 4]), *(words[k] for k in kept[:VOCABULARY])]
        self.rows = {name: k + 1 for k, name in enumerate(names)}
        form_row = np.fromiter((self.rows.get(f, 0) for f in forms), np.int32, len(forms))[form_of]
        own_row = np.fromiter((self.rows.get(w, 0) for w in words), np.int32, len(words))
        own_row = np.where(own_row > 0, own_row, form_row)  # as `lookup`
        del words, forms, form_number, form_of
        index = np.vstack([np.zeros((1, SIZE), np.float32), *(index_vector(n)[None] for n in names)])
        total = index.copy()
        for codes in coded:
            for begin in range(0, len(codes), CHUNK):
                lead = min(begin, CONTEXT)  # words of the chunk before, as context only
                part = codes[begin - lead : begin + CHUNK]
                # each word counts by itself and by its form, so that rare words have contexts too
                for row in (own_row[part], form_row[part]):
                    for off in range(1, CONTEXT + 1):
                        at = max(off, lead)
                        if len(row) > at:
                            later, before = row[at:], row[at - off : len(row) - off]
                            np.add.at(total, later, index[before])
                            np.add.at(total, before, index[later])
        total[0] = 0
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        self.vectors = (total / np.where(norm > 0, norm, 1)).astype(np.float32)

    def lookup(self, words: list[str]) -> np.ndarray:
        known = self.__dict__.setdefault("known", {})
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = self.rows.get(w) or self.rows.get(shape(w), 0)
        return np.fromiter(map(known.__getitem__, words), np.int32, len(words))

    def features(self, text: str) -> np.ndarray:
        """Mean and spread of the word vectors, and how much the text repeats itself."""
        words = text.split()
        n = len(words)
        out = np.zeros(2 * SIZE + 5, np.float32)
        if not n:
            return out
        first, second = np.zeros(SIZE), np.zeros(SIZE)
        each = iter(words)
        while part := list(islice(each, CHUNK)):
            vectors = self.vectors[self.lookup(part)]
            first += vectors.sum(0)
            second += np.einsum("ij,ij->j", vectors, vectors)
        mean = first / n
        lines = [x for x in text.split("\n") if x.strip()]
        out[:SIZE] = mean
        out[SIZE : 2 * SIZE] = np.sqrt(np.maximum(second / n - mean * mean, 0))
        same = sum(map(str.__eq__, words, islice(words, 1, None)))
        out[2 * SIZE :] = (
            np.log1p(n) / 10,
            len(set(words)) / n,
            same / n,
            np.log1p(sum(map(len, words)) / n),
            1 - len(set(lines)) / len(lines),
        )
        return out

    # --- network ---

    def learn(self, rows: list[tuple[int, str, int]], seed: int = 7) -> QualityModel:
        """Fits vectors, network and temperature; a fifth of the rows only calibrates."""
        labels = np.array([y for _, _, y in rows], np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if len(labels) < 10 or labels.min() == labels.max():
            return self
        self.learn_vectors([t for _, t, _ in rows])
        x = np.vstack([self.features(t) for _, t, _ in rows])
        self.__dict__.pop("known", None)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.scale
        held = np.array([zlib.crc32(b"calibrate%d" % (d or 0)) % 5 == 0 for d, _, _ in rows])
        if held.all() or not held.any() or len(set(labels[~held])) < 2:
            held[:] = False
        self.net = self._train(x[~held], labels[~held], seed)
        if held.any():
            self.temperature = self._calibrate(self._logits(x[held]), labels[held])
        return self

    @staticmethod
    def _train(x: np.ndarray, y: np.ndarray, seed: int) -> list[np.ndarray]:
        draw = np.random.default_rng(seed)
        net = [draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
               draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        moment, square = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
        for step in range(1, STEPS + 1):
            for k, g in enumerate(QualityModel._gradients(net, x, y)):
                moment[k] = 0.9 * moment[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                up = moment[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                net[k] = net[k] - RATE * up
        return [p.astype(np.float32) for p in net]

    @staticmethod
    def _gradients(net: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss with DECAY / 2 of the squared weights, by each part of the network."""
        hidden = np.tanh(x @ net[0] + net[1])
        p = 1 / (1 + np.exp(-np.clip(hidden @ net[2] + net[3], -30, 30)))
        delta = (p - y) / len(y)
        back = np.outer(delta, net[2]) * (1 - hidden * hidden)
        grads = [x.T @ back, back.sum(0), hidden.T @ delta, delta.sum(keepdims=True)]
        return [g + DECAY * own for g, own in zip(grads, net, strict=True)]

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.net[0] + self.net[1]) @ self.net[2] + self.net[3]

    @staticmethod
    def _calibrate(logits: np.ndarray, y: np.ndarray) -> float:
        """The temperature with the least log loss on rows the network has not seen."""
        tried = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in tried]
        return float(tried[int(np.argmin(loss))])

    def scores(self, values: list[str]) -> np.ndarray:
        if self.net is None:
            return np.full(len(values), self.prior)
        x = (np.vstack([self.features(t) for t in values]) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self._logits(x) / self.temperature + self.shift, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, longest: int = FIT_LONGEST) -> QualityModel:
    """A model from at most `most` rows of each label outside the held-out fold.

    Where the bound changes the labels' shares, the scores are shifted back to the shares among
    all labelled rows outside the fold. Without rows of both labels every score is the prior."""
    drawn = [label_sample(docs, labels, "quality", value, most, longest) for value in (0, 1)]
    few_bad, few_good = map(len, drawn)
    rows = sorted((*r, value) for value in (0, 1) for r in drawn[value])
    del drawn
    model = QualityModel().learn(rows)
    if model.net is not None:
        bad, good = (label_ids(labels, "quality", value).count() for value in (0, 1))
        model.shift = float(np.log(good / bad) - np.log(few_good / few_bad))
    del rows
    give_back()  # the driver goes on with other stages
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text, in one pass without a shuffle.

    Only the text is an input of the score. NULL and empty texts have one score, that of no
    words; equal texts have equal scores; each row gives a row, a NULL id is not held out."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda ids, values: {"doc_id": ids, "score": pa.array(shared.value.scores(values), pa.float64())}

    rows = map_texts(texts(docs), make, "doc_id bigint, score double")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return rows.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "score", predicted.alias("predicted"))


def keep_scored(docs: DataFrame, model, keep, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, whose score passes `keep` (of an array)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        batch = values = None
        for batch in in_slices(batches, text_col):
            values = [t or "" for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(keep(shared.value.scores(values)), pa.bool_()))
        del batch, values
        give_back()

    return docs.mapInArrow(run, docs.schema)


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents that the classifier does not reject."""
    return keep_scored(docs, model, lambda scores: scores >= THRESHOLD)
