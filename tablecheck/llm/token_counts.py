"""Token counts by a sentencepiece model, without moving ids."""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tablecheck.llm.common import map_texts, texts

#: Words whose counts a worker keeps, and the longest of them.
KEPT_WORDS, KEPT_LENGTH = 500_000, 48
#: The mark that stands for a space inside pieces.
MARK = "▁"


class PieceCounter:
    """Counts tokens of whole texts.

    A space after another character is a safe boundary where no piece holds a space after
    anything else and where the model puts one space before a text: the rest, without that
    space, encodes as it would have in place. Models for which this does not hold, and texts
    that hold the mark itself, are encoded whole."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(k) for k in range(n)]
        plain = all(MARK not in p.lstrip(MARK) for p in pieces)
        one = self.model.encode(["ab", "ab ab", " ab  ab ", "Ａ"], out_type=str)
        spaced = one[1] == one[0] * 2 and "".join(one[2]) == MARK * 2 + "ab" + MARK * 2 + "ab" + MARK
        self.safe = plain and spaced and "".join(one[0]) == MARK + "ab"
        self.words: dict[str, int] = {}

    def cut(self, text: str) -> list[str]:
        """Parts whose counts add up to that of the text."""
        if not self.safe or MARK in text:
            return [text]
        if "  " not in text and text[:1] != " " and text[-1:] != " ":
            return text.split(" ") if text else []
        # spaces at the end stay with what is before them: alone, one of them would have no token
        parts = re.findall(r" *[^ ]+(?: +\Z)?| +\Z", text)
        return [parts[0], *(p[1:] for p in parts[1:])] if parts else []

    def counts(self, values: list[str]) -> list[int]:
        """One call of the model for all new words of a batch."""
        words = self.words
        if len(words) > KEPT_WORDS:
            words.clear()
        parts = [self.cut(t) for t in values]
        new = [w for w in set().union(*parts) if w not in words]
        long = {}
        for word, ids in zip(new, self.model.encode(new, num_threads=1), strict=True):
            (words if len(word) <= KEPT_LENGTH else long)[word] = len(ids)
        if long:
            return [sum(words[w] if w in words else long[w] for w in p) for p in parts]
        return [sum(map(words.__getitem__, p)) for p in parts]


@functools.lru_cache(maxsize=2)
def piece_counter(model: str) -> PieceCounter:
    return PieceCounter(model)


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every whole text, in one pass without a shuffle.

    `model` is a path that every executor has. Batches hold about the same number of bytes,
    however long their texts are. NULL and empty texts have 0 tokens; each row gives a row."""

    def make():
        counter = piece_counter(model)

        def work(ids, values):
            sizes = [len(t.encode()) for t in values]
            counts = counter.counts(values)
            return {"doc_id": ids, "n_bytes": pa.array(sizes, pa.int64()), "n_tokens": pa.array(counts, pa.int64())}

        return work

    return map_texts(texts(docs), make, "doc_id bigint, n_bytes bigint, n_tokens bigint")
