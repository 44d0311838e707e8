"""SpotSigs fingerprints: chains of content words after common words."""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import in_batches, ship, texts
from tablecheck.llm.jaccard_join import classes, mixed

#: Content words in a chain, and each how many content words one is taken.
CHAIN, STEP = 2, 1
KEPT_WORDS = 500_000
#: Stretches of ids for each shuffle partition, so that their sizes even out.
STRETCHES = 4

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    "a an and are as at be but by for from had has have he her his in is it its not of on or she that the their they "
    "this to was were which will with you "
    "als am auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im ist mit nach nicht "
    "sich sie sind um und von war wie wird zu zum zur "
    "au aux avec ce ces dans de du elle en est et il la le les leur mais ne ou par pas plus pour qui que sa se ses son "
    "sont sur un une "
    "al como con del el era este esta la las lo los más no para pero por que se sin sobre su sus una y".split()
)
_EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "“”„‘’«»…–—¿¡"


class SpotSigs:
    """The signatures of a text as sorted 64-bit hashes.

    Words are lower-cased and freed of punctuation at their ends. After each common word, the
    next `chain` content words, one of each `step`, form a signature with it. A text without a
    full chain takes every word as an anchor, with as many words after it as there are."""

    def __init__(self, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN, step: int = STEP):
        self.chain, self.step = chain, step
        self.anchors = np.sort(np.array([xxhash.xxh3_64_intdigest(w) for w in anchors], np.uint64))
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.lower().split()
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                bare = w.strip(_EDGE)
                known[w] = xxhash.xxh3_64_intdigest(bare) if bare else 0
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        hashes = hashes[hashes != 0]
        if not len(hashes):
            return hashes
        at = np.searchsorted(self.anchors, hashes)
        common = self.anchors[np.minimum(at, len(self.anchors) - 1)] == hashes
        content = hashes[~common]
        after = np.cumsum(~common)[common]  # content words up to each anchor: where its chain begins
        reach = (self.chain - 1) * self.step + 1
        full = after + reach <= len(content)
        if full.any():
            out, begin = hashes[common][full], after[full]
            for k in range(self.chain):
                out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + content[begin + k * self.step])
        else:
            out = hashes.copy()
            for k in range(1, min(self.chain, len(hashes) - 1) + 1):
                out[:-k] = mixed(out[:-k] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:])
        return np.unique(out)


@lru_cache(maxsize=2)
def spotsigs(chain: int = CHAIN, step: int = STEP) -> SpotSigs:
    return SpotSigs(ANCHORS, chain, step)


def fingerprint(signatures: np.ndarray) -> str:
    """The set itself as text: its size and the sorted hashes. Equal texts have equal ones."""
    return f"{len(signatures)}:" + base64.b64encode(signatures.astype("<u8").tobytes()).decode()


def signatures_of(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.partition(":")[2]), "<u8")


def pruned_jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """The Jaccard likeness of two sorted sets if it is at least `least`, else 0.

    Sets whose lengths alone rule it out are not compared; the others are compared in pieces of
    the value range, until what is left can't reach `least`. Two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    pieces = 1 if least <= 0 else 1 + min(len(a), len(b)) // 256
    edges = np.array([2**64 * k // pieces for k in range(1, pieces)], np.uint64)
    cut_a = [0, *np.searchsorted(a, edges), len(a)]
    cut_b = [0, *np.searchsorted(b, edges), len(b)]
    common = 0
    for k in range(pieces):
        common += len(np.intersect1d(a[cut_a[k] : cut_a[k + 1]], b[cut_b[k] : cut_b[k + 1]], assume_unique=True))
        most = common + min(len(a) - cut_a[k + 1], len(b) - cut_b[k + 1])
        if most < least * (len(a) + len(b) - most):
            return 0.0
    return common / (len(a) + len(b) - common)


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_signatures, component): rows share a component if links of fingerprints with
    a likeness of `percent` or more connect them.

    The regions of `jaccard_join` replace a partition by length, and its exact comparison the
    pruned one: the links are the same. Without words: no component."""
    return classes(docs, spotsigs, percent).drop("mark").withColumnRenamed("n", "n_signatures")


# --- each document against its edited text and the next one ---


def _splits(ids: DataFrame, stretches: int) -> list[int]:
    """At most stretches - 1 ids that cut the table into even stretches."""
    shares = ", ".join(str(k / stretches) for k in range(1, stretches))
    if not shares:
        return []
    found = ids.agg(F.expr(f"approx_percentile(at, array({shares}), {max(10_000, 20 * stretches)})")).first()[0]
    return sorted(set(found or []))


def _stretch(at: Column, splits: list[int]) -> Column:
    """How many of the splits are not above `at`, looked up in two steps."""
    if not splits:
        return F.lit(0)
    width = math.isqrt(len(splits)) + 1
    parts = [splits[k : k + width] for k in range(0, len(splits), width)]
    count = lambda values: F.size(F.filter(values, lambda x: x <= at))
    coarse = count(F.array(*[F.lit(p[0]).cast("bigint") for p in parts]))
    table = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in p]) for p in parts])
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * width + count(F.get(table, coarse - 1)))


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by as many from the start of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks rows in order; each is finished when the next one of its stretch is there."""
    set_of = spotsigs()
    stretch = text = own = doc_id = None
    for batch in in_batches(batches):
        out: dict[str, list] = {k: [] for k in ("doc_id", "n", "sha", "own", "edited", "near_edited", "near_next")}
        columns = [batch.column(c).to_pylist() for c in ("stretch", "border", "doc_id", "text")]
        for at, border, next_id, following in zip(*columns, strict=True):
            found = set_of(following)
            if text is not None and at == stretch:
                changed = edited_text(text, following)
                changed_set = set_of(changed)
                out["doc_id"].append(doc_id)
                out["n"].append(len(text))
                out["sha"].append(hashlib.sha256(changed.encode()).hexdigest())
                out["own"].append(fingerprint(own))
                out["edited"].append(fingerprint(changed_set))
                out["near_edited"].append(pruned_jaccard(own, changed_set))
                out["near_next"].append(pruned_jaccard(own, found))
            stretch, doc_id, own, text = at, next_id, found, None if border else following
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(out.values(), _ALONG.types, strict=True)], schema=_ALONG
        )


_ALONG = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def against_neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    for every row: its fingerprint, that of its text with the last half replaced by the start
    of the next document's, and its likeness to both.

    The next document is that with the next higher id, after the last the first; rows with the
    same id follow one another by text, NULL ids come first. One shuffle deals the rows by
    stretches of ids, each with a copy of the first row after it, so every stretch is walked
    alone and a task holds one batch. NULL texts are empty; two texts without words are alike."""
    spark = docs.sparkSession
    ship(spark)
    rows = texts(docs).withColumn("at", F.coalesce("doc_id", F.lit(-(1 << 63))))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = _splits(rows.select("at"), STRETCHES * tasks)
    rows = rows.withColumn("stretch", _stretch(F.col("at"), splits))
    # at most one row for each stretch: the first id of each, and the stretch before it
    firsts = sorted((r.at, r.stretch) for r in rows.groupBy("stretch").agg(F.min("at").alias("at")).collect())
    out = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if not firsts:
        return spark.createDataFrame([], out)
    before = [(at, firsts[k - 1][1]) for k, (at, _) in enumerate(firsts)]
    borders = F.broadcast(spark.createDataFrame(before, "at bigint, border_of int"))
    first_rows = rows.join(borders, "at").groupBy("border_of", "at", "doc_id").agg(F.min("text").alias("text"))
    first_rows = first_rows.select("doc_id", "text", "at", F.col("border_of").alias("stretch"), F.lit(1).alias("border"))
    dealt = rows.withColumn("border", F.lit(0)).unionByName(first_rows).repartition(tasks, "stretch")
    ordered = dealt.sortWithinPartitions("stretch", "border", "at", "text")
    return ordered.select("stretch", "border", "doc_id", "text").mapInArrow(_along, out)
