"""Bounded, documented samples that the classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecheck.llm.common import texts

#: Characters of all texts of a sample; a sample that would have more ends before.
SAMPLE_CHARS = 64 << 20
#: One fold of so many is held out: its rows' labels are never learned from.
FOLDS, HELD_OUT = 5, 0


def fold():
    """The fold of a row: CRC-32 of its id as text. A NULL id has fold -1, which is not held out."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % FOLDS, F.lit(-1)).cast("int")


def _drawn(docs: DataFrame, most: int, longest: int, ids: DataFrame | None = None) -> list[tuple[int, str]]:
    """(doc_id, text) of at most `most` rows of `docs`, in order of id; of `ids` only, if given.

    Those of at most `longest` code points are drawn from, by hash of the id and then of the
    text, so one id with many texts gives no more rows than others. Each text counts once for an
    id, and the sample has SAMPLE_CHARS at most."""
    rows = texts(docs).filter(F.col("doc_id").isNotNull() & (fold() != HELD_OUT) & (F.length("text") <= longest))
    own = rows.select("doc_id") if ids is None else rows.select("doc_id").join(ids, "doc_id", "left_semi")
    by_id = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    few = own.distinct().orderBy(by_id, "doc_id").limit(most)
    by_text = F.xxhash64("text")
    found = rows.join(F.broadcast(few), "doc_id").groupBy("doc_id", by_text.alias("mark")).agg(F.min("text").alias("text"))
    place = F.row_number().over(W.partitionBy("doc_id").orderBy("mark"))  # all first texts of ids, then the second ones
    found = found.withColumn("place", place).filter(F.col("place") <= most).orderBy("place", by_id, "doc_id").limit(most)
    out, held = [], 0
    for r in found.select("doc_id", "text").toLocalIterator():
        held += len(r.text)
        if held > SAMPLE_CHARS:
            break
        out.append((r.doc_id, r.text))
    return sorted(out)


def label_ids(labels: DataFrame, label: str, value: int) -> DataFrame:
    """Ids outside the held-out fold that carry `value` and no other one."""
    rows = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    agreed = rows.filter(fold() != HELD_OUT).groupBy("doc_id").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    return agreed.filter((F.col("a") == value) & (F.col("b") == value)).select("doc_id")


def label_sample(docs: DataFrame, labels: DataFrame, label: str, value: int, most: int, longest: int):
    """(doc_id, text) of at most `most` rows with this label, of at most `longest` code points."""
    return _drawn(docs, most, longest, label_ids(labels, label, value))


def any_sample(docs: DataFrame, most: int, longest: int):
    """(doc_id, text) of at most `most` rows outside the held-out fold, labelled or not."""
    return _drawn(docs, most, longest)
