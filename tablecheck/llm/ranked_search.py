"""Ranked lexical search: the best documents of each item, from treaps over term-document grids.

A grid has a row for each term of the items, rarest terms first, and a column for each of
some thousand documents, by id. A cell holds the impact of a term in a document. Over the
grid lies a quadtree without pointers (K2): level by level, four bits for each cell that say
which quarters have anything, where the first quarter stands, and the highest impact in the
cell, which makes it a treap: cells are ordered by place, and impacts fall on the way down.

An item walks a grid best-first. It holds ranges of documents, with the cells in which its
terms' rows cross them; the highest impacts of those cells, weighted and summed, bound the
score of every document in the range. The ranges with the highest bounds are split next, all
row paths together, until no open range can beat the worst of the best documents found so far.
At a single document the bound is the score. Nothing is left out: a range is closed only if its bound is lower, or
equal while all its ids are higher.

Documents are indexed where they lie: one pass over the texts keeps the lengths and counts
of the items' terms, one pass over those builds grids, searches them and hands on the best of
each task. Items come in blocks of bounded size; only a block's terms are sent to the tasks."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecheck.llm.common import in_batches, ship, texts
from tablecheck.session import pin

#: Documents that an item gets.
BEST = 20
#: Items and bytes of their texts that are searched in one run over the documents.
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 4 << 20
#: Documents and postings of a grid, ranges that are split at once, and tasks whose results
#: meet first. These set memory and speed only.
GRID_DOCS, GRID_POSTINGS, SPLIT, MEET = 1 << 16, 1 << 22, 128, 64

# Term characters are letters and digits of ASCII, with A-Z lower-cased, and all
# bytes of other characters.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_PIECE = 4 << 20


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, in pieces."""
    data = text.encode().translate(_TERM_BYTES)
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + _PIECE)
        end = len(data) if end < 0 else end
        yield data[begin:end].split()
        begin = end


@dataclass(frozen=True)
class Item:
    """`rows`: numbers of its distinct terms; `times`: how often it has each."""

    item_id: int | None
    rows: np.ndarray
    times: np.ndarray


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks; the driver holds one at a time."""
    block: list[tuple[int | None, str]] = []
    held = 0
    for row in items.toLocalIterator():
        block.append((row.item_id, row.text))
        held += len(row.text)
        if len(block) >= BLOCK_ITEMS or held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


# --- what the documents hold of the items' terms ---


def _counted(number: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches):
            lengths, rows, counts = [], [], []
            for text in batch.column("text").to_pylist():
                n, found = 0, []
                for piece in terms_of(text):
                    n += len(piece)
                    found += [number[t] for t in piece if t in number]
                row, tf = np.unique(np.array(found, np.int32), return_counts=True)
                lengths.append(n)
                rows.append(row.tobytes())
                counts.append(tf.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(lengths, pa.int64()),
                    "rows": pa.array(rows, pa.binary()),
                    "tf": pa.array(counts, pa.binary()),
                }
            )

    return run


def _frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            for rows in batch.column("rows").to_pylist():
                held[np.frombuffer(rows, np.int32)] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"row": pa.array(some, pa.int64()), "df": pa.array(held[some], pa.int64())})

    return run


# --- the grid ---

_BITS = np.array([bin(x).count("1") for x in range(16)], np.int64)


def _spread(x: np.ndarray) -> np.ndarray:
    """Every bit moved to twice its place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class K2Treap:
    """Impacts by (row, column), both below `1 << depth` cells a side.

    Cells of all levels stand in one list, level by level from the root: `quarters` has the
    bits of those that are there, `first` the place of the first, `most` the highest impact."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, n_rows: int, n_columns: int):
        self.depth = max(1, (max(n_rows, n_columns) - 1).bit_length())
        # both sides are stretched over the whole square, so that all levels tell them apart
        self.row_shift = self.depth - max(0, (n_rows - 1).bit_length())
        self.column_shift = self.depth - max(0, (n_columns - 1).bit_length())
        code = _spread(rows << self.row_shift) << np.uint64(1) | _spread(columns << self.column_shift)
        order = np.argsort(code)
        code, most = code[order], impacts[order].astype(np.int64)
        levels = [(np.zeros(len(code), np.uint8), np.zeros(len(code), np.int64), most)]
        for _ in range(self.depth):
            above = code >> np.uint64(2)
            begins = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(code) else np.zeros(0, np.int64)
            bits = np.left_shift(1, (code & np.uint64(3)).astype(np.int64)).astype(np.uint8)
            quarters = np.bitwise_or.reduceat(bits, begins) if len(code) else bits
            most = np.maximum.reduceat(most, begins) if len(code) else most
            levels.append((quarters, begins, most))
            code = above[begins]
        levels.reverse()
        starts = np.cumsum([0, *(len(q) for q, _, _ in levels)])
        self.quarters = np.concatenate([q for q, _, _ in levels])
        self.first = np.concatenate([f + s for (_, f, _), s in zip(levels, starts[1:], strict=True)])
        self.most = np.concatenate([m for _, _, m in levels])

    def below(self, cells: np.ndarray, quarter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a cell has that quarter, its place)."""
        held = self.quarters[cells].astype(np.int64)
        return (held >> quarter & 1).astype(bool), self.first[cells] + _BITS[held & (1 << quarter) - 1]

    def best(self, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, top: list[tuple[int, int, int]], most: int) -> None:
        """Adds to `top`, a heap of (score, -id, -number) of at most `most` documents, the better
        ones of the grid. `ids` rise with the columns."""
        if not len(self.most) or not len(rows):
            return
        rows = rows << self.row_shift
        none = np.zeros(len(rows), np.int64)
        # (-bound, first id, number, depth, column, cells, rows, weights)
        open_ranges = [(-int((self.most[none] * weights).sum()), int(ids[0]), 0, 0, 0, none, rows, weights)]
        number = 0
        while open_ranges:
            taken = []
            while open_ranges and len(taken) < SPLIT:
                bound, first_id = -open_ranges[0][0], open_ranges[0][1]
                if bound <= 0 or len(top) == most and (bound, -first_id) <= top[0][:2]:
                    open_ranges.clear()  # no other has a higher bound, or a lower id at this one
                    break
                taken.append(heapq.heappop(open_ranges))
            if not taken:
                return
            sizes = np.array([len(t[5]) for t in taken])
            depth = np.array([t[3] for t in taken])
            column = np.array([t[4] for t in taken])
            cells, row, weight = (np.concatenate([t[k] for t in taken]) for k in (5, 6, 7))
            owner = np.repeat(np.arange(len(taken)), sizes)
            row_bit = row >> (self.depth - 1 - depth)[owner] & 1
            for column_bit in (0, 1):
                there, child = self.below(cells, 2 * row_bit + column_bit)
                child, of, own_row, own_weight = child[there], owner[there], row[there], weight[there]
                ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(taken)))])
                sums = np.concatenate([[0], np.cumsum(self.most[child] * own_weight)])
                bounds = sums[ends[1:]] - sums[ends[:-1]]
                columns = column | column_bit << (self.depth - 1 - depth)
                for k in np.flatnonzero(bounds > 0).tolist():
                    bound, at = int(bounds[k]), int(columns[k]) >> self.column_shift
                    doc_id = int(ids[at])
                    if len(top) == most and (bound, -doc_id) <= top[0][:2]:
                        continue
                    if depth[k] + 1 == self.depth:
                        number -= 1
                        (heapq.heappush if len(top) < most else heapq.heapreplace)(top, (bound, -doc_id, number))
                    else:
                        part = slice(ends[k], ends[k + 1])
                        number -= 1
                        heapq.heappush(
                            open_ranges,
                            (-bound, doc_id, -number, int(depth[k]) + 1, int(columns[k]), child[part], own_row[part], own_weight[part]),
                        )


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 12 m), m being 75 + (25 n docs) div terms, of each posting."""
    if len(n) and 25 * int(n.max()) * docs >= 1 << 63:  # beyond 64 bits the product is taken exactly
        m = np.array([75 + 25 * int(x) * docs // terms for x in n], np.int64)
    else:
        m = 75 + 25 * n * docs // max(terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


#: Ids of rows without one, which stand after all others.
_NO_ID = (1 << 63) - 1


def _searched(items: list[Item], weights: np.ndarray, place: np.ndarray, docs: int, terms: int, most: int):
    """The best documents of one task for each item: (item, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[list[tuple[int, int, int]]] = [[] for _ in items]
        queries = [(place[i.rows], weights[i.rows] * i.times) for i in items]
        queries = [(r[w > 0], w[w > 0]) for r, w in queries]

        def search(parts: list[tuple]) -> None:
            ids = np.concatenate([p[0] for p in parts])
            order = np.argsort(ids, kind="stable")
            column = np.empty(len(ids), np.int64)
            column[order] = np.arange(len(ids))
            n = np.concatenate([p[1] for p in parts])
            sizes = np.concatenate([p[2] for p in parts])
            rows = np.concatenate([np.frombuffer(b"".join(p[3]), np.int32) for p in parts])
            tf = np.concatenate([np.frombuffer(b"".join(p[4]), np.int64) for p in parts])
            doc = np.repeat(np.arange(len(ids)), sizes)
            value = impacts(tf, n[doc], docs, terms)
            grid = K2Treap(place[rows], column[doc], value, len(place), len(ids))
            for (row, weight), top in zip(queries, tops, strict=True):
                grid.best(row, weight, ids[order], top, most)

        parts, held, postings = [], 0, 0
        for batch in in_batches(batches, "rows"):
            batch = batch.filter(pa.compute.greater(batch.column("n"), 0))
            if not batch.num_rows:
                continue
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
            rows = batch.column("rows").to_pylist()
            sizes = np.array([len(r) // 4 for r in rows])
            parts.append((ids, batch.column("n").to_numpy(), sizes, rows, batch.column("tf").to_pylist()))
            held, postings = held + len(ids), postings + int(sizes.sum())
            if held >= GRID_DOCS or postings >= GRID_POSTINGS:
                search(parts)
                parts, held, postings = [], 0, 0
        if parts:
            search(parts)
        found = [(k, -i, s) for k, top in enumerate(tops) for s, i, _ in top]
        ids = pa.array([None if i == _NO_ID else i for _, i, _ in found], pa.int64())
        numbers, scores = (pa.array([x[c] for x in found], t) for c, t in ((0, pa.int32()), (2, pa.int64())))
        yield pa.RecordBatch.from_pydict({"item": numbers, "doc_id": ids, "score": scores})

    return run


def _search_block(docs: DataFrame, block: list[tuple[int | None, str]], most: int) -> DataFrame:
    spark = docs.sparkSession
    number: dict[bytes, int] = {}
    items = []
    for item_id, text in block:
        found = [number.setdefault(t, len(number)) for piece in terms_of(text) for t in piece]
        rows, times = np.unique(np.array(found, np.int64), return_counts=True)
        items.append(Item(item_id, rows, times))
    held = pin(docs.mapInArrow(_counted(number), "doc_id bigint, n bigint, rows binary, tf binary"), "postings")
    n_docs, n_terms = held.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one row for each term of the block at most
    df = held.select("rows").mapInArrow(_frequencies(len(number)), "row bigint, df bigint").groupBy("row").agg(F.sum("df"))
    frequency = np.zeros(len(number), np.int64)
    for row, count in df.collect():
        frequency[row] = count
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)
    place = np.empty(len(number), np.int64)
    place[np.argsort(frequency, kind="stable")] = np.arange(len(number))
    found = held.mapInArrow(
        _searched(items, weights, place, n_docs, n_terms, most), "item int, doc_id bigint, score bigint"
    )
    found = found.withColumn("part", F.floor(F.spark_partition_id() / MEET))
    best_first = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for keys in (("item", "part"), ("item",)):
        found = found.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*best_first)))
        found = found.filter(F.col("rank") <= most)
    ids = spark.createDataFrame([(k, i.item_id) for k, i in enumerate(items)], "item int, item_id bigint")
    return found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, most: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the `most` documents with the highest scores above 0 for each
    row of `items` (item_id, text), best first, equal scores by ascending doc_id.

    Terms are runs of ASCII letters and digits, A-Z lower-cased, and of all other characters.
    NULL and empty texts have none: such documents are not counted, such items find nothing.
    Repeated rows are documents or items of their own; NULL ids stand last among equal scores.
    Other columns are not read."""
    ship(docs.sparkSession)
    docs = texts(docs)
    asked = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = [pin(_search_block(docs, block, most), "found") for block in _blocks(asked)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionAll, found)
