"""Packing token ids into sequences of one size: minimum bin slack."""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tablecheck.llm.bpe import byte_bpe
from tablecheck.llm.common import give_back, in_slices, ship, texts

#: Rests of documents that a task holds before it fills windows from them.
POOL = 2048
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def closest_fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to `room` from below.

    A bitset holds the sums that can be reached; it is kept after each length, and the counts
    are found by going back through them. It stops as soon as the room itself is reached.
    `lengths` ascending, no length over `room`."""
    reach, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int]] = []
    for length in reversed(lengths):
        steps.append((length, reach))
        left, part = min(counts[length], room // length), 1
        while left:
            part = min(part, left)
            reach |= (reach << (length * part)) & mask
            left, part = left - part, part * 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total, n = total - length, n + 1
        if n:
            taken[length] = n
    return taken


class Packer:
    """Packs a stream of documents; holds at most a pool of rests and the document in hand."""

    def __init__(self, size: int, first_sequence: int, pool: int = POOL):
        self.size, self.next, self.pool = size, first_sequence, pool
        self.rests: dict[int, list[tuple]] = {}
        self.lengths: list[int] = []
        self.held = self.total = 0

    def _put(self, item: tuple) -> None:
        n = len(item[2]) // 4
        if n not in self.rests:
            self.rests[n] = []
            insort(self.lengths, n)
        self.rests[n].append(item)
        self.held, self.total = self.held + 1, self.total + n

    def _take(self, n: int) -> tuple:
        items = self.rests[n]
        item = items.pop()
        if not items:
            del self.rests[n]
            del self.lengths[bisect_right(self.lengths, n) - 1]
        self.held, self.total = self.held - 1, self.total - n
        return item

    def add(self, doc_id, ids: bytes):
        """Yields the full windows of a document and what the pool then fills."""
        n, step = len(ids) // 4, 4 * self.size
        for at in range(0, n // self.size * step, step):
            yield (doc_id, at // 4, ids[at : at + step], n, self.next, 0)
            self.next += 1
        if n % self.size:
            at = n // self.size * step
            self._put((doc_id, at // 4, ids[at:], n))
        while self.held > self.pool and self.total >= self.size:
            yield from self._window(self.size)

    def finish(self):
        while self.total >= self.size:
            yield from self._window(self.size)
        while self.total:  # the last rest: windows of powers of two, which need no padding
            yield from self._window(1 << (self.total.bit_length() - 1))

    def _window(self, size: int):
        """Fills one window to the brim; if no multiset does, one more rest is cut."""
        offset, room = 0, size
        if self.lengths[-1] <= room:  # the largest rest goes first: the hardest to place
            item = self._take(self.lengths[-1])
            yield (*item, self.next, 0)
            offset, room = len(item[2]) // 4, room - len(item[2]) // 4
        fit = self.lengths[: bisect_right(self.lengths, room)] if room else []
        if fit:
            counts = {n: len(self.rests[n]) for n in fit}
            for n, times in closest_fill(fit, counts, room).items():
                for _ in range(times):
                    yield (*self._take(n), self.next, offset)
                    offset, room = offset + n, room - n
        if room:  # every rest left is longer than the room
            doc_id, start, ids, total = self._take(self.lengths[0])
            yield (doc_id, start, ids[: 4 * room], total, self.next, offset)
            self._put((doc_id, start + room, ids[4 * room :], total))
        self.next += 1


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, pool: int = POOL) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all documents.

    A document is its ids and `end_id` (a NULL or empty text: `end_id` alone). Each task packs
    its own rows in one pass, without a shuffle and with bounded memory: full windows of long
    documents first, then windows filled from a pool of rests by minimum bin slack. Every
    sequence of a task is full but the last few, whose sizes are falling powers of two, so
    nothing is padded. Sequence ids are the task's number times 2^40 plus a count; a task that
    runs again gives the same pieces. Each row gives its own pieces, also where ids repeat."""
    ship(docs.sparkSession)

    def run(batches):
        give_back()  # what stages before have left in this worker
        bpe = byte_bpe(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        packer = Packer(size, TaskContext.get().partitionId() << 40, pool)

        def rows():
            for batch in in_slices(batches):
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    yield from packer.add(doc_id, bpe.encode(text) + end)
            yield from packer.finish()

        held: list[tuple] = []
        for row in rows():
            held.append(row)
            if len(held) == 2048:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)
        give_back()

    return texts(docs).mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc_id, start, ids, total, sequence, offset = zip(*rows, strict=True)
    whole = pa.int64()
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(doc_id, whole),
            "start": pa.array(start, whole),
            "length": pa.array([len(x) // 4 for x in ids], whole),
            "ids": pa.array(ids, pa.binary()),
            "doc_tokens": pa.array(total, whole),
            "sequence_id": pa.array(sequence, whole),
            "offset": pa.array(offset, whole),
        }
    )
