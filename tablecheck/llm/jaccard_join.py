"""Exact Jaccard join of word-shingle sets: pivots, regions, windows, recursion.

Jaccard distance d = 1 - J is a metric, and documents link when d is at most a radius. Pivots
that are documents would not part the corpus: nearly all distances between unrelated texts are
close to 1, so every document lies at the border of every region and the windows would copy it
everywhere. The first level therefore takes single shingles as pivots, and documents only
inside its regions:

1. A document of n shingles has distance 1 - 1/n to the pivots {s} that it holds and 1 to all
   others; ties go to the first pivot in one order for all documents. Its region is that of its
   first pivot. Linked documents differ in few shingles, so one of the first `nearest(n)`
   pivots of each is common to both: into this window of regions a document is copied.
   The order is by hash, with frequent shingles last, so that passages which many documents
   share make no regions. Frequent is what many documents have among the first `looked_at(n)`.
2. Documents that have too few others among those, as edited copies of one text, are a crowd.
   Any `nearest(n)` shingles of a document hold one of each that is linked with it; so a crowd's
   documents meet all others in the windows above, by all that they hold themselves. Among
   themselves they are joined in a second order, the shingles that fewest of the crowd hold
   first: what an edited copy has alone fills its window, and it meets no others. Windows are
   narrower there too: two sets can only link in the region of their first common pivot if what
   follows it in both is as much as the link needs.
3. In each region with several sets, one becomes the pivot and the distance of all others to
   it is computed exactly: a link, or a coordinate. Regions whose sets now lie in one component
   are done. The others go on recursively: the pivot, whose links are all known, leaves; new
   pivots, sixteen times as many each round, meet only sets of other components whose distance to the
   old pivot lies in the triangle window, |d(x, p) - d(q, p)| <= radius.

No connection between different texts is lost: every linked pair shares a region, and in it the
pair is either compared, or excluded by the triangle inequality, or already in one component.
So this finds components, not all links. Links are counted afterwards: they are inside
components, whose sets meet there block by block (`link_counts`)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecheck.functions.columns import fresh
from tablecheck.llm.common import give_back, in_slices, ship, texts
from tablecheck.llm.components import components
from tablecheck.session import discard, pin

#: Words in a shingle; linked are sets with 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 5, 80
#: A shingle is frequent if more sets than this have it among the elements they look at. This
#: sets an order only; any value gives the same links.
FREQUENT = 16
#: A list of ids up to this size is broadcast (some 10 MB), a longer one is joined by a shuffle.
BROADCAST_ROWS = 200_000
KEPT_WORDS = 100_000
#: Elements and sets of a block in which links are counted, and elements that one product of
#: matrices has. These set the size of a task only.
BLOCK_ELEMENTS, BLOCK_SETS, PRODUCT_ELEMENTS = 1 << 18, 1024, 2048

SetOf = Callable[[str], np.ndarray]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Shingles:
    """The distinct shingles of a text as sorted 64-bit hashes. Words are lower-cased in A-Z
    and parted by ASCII white space; a text of fewer words is one shingle."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        parts = text.encode().lower().split()
        if not parts:
            return np.empty(0, np.uint64)
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        for w in set(parts):
            if w not in self.known:
                self.known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(self.known.__getitem__, parts), np.uint64, len(parts))
        k = min(self.words, len(parts))
        out = np.full(len(parts) - k + 1, k, np.uint64)
        for at in range(k):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[at : at + len(out)])
        return np.unique(out)


@lru_cache(maxsize=4)
def shingles(words: int) -> Shingles:
    return Shingles(words)


# --- regions ---


def nearest(size: int, percent: int) -> int:
    """How many first elements of a set, in any order, hold one of every set linked with it."""
    return size * (100 - percent) // 100 + 1


def looked_at(size: int, percent: int) -> int:
    """How many elements are looked at to find so many that are not frequent."""
    first = nearest(size, percent)
    return min(size, first + first // 2 + 1)


def _describe(make: Callable[[], SetOf], percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_of = make()
        for batch in in_slices(batches):
            found = [set_of(t) for t in batch.column("text").to_pylist()]
            first = [x[: looked_at(len(x), percent)] if len(x) else x for x in found]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in first])]).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "mark": batch.column("mark"),
                    "n": pa.array([len(x) for x in found], pa.int64()),
                    "key": pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in found], pa.binary()),
                    "sketch": pa.array([sketch(x) for x in found], pa.binary()),
                    "regions": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first).view(np.int64))),
                }
            )
        give_back()

    return run


def sketch(found: np.ndarray) -> bytes:
    """How many elements fall in each of about n / 2 equal ranges of the hash (a power of two)."""
    bits = min(16, max(6, len(found).bit_length() - 1))
    places = (found >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(places, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the elements in which two sets differ, from their sketches alone."""
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (a, b))
    wide, narrow = (a, b) if len(a) >= len(b) else (b, a)
    return int(np.abs(wide.reshape(len(narrow), -1).sum(1) - narrow).sum())


def _sets(make: Callable[[], SetOf]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_of = make()
        for batch in in_slices(batches):
            data = [set_of(t).tobytes() for t in batch.column("text").to_pylist()]
            keys = [xxhash.xxh3_128_digest(x) for x in data]
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "elements": pa.array(data, pa.binary())})
        give_back()

    return run


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, "elements"):
        data = [np.frombuffer(e, np.int64) for e in batch.column("elements").to_pylist()]
        owner = np.repeat(batch.column("x").to_numpy(), [len(e) for e in data])
        yield pa.RecordBatch.from_pydict({"x": pa.array(owner), "shingle": pa.array(np.concatenate(data))})


def _may_link(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "x_sketch"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("p_sketch", "x_sketch", "n")), strict=True)
            # linked sets with n elements together differ in n (1 - J) / (1 + J) at most
            may = [least_difference(p, x) * (100 + percent) <= n * (100 - percent) for p, x, n in rows]
            yield batch.select(["p", "x"]).filter(pa.array(may, pa.bool_()))

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, "x_elements"):
        common, union = [], []
        for a, b in zip(batch.column("p_elements").to_pylist(), batch.column("x_elements").to_pylist(), strict=True):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            n = len(np.intersect1d(a, b, assume_unique=True))
            common.append(n)
            union.append(len(a) + len(b) - n)
        yield pa.RecordBatch.from_pydict(
            {
                "p": batch.column("p"),
                "x": batch.column("x"),
                "common": pa.array(common, pa.int64()),
                "together": pa.array(union, pa.int64()),
            }
        )
    give_back()


class _Measure:
    """Exact distances of pairs, with the sets of as few documents as need be.

    Sketches, a sixteenth of a set, rule most pairs out. The sets of the others are made from
    the texts when a round first needs them, and kept as a table."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, make: Callable[[], SetOf], percent: int):
        self.docs, self.nodes, self.make, self.percent = docs, nodes, make, percent
        self.sets: DataFrame | None = None

    def _load(self, wanted: DataFrame) -> None:
        """Adds the sets of the nodes in `wanted` (x) that are not there yet."""
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("x"), "x", "left_anti")
        wanted = pin(wanted, "wanted")
        found = pin(near(wanted, self.nodes.select("x", "key", F.coalesce("doc_id", F.lit(0)).alias("at")), "x", "inner"), "found")
        rows = near(found.select("at").distinct(), self.docs.withColumn("at", F.coalesce("doc_id", F.lit(0))), "at", "inner")
        sets = rows.select("text").mapInArrow(_sets(self.make), "key binary, elements binary")
        sets = sets.groupBy("key").agg(F.first("elements").alias("elements"))
        new = pin(sets.join(found.select("key", "x"), "key").select("x", "elements"), "elements")
        self.sets = new if self.sets is None else self.sets.unionAll(new)
        discard(wanted, found)

    def load(self, wanted: DataFrame) -> DataFrame:
        """(x, elements) of these nodes at least."""
        self._load(wanted)
        return self.sets

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """(p, x, common, together) of the pairs (p, x, n) that may link, n being their sizes' sum."""
        ends = pin(pairs.select("x").unionAll(pairs.select("p")).distinct(), "ends")
        small = near(ends, self.nodes.select("x", "sketch"), "x", "inner")  # late rounds need few of them
        close = pairs.join(small.withColumnRenamed("sketch", "x_sketch"), "x")
        close = close.join(small.select(F.col("x").alias("p"), F.col("sketch").alias("p_sketch")), "p")
        close = close.select("p", "x", "n", "p_sketch", "x_sketch")
        close = pin(close.mapInArrow(_may_link(self.percent), "p bigint, x bigint"), "close")
        needed = pin(close.select("x").unionAll(close.select("p")).distinct(), "needed")
        self._load(needed)
        own = near(needed, self.sets, "x", "inner")
        measured = close.join(own.withColumnRenamed("elements", "x_elements"), "x")
        measured = measured.join(own.select(F.col("x").alias("p"), F.col("elements").alias("p_elements")), "p")
        measured = measured.select("p", "x", "p_elements", "x_elements")
        compared = pin(measured.mapInArrow(_compare, "p bigint, x bigint, common bigint, together bigint"), "compared")
        discard(ends, close, needed)
        return compared


def near(ids: DataFrame, rows: DataFrame, on: str, how: str) -> DataFrame:
    """Joins with a list of ids: broadcast if its size allows, else by a shuffle."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, on, how)


def text_mark(column: str) -> Column:
    """The SHA-256 of a text."""
    return F.unhex(F.sha2(F.col(column), 256))


def classes(docs: DataFrame, make: Callable[[], SetOf], percent: int, count_links: bool = False) -> DataFrame:
    """(doc_id, mark, n, component, and n_links if asked for): what tells each row's text from others, the size of its set,
    and a number that rows share if links of sets connect them, whatever their ids. Rows with
    an empty set have no component."""
    ship(docs.sparkSession)
    docs = texts(docs)
    schema = "doc_id bigint, mark binary, n bigint, key binary, sketch binary, regions array<bigint>"
    described = pin(docs.withColumn("mark", text_mark("text")).mapInArrow(_describe(make, percent), schema), "sets")
    some = described.filter("n > 0")
    # one node for each distinct set: its least id, or a hash where one id has several sets
    many = some.groupBy("doc_id").agg(F.min("key").alias("u"), F.max("key").alias("v"))
    many = pin(many.filter("doc_id is null or u != v").select("doc_id"), "shared-ids")
    if many.isEmpty():
        named = lambda rows: rows.withColumn("node", F.col("doc_id"))
    else:
        shared = many.select(F.col("doc_id").alias("shared_id"), F.lit(True).alias("shared"))
        node = F.when(F.col("shared"), -2 - F.shiftrightunsigned(F.xxhash64("key"), 2)).otherwise(F.col("doc_id"))
        same = F.col("doc_id").eqNullSafe(F.col("shared_id"))
        named = lambda rows: rows.join(shared, same, "left").withColumn("node", node).drop("shared_id", "shared")
    some = named(some)
    first = some.groupBy("key").agg(
        F.min("node").alias("x"), F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"))
    nodes = pin(first, "nodes")
    copies = some.join(nodes.select("key", "x"), "key").filter("node != x").select(F.col("node").alias("x")).distinct()
    spots = near(pin(copies, "copies"), some.withColumn("x", F.col("node")), "x", "left_anti")
    measure = _Measure(docs, nodes, make, percent)
    joined = _links(docs, spots.select("x", "n", "regions"), measure, percent)
    found = nodes.select("key", F.col("x").alias("a")).join(joined, "a", "left")
    found = found.select("key", F.coalesce("b", "a").alias("component"))
    if not count_links:
        return described.join(found, "key", "left").select("doc_id", "mark", "n", "component")
    held = some.groupBy("key").agg(F.count("*").alias("rows"), F.first("n").alias("n"))
    held = pin(found.join(held, "key").join(nodes.select("key", "x"), "key").select("key", "x", "n", "rows", "component"), "held")
    counted = held.join(link_counts(held, measure, percent), "x", "left")
    # the other rows with the same set, and those whose sets are linked with it
    links = (F.col("rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    rows = described.join(counted.select("key", "component", links), "key", "left")
    return rows.select("doc_id", "mark", "n", "component", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def _count_block(percent: int):
    """Links in a cell, in which the sets of two blocks of a component meet, or those of one."""

    def run(table: pa.Table) -> pa.Table:
        x = table.column("x").to_pylist()
        rows = table.column("rows").to_numpy().astype(np.int64)
        block = table.column("block").to_numpy()
        sets = [np.frombuffer(e, np.uint64) for e in table.column("elements").to_pylist()]
        sizes = np.array([len(e) for e in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        several = often > 1
        number = np.cumsum(several) - 1
        keep = several[place]
        place, owner = number[place[keep]], owner[keep]
        by_place = np.argsort(place, kind="stable")
        place, owner = place[by_place], owner[by_place]
        common = np.zeros((len(sets), len(sets)), np.float64)
        for begin in range(0, int(several.sum()), PRODUCT_ELEMENTS):
            a, b = np.searchsorted(place, [begin, begin + PRODUCT_ELEMENTS])
            holds = np.zeros((len(sets), PRODUCT_ELEMENTS), np.float32)
            holds[owner[a:b], place[a:b] - begin] = 1
            common += holds @ holds.T
        together = sizes[:, None] + sizes[None, :] - common
        linked = common * 100 >= together * percent
        np.fill_diagonal(linked, False)
        if len(np.unique(block)) > 1:  # links inside a block are counted in its own cell
            linked &= block[:, None] != block[None, :]
        return pa.table({"x": pa.array(x, pa.int64()), "linked": pa.array(linked @ rows, pa.int64())})

    return run


def link_counts(held: DataFrame, measure: _Measure, percent: int) -> DataFrame:
    """(x, linked): the rows whose sets are linked with that of x, which is itself not counted.

    `held` has the sets (x, n, rows, component). All pairs of sets in one component are compared,
    as products of matrices of two blocks of it each; a set is copied once for each block."""
    of = held.groupBy("component").agg(F.count("*").alias("sets"), F.sum("n").alias("elements_of"))
    of = of.filter("sets > 1")
    blocks = F.ceil(F.greatest(F.col("elements_of") / BLOCK_ELEMENTS, F.col("sets") / BLOCK_SETS)).cast("int").alias("blocks")
    rows = pin(held.join(of.select("component", blocks), "component").select("x", "rows", "component", "blocks"), "grouped")
    sets = measure.load(rows.select("x"))
    block = F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int")
    rows = rows.join(sets, "x").withColumn("block", block)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = ["component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    rows = rows.select(*cell, "x", "rows", "block", "elements")
    found = rows.groupBy("component", "low", "high").applyInArrow(_count_block(percent), "x bigint, linked bigint")
    return found.groupBy("x").agg(F.sum("linked").alias("linked"))


def _with_company(spots: DataFrame) -> DataFrame:
    """The spots in regions with several sets, and how many those have."""
    seen = spots.groupBy("region").agg(F.count("*").alias("sets")).filter("sets > 1")
    return spots.join(seen, "region")


def _members(sets: DataFrame, measure: _Measure, percent: int) -> DataFrame:
    """(region, x, n, at, leads): the sets that meet in a region, of which those that lead may be
    its pivots. `at` is the place in the second order, NULL in regions of the first.

    `sets` has (x, n, regions), the elements that each looks at."""
    near_ones = F.expr(f"n * {100 - percent} div 100 + 1")  # as nearest() and looked_at()
    looked = F.expr(f"least(n, n * {100 - percent} div 100 + 1 + (n * {100 - percent} div 100 + 1) div 2 + 1)")
    spots = sets.select("x", "n", F.posexplode("regions").alias("at", "region"))
    found = pin(_with_company(spots).withColumn("frequent", F.col("sets") > FREQUENT).drop("sets"), "shared")
    often = found.filter("frequent").groupBy("x").agg(F.first("n").alias("n"), F.collect_set("at").alias("places"))
    lacks = looked - F.size("places") < near_ones
    often = pin(often.select("x", "n", "places", lacks.alias("crowd")), "frequent")
    crowd = often.filter("crowd").select("x", "n")
    others = often.select("x", "places", "crowd")
    found = found.join(others, "x", "left").filter(~F.col("frequent") & ~F.coalesce("crowd", F.lit(False)))
    before = F.size(F.filter(F.coalesce("places", F.array().cast("array<int>")), lambda p: p < F.col("at")))
    few = found.filter(F.col("at") - before < near_ones).select("region", "x", "n", F.lit(True).alias("leads"))
    none = F.lit(None).cast("bigint").alias("at")
    if crowd.isEmpty():
        members = _merged(few).select("region", "x", "n", none, "leads")
    else:
        held = near(crowd.select("x"), measure.load(crowd.select("x")), "x", "inner")
        held = pin(held.mapInArrow(_elements, "x bigint, shingle bigint"), "crowd-elements")
        window = sets.join(others, "x", "left").filter(~F.coalesce("crowd", F.lit(False)))
        rare = F.expr("filter(regions, (r, i) -> not array_contains(coalesce(places, cast(array() as array<int>)), i))")
        window = window.select("x", "n", F.explode(F.slice(rare, 1, near_ones.cast("int"))).alias("shingle"))
        known = pin(held.select("shingle").distinct(), "crowd-shingles")
        window = pin(near(known, window, "shingle", "left_semi"), "crowd-windows")
        met = near(window.select("shingle").distinct(), held, "shingle", "left_semi").join(crowd, "x")
        mixed = window.withColumn("leads", F.lit(True)).unionByName(met.withColumn("leads", F.lit(False)))
        mixed = mixed.select(F.xxhash64("shingle", F.lit("mixed")).alias("region"), "x", "n", "leads")
        members = _merged(few.unionByName(mixed)).select("region", "x", "n", none, "leads")
        own = _crowd_members(crowd, held, percent).withColumn("leads", F.lit(True))
        members = members.unionByName(own.select(*members.columns))
    return pin(members, "members")


def _merged(members: DataFrame) -> DataFrame:
    """(region, x, n, leads): of regions with the same sets, as those of one passage, one."""
    members = pin(members.distinct(), "regions")
    mark = [F.xxhash64("x", "leads", F.lit(seed)).cast("decimal(20,0)") for seed in (1, 2)]
    same = members.groupBy("region").agg(
        F.count("*").alias("sets"), *(F.sum(m).alias(f"sum{k}") for k, m in enumerate(mark)))
    one = same.filter("sets > 1").groupBy("sets", "sum0", "sum1").agg(F.min("region").alias("region"))
    return members.join(one.select("region"), "region", "left_semi")


def _crowd_members(crowd: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """(region, x, n, at): the regions in the second order, among the sets (x, n) of a crowd that
    hold the elements (x, shingle).

    Elements that one set has alone come first in it. Where they fill the window the set
    meets no other; only the others are looked at element by element."""
    counts = held.groupBy("shingle").agg(F.count("*").alias("held"), F.max("x").alias("x"))
    counts = pin(counts.select("shingle", "held", F.when(F.col("held") == 1, F.col("x")).alias("x")), "held")
    alone = counts.filter("held = 1").groupBy("x").agg(F.count("*").alias("alone"))
    window = F.expr(f"n * {100 - percent} div 100 + 1")  # as nearest()
    left = crowd.join(alone, "x", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
    left = pin(left.withColumn("window", window - F.col("alone")).filter("window > 0"), "crowd-left")
    rows = near(left.select("x"), held, "x", "left_semi").join(counts.filter("held > 1").select("shingle", "held"), "shingle")
    order = F.array_sort(F.collect_list(F.struct("held", "shingle"))).alias("order")
    rows = rows.groupBy("x").agg(order).join(left, "x")
    first = F.posexplode(F.expr("slice(order, 1, int(window))")).alias("place", "spot")
    spots = rows.select("x", "n", "alone", first)
    spots = spots.select(
        F.xxhash64("spot.shingle", F.lit("crowd")).alias("region"), "x", "n", (F.col("alone") + F.col("place")).alias("at"))
    # sets link only where the reach of each is at least the other's n (`enough` in _links)
    reach = F.expr(f"(n - at) * {100 + percent} div {percent} - n")
    met = spots.groupBy("region").agg(F.count("*").alias("sets"), F.min("n").alias("least"), F.max(reach).alias("most"))
    can = (reach >= F.col("least")) & (F.col("most") >= F.col("n"))
    return spots.join(met.filter("sets > 1"), "region").filter(can).drop("sets", "least", "most")


def _links(docs: DataFrame, sets: DataFrame, measure: _Measure, percent: int) -> DataFrame:
    """(a, b): every linked node that is not the least of its component, with the least one."""
    spark = docs.sparkSession
    radius = 1 - percent / 100
    members = _members(sets, measure, percent)
    tested = spark.createDataFrame([], "p bigint, x bigint")
    stars = spark.createDataFrame([], "a bigint, b bigint")
    tested_pairs: list[DataFrame] = []
    started = members
    members = members.withColumns({"far": F.lit(None).cast("double"), "component": F.col("x")})
    pivots = 1
    while True:
        # in a crowd, sets with few rare elements of their own are near its centre, where most links are
        order = W.partitionBy("region").orderBy("at", F.xxhash64("x", F.lit(pivots)), "x")
        chosen = members.filter("leads").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= pivots)
        chosen = pin(chosen.select(
            "region", "rank", F.col("x").alias("p"), F.col("n").alias("p_n"), F.col("at").alias("p_at"),
            F.col("far").alias("p_far"), F.col("component").alias("p_component")), "pivots")
        window = F.coalesce(F.abs(F.col("far") - F.col("p_far")) <= radius + 1e-9, F.lit(True))
        sizes = F.least("n", "p_n") * 100 >= F.greatest("n", "p_n") * percent
        # what follows the region in both must be as much as a link needs in common
        follows = F.least(F.col("n") - F.col("at"), F.col("p_n") - F.col("p_at"))
        enough = F.coalesce(follows * (100 + percent) >= (F.col("n") + F.col("p_n")) * percent, F.lit(True))
        pairs = members.join(chosen, "region").filter("component != p_component").filter(sizes & window & enough)
        ends = (F.greatest("p", "x").alias("p"), F.least("p", "x").alias("x"))
        pairs = pairs.select(*ends, (F.col("n") + F.col("p_n")).alias("n")).distinct()
        pairs = pin(pairs.join(tested, ["p", "x"], "left_anti"), "pairs")
        measured = measure(pairs)
        new = measured.filter(F.col("common") * 100 >= F.col("together") * percent)
        if not new.isEmpty():
            stars = components(stars.unionAll(new.select(F.col("p").alias("a"), F.col("x").alias("b"))))
        # what is left of the regions: without the pivots, and without those in one component
        labels = stars.select(F.col("a").alias("x"), F.col("b").alias("root"))
        first = chosen.filter("rank = 1").select("region", F.col("p").alias("q"))
        left = members.drop("far", "component").join(chosen.select("region", F.col("p").alias("x")), ["region", "x"], "left_anti")
        left = left.join(labels, "x", "left").withColumn("component", F.coalesce("root", "x")).drop("root")
        open_ones = left.groupBy("region").agg(F.min("component").alias("u"), F.max("component").alias("v"), F.max("leads").alias("led"))
        open_ones = open_ones.filter("u < v and led")
        left = left.join(open_ones.select("region"), "region").join(first, "region")
        far = measured.select(
            F.col("p").alias("e"), F.col("x").alias("f"), (1 - F.col("common") / F.col("together")).alias("far"))
        ends = [F.greatest("x", "q").alias("e"), F.least("x", "q").alias("f")]
        left = left.select("region", "x", "n", "at", "leads", "component", *ends).join(far, ["e", "f"], "left")
        before = members
        members = pin(left.select("region", "x", "n", "at", "leads", "far", "component"), "open")
        discard(before, started, chosen, measured)
        if members.isEmpty():
            discard(members, *(tested_pairs), pairs)
            return stars
        tested_pairs.append(pairs)
        tested = tested.unionAll(pairs.select("p", "x"))
        pivots *= 16


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): the least id that links lead to, and the number
    of other rows that a row is linked with, for every row.

    Links are between texts whose sets of `words`-word shingles have a Jaccard similarity of
    at least `percent`. Equal sets are one node from the start, so groups of exact copies cost
    nothing more. NULL and empty texts and those without words have no shingles and link with
    nothing: component_id is their own id. Repeated rows repeat; of rows that share an id but
    not a text each is linked on its own; NULL ids are never the least, and are the component
    of groups in which all ids are NULL."""
    found = pin(classes(docs, lambda: shingles(words), percent, count_links=True), "classes")
    least = found.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    rows = found.join(least, "component", "left")
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), "n_links")


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id") -> DataFrame:
    """`docs` with one document of each group of linked ones: that with the least id, and of
    several texts with that id the one with the least hash.

    Groups are those of the texts, whatever their ids: different texts that share an id are
    apart unless links connect them, and rows without an id stay only in groups where no row
    has one. Exact repeats of the row that stays go. Documents without words stay. All columns
    stay as they are."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), "text")
    linked = classes(rows, lambda: shingles(words), percent).filter("component is not null")
    # one text has one set, and so one component
    held = linked.groupBy("doc_id", "mark").agg(F.min("component").alias("component"), F.count("*").alias("rows"))
    held = pin(held, "linked")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "mark")).alias("least")
    chosen = held.groupBy("component").agg(least)
    chosen = pin(chosen.select(F.col("least.doc_id").alias("__id"), F.col("least.mark").alias("__mark")), "chosen")
    this = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark"))
    named = [F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")]
    drop = pin(held.join(chosen, this, "left_anti").select(*named), "drop")
    again = pin(held.filter("rows > 1").join(chosen, this, "left_semi").select(*named), "again")
    own_id, own_mark, an_id, a_mark = fresh(docs.columns, "own_id", "own_mark", "id", "mark")
    drop, again = (ids.select(F.col("__id").alias(an_id), F.col("__mark").alias(a_mark)) for ids in (drop, again))
    marked = docs.withColumns({own_id: F.col(id_col).cast("bigint"), own_mark: text_mark("text")})
    same = F.col(own_id).eqNullSafe(F.col(an_id)) & (F.col(own_mark) == F.col(a_mark))
    few = lambda ids: F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    kept = marked.join(few(drop), same, "left_anti")
    if again.isEmpty():
        return kept.select(*docs.columns)
    repeated = kept.join(few(again), same, "left_semi").dropDuplicates([own_id, own_mark])
    return kept.join(few(again), same, "left_anti").unionByName(repeated).select(*docs.columns)
