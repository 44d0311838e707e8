"""Spelling variants: words one edit apart, found by walking a trie as a relation.

The trie is a table: a node is a prefix, its edges the characters that follow it. A walk is a
table of states (word, kind, node): `node` is what the walk has read, its length is the level,
and `kind` says what has been edited (0 nothing, 1 a character replaced, 2 one of the word's
characters skipped), which also gives the position in the word. Level by level the states are
joined with the edges of their node; every edge that fits is a state of the next level. A
state that has used its edit at the end of its word has found a neighbour.

What keeps the frontier small, and loses nothing:

- Near the root a trie is dense, and any edit leads somewhere. Of two words one edit apart,
  the first or the last half is the same, so there is a trie of the words and one of the
  reversed words, and a walk edits in the second half only. It enters at the node of its
  first half, which is its own prefix, and nodes above are never made.
- An edge with one word below carries that word; the walk ends there and the two words are
  compared. So only nodes with several words below are kept, and few levels have many.
- Of two words that differ by a replaced character the one with the smaller character walks;
  an inserted character is a skipped one seen from the longer word.

A node has an edge for each character at most, and one row in the join, so the side that
may be skewed, the states, is one that adaptive execution can split.

Words longer than `LONGEST` would need as many levels as characters. They meet by what is left
when a character is taken out, instead: equal places and remainders for a replaced one,
the shorter word itself for a skipped one; all are compared then."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import in_batches, ship, texts
from tablecheck.session import pin

#: Code points and occurrences that a word must have; one document in `EVERY` loses a character.
LEAST_CHARS, LEAST_ROWS, EVERY = 7, 2, 31
#: A form occurs at least so many times as often as its variant.
TIMES = 10
#: Words of more code points are joined by what is left without a character, not by levels.
LONGEST = 48
#: Words held before their counts are handed on, rows of a batch, and characters searched at once.
HELD_WORDS, BATCH_ROWS, CUT_CHARS = 200_000, 1 << 16, 1 << 20

# The characters of a word, once A-Z is lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")


def _cuts(text: str) -> Iterator[str]:
    """The text in pieces that part no word."""
    begin = 0
    while len(text) - begin > CUT_CHARS:
        end = begin + CUT_CHARS
        run = RUN.match(text, end - 1)
        end = run.end() if run else end
        yield text[begin:end]
        begin = end
    yield text[begin:] if begin else text


@lru_cache(maxsize=4)
def _runs(least: int) -> re.Pattern:
    """Whole runs of at least so many characters: one that is shorter matches from none of its places."""
    return re.compile(f"{RUN.pattern[:-1]}{{{max(least, 1)},}}")


def words_of(doc_id: int | None, text: str, every: int = EVERY, least: int = LEAST_CHARS) -> Counter:
    """How often each word of at least `least` code points occurs in a text, A-Z lower-cased.

    Where `every` divides the CRC-32 of `<doc_id>:<word>`, the word has lost the code point at
    that number modulo its length. A NULL id is the empty string there."""
    begin = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for piece in _cuts(text.encode().lower().decode()):
        found.update(_runs(least).findall(piece))
    hashes = ((word, crc32(word.encode(), begin)) for word in found)
    lost = [(word, h % len(word), found[word]) for word, h in hashes if h % every == 0]
    for word, _, _ in lost:
        del found[word]
    for word, at, n in lost:
        if len(word) > least:
            found[word[:at] + word[at + 1 :]] += n
    return found


def _count(every: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in in_batches(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.update(words_of(doc_id, text, every, least))
                if len(held) > HELD_WORDS:
                    yield from _rows(held)
                    held.clear()
        yield from _rows(held)

    return run


def _rows(held: Counter) -> Iterator[pa.RecordBatch]:
    words, counts = list(held), list(held.values())
    for k in range(0, len(words), BATCH_ROWS):
        part = slice(k, k + BATCH_ROWS)
        yield pa.RecordBatch.from_pydict({"word": pa.array(words[part], pa.string()), "n": pa.array(counts[part], pa.int64())})


def word_counts(docs: DataFrame, every: int = EVERY, least_chars: int = LEAST_CHARS, least: int = LEAST_ROWS) -> DataFrame:
    """(word, n): the words with at least `least` occurrences in all texts."""
    ship(docs.sparkSession)
    counted = texts(docs).mapInArrow(_count(every, least_chars), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# --- the trie and the walk ---


def _sided(words: DataFrame) -> DataFrame:
    """(side, word, len): the words, and the words reversed."""
    both = F.explode(F.array(F.struct(F.lit(0).alias("side"), "word"), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("word"))))
    return words.select(both.alias("s")).select("s.side", "s.word", F.length("s.word").alias("len"))


def trie(words: DataFrame) -> DataFrame:
    """(side, depth, node, edges): the nodes with several words below, of the second halves.

    An edge is (c, only): the next character, '' where a word ends, and the word below if there
    is just one."""
    rows = _sided(words).withColumn("depth", F.explode(F.sequence(F.expr("(len - 1) div 2").cast("int"), F.col("len"))))
    rows = rows.select("side", "depth", "word", F.expr("substring(word, 1, depth)").alias("node"), F.expr("substring(word, depth + 1, 1)").alias("c"))
    below = rows.groupBy("side", "depth", "node", "c").agg(F.count("*").alias("n"), F.min("word").alias("word"))
    edge = F.struct("c", F.when(F.col("n") == 1, F.col("word")).alias("only"))
    nodes = below.groupBy("side", "depth", "node").agg(F.sum("n").alias("n"), F.collect_list(edge).alias("edges"))
    return nodes.filter("n > 1").drop("n")


# `c` is the character that the state reads next, `after` the one that follows it.
_FITS = """
concat(
  transform(filter(edges, e -> e.c = c), e -> named_struct('kind', kind, 'c', e.c, 'only', e.only)),
  if(kind = 0 and c != '',
     transform(filter(edges, e -> e.c > c), e -> named_struct('kind', 1, 'c', e.c, 'only', e.only)),
     array()),
  if(kind = 0 and c != '' and c != after,
     transform(filter(edges, e -> e.c = after), e -> named_struct('kind', 2, 'c', e.c, 'only', e.only)),
     array()))
"""


def _step(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """(side, word, kind, node, only) after one more character: `only` where a neighbour is found,
    NULL in states that go on. A kind-2 state has read one character of its word more."""
    held = states.join(nodes, ["side", "node"])
    held = held.withColumns(
        {
            "c": F.expr("substring(word, length(node) + if(kind = 2, 2, 1), 1)"),
            "after": F.expr("substring(word, length(node) + 2, 1)"),
        }
    )
    held = held.select("side", "word", "node", F.expr(f"inline({_FITS})"))
    goes_on = F.col("only").isNull()
    near = (F.col("only") != F.col("word")) & (F.levenshtein("word", "only", 1) == 1)
    return held.filter(goes_on | near).select("side", "word", "kind", F.concat("node", "c").alias("node"), "only")


def _trie_pairs(words: DataFrame) -> list[DataFrame]:
    """(word, other) of words one edit apart, in one direction at least, by level."""
    nodes = pin(trie(words), "trie", by="depth")  # each level reads its own nodes only
    levels = sorted(r.depth for r in nodes.select("depth").distinct().collect())  # at most LONGEST + 1
    found: list[DataFrame] = []
    going: DataFrame | None = None
    for depth in range(levels[0], levels[-1] + 1) if levels else ():
        enter = _sided(words.filter(F.expr(f"length(word) div 2 = {depth}")))
        states = enter.select("side", "word", F.lit(0).alias("kind"), F.expr(f"substring(word, 1, {depth})").alias("node"))
        if going is not None:
            states = states.unionByName(going)
        here = nodes.filter(F.col("depth") == depth).drop("depth")
        level = pin(_step(states, here), f"level-{depth}")
        going = level.filter("only is null").drop("only")
        ahead = F.col("side") == 0
        ends = [F.when(ahead, c).otherwise(F.reverse(c)).alias(n) for c, n in ((F.col("word"), "word"), (F.col("only"), "other"))]
        found.append(level.filter("only is not null").select(*ends))
    return found


# --- long words ---

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _taken_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, len, at, key): for each place of a word the hash of what is left without it; at -1
    that of the whole. Equal remainders have equal hashes; others are told apart later."""
    for batch in in_batches(batches, "word"):
        for word_id, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
            code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
            power = np.ones(len(code) + 1, np.uint64)
            np.multiply.accumulate(np.full(len(code), _BASE), out=power[1:])
            upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * power[:-1], dtype=np.uint64)])
            # what follows the place moves down by one power
            after = np.concatenate([np.cumsum((code * power[:-1])[::-1], dtype=np.uint64)[::-1], np.zeros(1, np.uint64)])
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            keys = np.concatenate([upto[-1:], upto[:-1] + after[1:] * inverse])
            for k in range(0, len(keys), BATCH_ROWS):
                part = keys[k : k + BATCH_ROWS]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.array(np.full(len(part), word_id, np.int64)),
                        "len": pa.array(np.full(len(part), len(code), np.int32)),
                        "at": pa.array(np.arange(k - 1, k - 1 + len(part), dtype=np.int32)),
                        "key": pa.array(part.view(np.int64)),
                    }
                )


def _long_pairs(words: DataFrame) -> DataFrame:
    """(word, other) of long words one edit apart, in one direction at least.

    At most as many words as there are characters share a place and what is left."""
    ids = pin(words.select(F.monotonically_increasing_id().alias("id"), "word"), "long-words")
    keys = pin(ids.mapInArrow(_taken_out, "id bigint, len int, at int, key bigint"), "taken-out")
    places = keys.filter("at >= 0")
    other = places.select(F.col("id").alias("other_id"), "len", "at", "key")
    replaced = places.join(other, ["len", "at", "key"]).filter("id < other_id").select("id", "other_id")
    whole = keys.filter("at = -1").select(F.col("id").alias("other_id"), F.col("len"), "key")
    shorter = places.select("id", (F.col("len") - 1).alias("len"), "key").distinct()
    skipped = shorter.join(whole, ["len", "key"]).select("id", "other_id")
    pairs = replaced.unionAll(skipped).distinct()
    pairs = pairs.join(ids, "id").join(ids.select(F.col("id").alias("other_id"), F.col("word").alias("other")), "other_id")
    return pairs.filter(F.levenshtein("word", "other", 1) == 1).select("word", "other")


def near_words(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(word, other): all pairs of the distinct `words` one inserted, deleted or replaced code
    point apart, in both directions, each once."""
    ship(words.sparkSession)
    found = _trie_pairs(words.filter(F.length("word") <= longest))
    long_ones = words.filter(F.length("word") >= longest)
    if not words.filter(F.length("word") > longest).isEmpty():
        found.append(_long_pairs(long_ones))
    if not found:
        return words.select("word", F.col("word").alias("other")).limit(0)
    pairs = reduce(DataFrame.unionAll, found)
    pairs = pairs.select(F.least("word", "other").alias("word"), F.greatest("word", "other").alias("other")).distinct()
    both = F.array(F.struct("word", "other"), F.struct(F.col("other").alias("word"), F.col("word").alias("other")))
    return pairs.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms (word, form) of a word lead. A form occurs more often than
    its variant, so there are no circles; each round doubles the steps that were followed."""
    reached = pin(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = pin(reached.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = followed.drop("moved")
        if followed.filter("moved").isEmpty():
            return reached


def group_variants(docs: DataFrame, every: int = EVERY, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of `docs`.

    Words are maximal runs of letters up to U+00FF, with A-Z lower-cased, of at least LEAST_CHARS
    code points and LEAST_ROWS occurrences; see `words_of` for the lost characters. `n_near`
    counts the words one edit apart. `form` is the most frequent of them (ties: the least in
    code-point order) if it occurs at least `times` times as often, else NULL; `root` follows
    the forms to the last, and is the word itself without one. NULL and empty texts have no
    words; repeated rows count again; without any words the result is empty."""
    words = pin(word_counts(docs, every), "words")
    near = near_words(words.select("word"))
    near = near.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("form"))).alias("best")
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    held = words.join(near, "word", "left")
    is_form = -F.col("best.n") >= F.col("n") * times
    held = held.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"),
        F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    held = pin(held, "variants")
    roots = _roots(held.filter("form is not null").select("word", "form"))
    return held.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
