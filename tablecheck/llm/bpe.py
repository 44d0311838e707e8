"""Byte-level BPE: encoding, decoding, and the tree concatenation of long unsplit text."""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import in_batches, map_texts, ship, texts
from tablecheck.session import pin

#: Code points of unsplit text that are encoded in one piece.
LEAF = 32_768
#: Tokens on either side of a join that the first window holds.
WINDOW = 32
#: Tokens at either end of a window that must come out as they were.
AGREE = 4
#: Unusual words whose ids a worker keeps, and the longest of them.
KEPT_WORDS, KEPT_LENGTH = 100_000, 48

# The split pattern that byte-level vocabularies of this kind are made for.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_BEFORE_WORD = re.compile(r"(?<=\S)(?= \S)")
#: Characters that engines with other Unicode tables might class differently go to the library itself.
_UNUSUAL = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-\\u024f]")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such vocabularies, reversed."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _token_bytes(spec: dict) -> list[bytes]:
    """The bytes that each id stands for."""
    letters, vocab, added = _byte_letters(), spec["model"]["vocab"], spec["added_tokens"]
    out: list[bytes] = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in added)]))
    for token, k in vocab.items():
        known = all(c in letters for c in token)
        out[k] = bytes(letters[c] for c in token) if known else token.encode()
    for t in added:
        out[t["id"]] = t["content"].encode()
    return out


@functools.lru_cache(maxsize=4)
def token_bytes(vocabulary: str) -> list[bytes]:
    """For decoding, which needs no encoder."""
    with open(vocabulary, encoding="utf-8") as f:
        return _token_bytes(json.load(f))


class ByteBpe:
    """Ids as `tokenizers` gives them without added special tokens.

    Texts are encoded by `tiktoken` with the same merges. Where the two might differ the library
    itself is asked: for words with unusual characters, which are cut out at safe places (a space
    between two other characters parts pre-tokens), and for vocabularies that are not plain
    byte-level BPE. Longer stretches than a leaf without a safe place go through the tree."""

    def __init__(self, vocabulary: str, leaf: int = LEAF):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.leaf = leaf
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.fast = self._byte_level(spec)
        self.bytes = _token_bytes(spec)
        self.engine = None
        if self.fast:
            import tiktoken

            added = {t["content"]: t["id"] for t in spec["added_tokens"]}
            ranks = {self.bytes[k]: k for k in vocab.values() if k not in added.values()}
            self.engine = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)
        self.words: dict[str, bytes] = {}

    @staticmethod
    def _byte_level(spec: dict) -> bool:
        model, before, vocab = spec["model"], spec["pre_tokenizer"] or {}, spec["model"]["vocab"]
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        return (
            spec["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and made == sorted(set(made))
            and not any(
                t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"] or re.search(r"\s", t["content"])
                for t in spec["added_tokens"]
            )
        )

    def whole(self, text: str) -> list[int]:
        """Encodes in one piece."""
        if not self.fast or _UNUSUAL.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.engine.encode(text, allowed_special="all")

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.fast:
            return np.array(self.whole(text), "<u4").tobytes()
        if len(text) <= self.leaf and not _UNUSUAL.search(text):
            return self._plain(text)
        out, run = [], []
        for word in _BEFORE_WORD.split(text):
            if len(word) > self.leaf or _UNUSUAL.search(word):
                out += [self._plain("".join(run)), self._odd(word)]
                run = []
            else:
                run.append(word)
        return b"".join([*out, self._plain("".join(run))])

    def _plain(self, text: str) -> bytes:
        return self.engine.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()

    def _odd(self, word: str) -> bytes:
        if len(word) > KEPT_LENGTH:
            return np.array(self.tree(word), "<u4").tobytes()
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        if word not in self.words:
            self.words[word] = np.array(self.whole(word), "<u4").tobytes()
        return self.words[word]

    # --- tree concatenation ---

    def tree(self, text: str) -> list[int]:
        """Halves the text down to leaves and joins their ids upwards."""
        if len(text) <= self.leaf:
            return self.whole(text)
        half = len(text) // 2
        left, right = text[:half], text[half:]
        return self.concat(left, self.tree(left), right, self.tree(right))

    def concat(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """The ids of left + right, from the ids of each.

        Ids away from the join stay: a sequence of tokens is the BPE of its text if each pair
        of neighbours is, and pre-tokens are parted alike on both sides of a sound place. So
        the window around the join is encoded anew, and if its first and last tokens come out
        as they were, it replaces them; if not, the window grows, at the most to all."""
        if not left or not right:
            return left_ids or right_ids
        a_bytes, b_bytes, window = left.encode(), right.encode(), WINDOW
        while True:
            a, a_at = self._back(left_ids, a_bytes, window)
            b, b_at = self._front(right_ids, b_bytes, window)
            ids = self.whole((a_bytes[a_at:] + b_bytes[:b_at]).decode())
            if a == 0 and b == len(right_ids):
                return ids
            if len(ids) >= 2 * AGREE:
                left_ok = a == 0 or ids[:AGREE] == left_ids[a : a + AGREE]
                right_ok = b == len(right_ids) or ids[-AGREE:] == right_ids[b - AGREE : b]
                if left_ok and right_ok:
                    return [*left_ids[:a], *ids, *right_ids[b:]]
            window *= 2

    def _back(self, ids: list[int], data: bytes, window: int) -> tuple[int, int]:
        """The last sound place at least `window` tokens before the end: tokens and bytes there."""
        at, k = len(data), len(ids)
        while k > 0:
            k -= 1
            at -= len(self.bytes[ids[k]])
            if len(ids) - k >= window and self._sound(data, at):
                return k, at
        return 0, 0

    def _front(self, ids: list[int], data: bytes, window: int) -> tuple[int, int]:
        at = 0
        for k, one in enumerate(ids):
            if k >= window and self._sound(data, at):
                return k, at
            at += len(self.bytes[one])
        return len(ids), len(data)

    def _sound(self, data: bytes, at: int) -> bool:
        """Whether text may be encoded apart on either side of this place, or lies inside one
        pre-token there: what comes before does not change how the rest is parted."""
        if not 0 < at < len(data) or data[at] & 0xC0 == 0x80:
            return False
        around = data[max(0, at - 160) : at].decode("utf-8", "ignore"), data[at : at + 160].decode("utf-8", "ignore")
        before, after = around[0][-1:], around[1][:1]
        if not before or not after or "'" in (before, after) or "\x85" in (before, after):
            return False
        both, cut = "".join(around), len(around[0])
        for special in self.specials:
            k = both.find(special, max(0, cut - len(special) + 1))
            if 0 <= k < cut:
                return False
        if before.isspace():
            return around[1][:2].isspace() and len(around[1]) > 1
        return True


@functools.lru_cache(maxsize=4)
def byte_bpe(vocabulary: str, leaf: int = LEAF) -> ByteBpe:
    """One encoder for each worker process."""
    return ByteBpe(vocabulary, leaf)


def _encoder(vocabulary: str, leaf: int):
    def make():
        bpe = byte_bpe(vocabulary, leaf)
        return lambda ids, values: {"doc_id": ids, "ids": pa.array([bpe.encode(t) for t in values], pa.binary())}

    return make


def encode(docs: DataFrame, vocabulary: str, leaf: int = LEAF) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, as little-endian unsigned 32-bit integers.

    `vocabulary` is a path that every executor has. Most texts take one pass without a shuffle.
    A text with a stretch of more than `leaf` code points without a space goes through the
    tree: its leaves are encoded in parallel, then neighbours are joined level by level, each
    level one shuffle, so no task encodes such a text alone. NULL and empty texts have no ids.
    Rows with one id or the same text each give a row; a NULL id stays NULL."""
    docs = texts(docs)
    unsplit = (F.length("text") > leaf) & F.col("text").rlike(f"[^ ]{{{leaf + 1}}}")
    plain = map_texts(docs.filter(~unsplit), _encoder(vocabulary, leaf), "doc_id bigint, ids binary")
    return plain.unionByName(encode_tree(docs.filter(unsplit), vocabulary, leaf))


def encode_tree(docs: DataFrame, vocabulary: str, leaf: int = LEAF) -> DataFrame:
    """`encode` for texts with long unsplit stretches, level by level."""
    ship(docs.sparkSession)
    spark = docs.sparkSession
    copies = pin(docs.groupBy("doc_id", "text").agg(F.count("*").alias("copies")), "unsplit")
    most = copies.agg(F.max(F.length("text"))).first()[0]
    if most is None:
        return spark.createDataFrame([], "doc_id bigint, ids binary")
    # a NULL id is told from a text that begins like one
    own = F.coalesce(F.concat(F.lit("id "), F.col("doc_id").cast("string")), F.lit("none"))
    keyed = copies.withColumn("uid", F.sha2(F.concat(own, F.lit(":"), "text"), 256))
    leaves = keyed.select(
        "uid",
        F.explode(F.expr(f"sequence(0, cast((length(text) - 1) div {leaf} as int))")).alias("node"),
        "text",
    ).select("uid", "node", F.expr(f"substring(text, node * {leaf} + 1, {leaf})").alias("text"))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    schema = "uid string, node int, text string, ids binary"

    def encode_leaves(batches):
        bpe = byte_bpe(vocabulary, leaf)
        for batch in batches:
            ids = [np.array(bpe.whole(t), "<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield batch.append_column("ids", pa.array(ids, pa.binary()))

    level = pin(leaves.repartition(int(width), "uid", "node").mapInArrow(encode_leaves, schema), "leaves")

    def join_pair(rows: pa.Table) -> pa.Table:
        bpe = byte_bpe(vocabulary, leaf)
        rows = rows.sort_by("node").to_pylist()
        one = rows[0]
        if len(rows) == 2:
            ids = [np.frombuffer(r["ids"], "<u4").tolist() for r in rows]
            joined = bpe.concat(rows[0]["text"], ids[0], rows[1]["text"], ids[1])
            one = one | {"text": rows[0]["text"] + rows[1]["text"], "ids": np.array(joined, "<u4").tobytes()}
        return pa.Table.from_pylist([one | {"node": one["node"] // 2}], rows_schema)

    rows_schema = pa.schema([("uid", pa.string()), ("node", pa.int32()), ("text", pa.string()), ("ids", pa.binary())])
    pieces = -(-most // leaf)
    while pieces > 1:
        level = pin(level.groupBy("uid", (F.col("node") / 2).cast("int").alias("pair")).applyInArrow(
            lambda key, rows: join_pair(rows), schema), "level")
        pieces = -(-pieces // 2)
    joined = keyed.join(level.select("uid", "ids"), "uid")
    return joined.select("doc_id", F.explode(F.expr("array_repeat(ids, cast(copies as int))")).alias("ids"))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, text): the text of each row's ids, special tokens included; bytes that
    are no UTF-8 become U+FFFD. NULL ids give an empty text."""
    ship(encoded.sparkSession)
    rows = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))

    def run(batches):
        piece = token_bytes(vocabulary).__getitem__
        for batch in in_batches(batches, "ids"):
            rows = (np.frombuffer(x, "<u4").tolist() for x in batch.column("ids").to_pylist())
            text = [b"".join(map(piece, ids)).decode("utf-8", "replace") for ids in rows]
            yield batch.append_column("text", pa.array(text, pa.string()))

    return rows.mapInArrow(run, "doc_id bigint, ids binary, text string")
