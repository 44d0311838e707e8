"""BPE, token counts and packing against the libraries themselves."""

import hashlib
import zlib

import numpy as np
import pytest
import public_tokenizers
from texts import AWKWARD, docs_of, prose

from tablecheck.llm import bpe, packing, token_counts

FILE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [64, 32_768])
def test_encode_and_decode_as_the_library(spark, library, leaf):
    docs = docs_of(spark, AWKWARD)
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, FILE, leaf), FILE).collect()}
    for i, text in enumerate(AWKWARD):
        ids = ids_of(library, text)
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids, repr(text)[:60]
        assert got[i].text == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("leaf", [8, 20, 100])
def test_tree_equals_encoding_in_one_piece(library, leaf):
    own = bpe.ByteBpe(FILE, leaf)
    unsplit = [
        "abcdefghij" * 60, "aaaa" * 200, "don't" * 90, "''s'" * 120, "1234567890" * 50, "!?" * 300, " " * 700, "\n \n" * 200,
        "übergrößenträger" * 40, "日本語のテキスト" * 40, "x<|endoftext|>y" * 40, "a1!b2?c3-" * 70, prose(5, 200).replace(" ", ""),
        "the  end   of    it" * 30,
    ]
    for text in unsplit:
        assert own.tree(text) == library.encode(text, add_special_tokens=False).ids, text[:30]


def test_tree_over_spark_keeps_copies_and_shared_ids(spark, library):
    long = "abcdefghij" * 90
    docs = docs_of(spark, [long, long, long[:-1], long + " end", None], [1, 1, 1, None, None])
    got = sorted((r.doc_id or -1, len(r.ids) // 4) for r in bpe.encode(docs, FILE, leaf=100).collect())
    want = sorted((i, len(ids_of(library, t))) for i, t in [(1, long), (1, long), (1, long[:-1]), (-1, long + " end"), (-1, "")])
    assert got == want


def test_bytes_that_are_no_text_decode_as_the_library(spark, library):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(0, 50_257, 40).astype("<u4").tobytes()) for i in range(30)]
    got = bpe.decode(spark.createDataFrame(rows, "doc_id bigint, ids binary"), FILE).collect()
    for r in got:
        assert r.text == library.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False)


def test_empty_tables(spark):
    empty = docs_of(spark, [])
    assert bpe.decode(bpe.encode(empty, FILE), FILE).collect() == []
    assert token_counts.token_counts(empty, MODEL).collect() == []
    assert packing.pack(empty, FILE).collect() == []


def test_counts_as_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in token_counts.token_counts(docs_of(spark, AWKWARD), MODEL).collect()}
    for i, text in enumerate(AWKWARD):
        assert got[i].n_tokens == len(model.encode(text or "")), repr(text)[:60]
        assert got[i].n_bytes == len((text or "").encode())


def check_pieces(pieces, wanted, size):
    """Every id once, no gap in any sequence, no padding but at powers of two."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == wanted.keys()
    for doc_id, rows in by_doc.items():
        rows.sort(key=lambda r: r.start)
        assert b"".join(r.ids for r in rows) == wanted[doc_id]
        at = 0
        for r in rows:
            assert (r.start, r.doc_tokens, r.length) == (at, len(wanted[doc_id]) // 4, len(r.ids) // 4)
            at += r.length
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r.offset)
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
        assert at == size or at < size and at & (at - 1) == 0


@pytest.mark.parametrize("size,pool", [(2048, 2048), (64, 3), (16, 1)])
def test_packing_holds_every_id_once(spark, library, size, pool):
    texts = [*AWKWARD, *(prose(k, k * 7 % 90) for k in range(60))]
    wanted = {i: np.array([*ids_of(library, t), 1], "<u4").tobytes() for i, t in enumerate(texts)}
    pieces = packing.pack(docs_of(spark, texts).repartition(3), FILE, size, 1, pool).collect()
    check_pieces(pieces, wanted, size)


def test_packing_is_the_same_when_a_task_runs_again(spark):
    docs = docs_of(spark, [prose(k, 50 + k) for k in range(40)]).coalesce(1)
    runs = [sorted(map(tuple, packing.pack(docs, FILE, 64).collect()), key=str) for _ in range(2)]
    assert runs[0] == runs[1]


def test_closest_fill_is_the_best_of_all():
    import itertools
    import random

    draw = random.Random(4)
    for _ in range(200):
        counts = {draw.randint(1, 30): draw.randint(1, 3) for _ in range(draw.randint(1, 5))}
        room = draw.randint(30, 60)
        taken = packing.closest_fill(sorted(counts), counts, room)
        assert all(n <= counts[k] for k, n in taken.items())
        sums = {sum(k * n for k, n in zip(counts, c)) for c in itertools.product(*(range(n + 1) for n in counts.values()))}
        assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= room)


def test_queries_on_given_data(spark, library):
    from tablecheck.llm import queries

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, sf, "documents").collect()}
    for r in queries.op3_bpe_round_trip(spark, sf).collect():
        ids = ids_of(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    for r in queries.op5_packing(spark, sf).collect():
        ids = [*ids_of(library, texts[r.doc_id]), 1]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def test_missing_ids_are_told_from_texts(spark, library):
    """A NULL id with a text that begins like another id, through the tree."""
    long = "abcdefghij" * 3
    docs = docs_of(spark, [f"5:{long}", long, f"5:{long}"], [None, 5, 5])
    rows = bpe.encode_tree(docs.select("doc_id", "text"), FILE, leaf=8).collect()
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows), key=str)
    one, two = ids_of(library, f"5:{long}"), ids_of(library, long)
    assert got == sorted([(None, one), (5, two), (5, one)], key=str)
