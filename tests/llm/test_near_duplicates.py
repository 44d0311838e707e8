"""The Jaccard join and the fingerprints against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import AWKWARD, docs_of, prose

from tablecheck.llm import jaccard_join, spotsigs
from tablecheck.llm.components import components


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                u, v = find(i), find(j)
                root[max(u, v)] = min(u, v)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def edited(text, seed, n):
    draw, words = random.Random(seed), text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def corpus():
    """Copies, chains of edits, near the threshold on both sides, and a passage many share."""
    out = list(AWKWARD)
    passage = prose(99, 60)
    for k in range(12):
        base = prose(100 + k, 40 + 25 * k)
        out += [base, base.upper(), edited(base, k, 1), edited(edited(base, k, 2), k + 50, 2), edited(base, k, 12)]
    chain = prose(7, 400)
    for k in range(30):
        out.append(chain)
        chain = edited(chain, k, 4)
    crowd = prose(8, 200)
    out += [edited(crowd, k, 2 + k % 4) for k in range(60)]
    out += [f"{prose(300 + k, 5 + k % 40)} {passage} {prose(400 + k, k % 7)}" for k in range(60)]
    return out


@pytest.mark.parametrize("k,percent,crowd", [(3, 90, 4), (5, 80, 4), (3, 90, 1), (3, 60, 16)])
def test_components_equal_brute_force(spark, k, percent, crowd, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", crowd)
    texts = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_documents(docs_of(spark, texts), k, percent).collect()}
    want = brute(texts, k, percent)
    assert got == {i: (n, c) for i, (n, c) in enumerate(want)}


def test_shared_and_missing_ids(spark):
    a, b = prose(1, 50), prose(2, 50)
    docs = docs_of(spark, [a, b, a, a, b, "", None], [5, 5, 9, None, None, 3, 3])
    got = sorted(((r.doc_id, r.n_shingles > 0, r.component_id) for r in jaccard_join.link_documents(docs, 3, 90).collect()), key=str)
    assert got == sorted(
        [(5, True, 5), (5, True, 5), (9, True, 5), (None, True, 5), (None, True, 5), (3, False, 3), (3, False, 3)], key=str
    )


def test_one_of_each_group_stays(spark):
    a, b = prose(1, 80), prose(2, 80)
    docs = docs_of(spark, [a, edited(a, 1, 1), b, b, "", None, a], [4, 2, 7, 7, 8, 9, 11])
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 8, 9]
    assert jaccard_join.one_of_each(docs_of(spark, [])).collect() == []


@pytest.mark.parametrize("block", [400, 1 << 18])
def test_links_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ELEMENTS", block)
    monkeypatch.setattr(jaccard_join, "PRODUCT_ELEMENTS", 64)
    crowd = prose(8, 60)
    texts = [*(edited(crowd, k, 1 + k % 3) for k in range(12)), crowd, crowd.upper(), crowd, "", None, prose(9, 60), "one", "one"]
    ids = [*range(15), 3, 3, None, 40, 40]
    sets = [shingles(t, 3) for t in texts]
    linked = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    want = [sum(bool(a and b) and i != j and linked(a, b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    assert len(set(want)) > 4
    got = jaccard_join.link_documents(docs_of(spark, texts, ids), 3, 80).collect()
    assert sorted(((r.doc_id, r.n_links) for r in got), key=str) == sorted(zip(ids, want, strict=True), key=str)


def test_one_of_each_tells_texts_that_share_an_id_apart(spark):
    a, b, c, d = (prose(k, 80) for k in (11, 12, 13, 14))
    given = [(a, 5), (b, 5), (c, 5), (edited(a, 1, 1), 3), ("", 5), (None, 5), (b, 5), (b.upper(), 5),
             (d, None), (d, None), (c, None), ("", None)]
    kept = jaccard_join.one_of_each(docs_of(spark, [t for t, _ in given], [i for _, i in given]))
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(((i, (t or "").upper()) for i, t in rows), key=str) == sorted(
        [(3, edited(a, 1, 1).upper()), (5, b.upper()), (5, c.upper()), (5, ""), (5, ""), (None, d.upper()), (None, "")],
        key=str,
    )


def test_one_of_each_keeps_columns_named_like_its_own(spark):
    names = ["__id", "__own_id", "own_id", "own_mark", "id", "mark", "component", "x"]
    docs = docs_of(spark, [prose(1, 60), prose(1, 60), prose(2, 60)]).drop("x")
    odd = docs.withColumns({n: F.lit(f"value of {n}") for n in names})
    rows = jaccard_join.one_of_each(odd).collect()
    assert sorted(r.doc_id for r in rows) == [0, 2]
    assert all(r[n] == f"value of {n}" for r in rows for n in names)


def crowd_pairs(spark, n, percent):
    """The pairs that are looked at among n copies of one text, each edited in eight places."""
    base = prose(77, 300)
    return looked_at_pairs(docs_of(spark, [edited(base, k, 8) for k in range(n)]), 3, percent)


def looked_at_pairs(docs, words, percent):
    seen = []
    measure = jaccard_join._Measure.__call__

    def counted(self, pairs):
        seen.append(pairs.count())
        return measure(self, pairs)

    jaccard_join._Measure.__call__ = counted
    try:
        jaccard_join.classes(docs, lambda: jaccard_join.shingles(words), percent).count()
    finally:
        jaccard_join._Measure.__call__ = measure
    return sum(seen)


def test_pairs_of_a_crowd_grow_with_its_size(spark):
    """Copies that are too different to link are hardly compared."""
    few, many = crowd_pairs(spark, 100, 90), crowd_pairs(spark, 400, 90)
    assert few <= 500 and many <= 2000


def test_a_crowd_is_joined_from_its_centre(spark):
    """Of copies with up to eight edits, those with few link with most others and are pivots first."""
    base = prose(78, 150)
    texts = [edited(base, k, k % 9) for k in range(300)]
    assert looked_at_pairs(docs_of(spark, texts), 5, 80) <= 300
    rows = jaccard_join.link_documents(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in rows] == brute(texts, 5, 80)


def test_one_of_each_with_one_id_on_all_rows(spark):
    texts = [prose(500 + k, 60) for k in range(20)]
    kept = jaccard_join.one_of_each(docs_of(spark, [*texts, *texts], [7] * 40))
    assert sorted(r.text for r in kept.collect()) == sorted(texts)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(3, 3), (None, 4)]
    got = {r.a: r.b for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {k: 100 for k in range(101, 161)} | {k: 5 for k in range(6, 40)}


def test_nearest_elements_hold_a_common_one():
    """The window of regions, on random pairs at and above the threshold."""
    draw = np.random.default_rng(2)
    for percent in (80, 90):
        for n in range(1, 80):
            a = np.sort(draw.choice(10_000, n, replace=False))
            less = draw.permutation(a)[: n - n * (100 - percent) // 100]
            b = np.sort(np.concatenate([less, 20_000 + np.arange(0)]))
            if 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)):
                first = [set(x[: jaccard_join.nearest(len(x), percent)]) for x in (a, b)]
                assert first[0] & first[1]


# --- fingerprints ---


def test_neighbours_equal_brute_force(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    texts = corpus()
    ids = list(range(0, 3 * len(texts), 3))
    got = {r.doc_id: r for r in spotsigs.against_neighbours(docs_of(spark, texts, ids)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    set_of = spotsigs.SpotSigs()
    assert len(got) == len(texts)
    for k, (i, text) in enumerate(zip(ids, texts, strict=True)):
        text, following = text or "", texts[(k + 1) % len(texts)] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        sets = [set(set_of(t).tolist()) for t in (text, changed, following)]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r.near_edited == pytest.approx(like(sets[0], sets[1]))
        assert r.near_next == pytest.approx(like(sets[0], sets[2]))
        assert set(spotsigs.signatures_of(r.fingerprint).tolist()) == sets[0]


def test_one_row_no_row_and_rows_without_ids(spark):
    one = spotsigs.against_neighbours(docs_of(spark, ["the stone of a river and the cloud"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert spotsigs.against_neighbours(docs_of(spark, [])).collect() == []
    odd = docs_of(spark, ["b c", None, "a b", "a b"], [None, 4, 4, 4])
    assert len(spotsigs.against_neighbours(odd).collect()) == 4


def test_signatures():
    set_of = spotsigs.SpotSigs()
    same = set_of("The river, of stone and CLOUD falls.")
    assert len(same) and (same == set_of("the river of stone and cloud falls")).all()
    assert len(set_of("")) == len(set_of(" . ! ")) == 0
    assert len(set_of("river stone")) and len(set_of("word")) == 1


def test_pruned_jaccard():
    draw = np.random.default_rng(1)
    for _ in range(60):
        pool = np.unique(draw.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2))
        a, b = (np.sort(draw.permutation(pool)[: draw.integers(1, len(pool))]) for _ in range(2))
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        for least in (0.0, 0.3, 0.6):
            assert spotsigs.pruned_jaccard(a, b, least) == pytest.approx(exact if exact >= least else 0.0)


def test_near_duplicates_by_signatures(spark):
    base = "the river of stone and the cloud in a sky with the bird on a tree " * 1 + prose(5, 200)
    rows = spotsigs.near_duplicates(docs_of(spark, [base, base + " the end of it", prose(6, 200), None])).collect()
    found = {r.doc_id: r.component for r in rows}
    assert found[0] == found[1] != found[2] and found[3] is None
