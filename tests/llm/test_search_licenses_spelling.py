"""Ranked search, license scans and spelling variants against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from texts import AWKWARD, docs_of, prose

from tablecheck.llm import license_scan, ranked_search, spelling_variants
from tablecheck.session import pin

LOWER = str.maketrans(license_scan.UPPER, license_scan.LOWER)


def bag(rows):
    return Counter(map(tuple, rows))


# --- ranked search ---

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, most=20):
    """All scores, one by one."""
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, ws, Counter(ws)) for i, ws in held if ws]
    n_docs, n_terms = len(held), sum(len(ws) for _, ws, _ in held)
    df = Counter(t for _, _, c in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for i, ws, c in held:
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 75 + (25 * len(ws) * n_docs) // n_terms
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item_id, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores)[:most])]
    return out


def search_texts():
    out = list(AWKWARD) + [prose(k, 5 + k * 3 % 90) for k in range(150)]
    out += ["stone river cloud"] * 40  # ties
    return out + ["Stone, RIVER; cloud!", "élan vital 12 3", "日本語 river", "river " * 3000]


ITEMS = [
    (0, "stone river cloud"), (1, "Élan Straße 12"), (2, None), (3, ""), (4, "nowhereword"), (5, "river river it's"),
    (5, "river river it's"), (None, "日本語のテキスト one two"), (7, prose(1, 60)), (8, "!!! ..."),
]


def test_search(spark):
    texts = search_texts()
    ids = [None if k in (60, 61) else k if k % 9 else 9 for k in range(len(texts))]
    docs = docs_of(spark, texts, ids).withColumnRenamed("x", "rank").repartition(5)
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id bigint, text string, score int")
    found = ranked_search.search(docs, items)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert bag(found.collect()) == bag(brute_search(list(zip(ids, texts)), ITEMS))


def test_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 3)
    texts = search_texts()[:60]
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = ranked_search.search(docs_of(spark, texts), items, most=3)
    assert bag(found.collect()) == bag(brute_search(list(enumerate(texts)), ITEMS, 3))


def test_search_nothing(spark):
    none, items = docs_of(spark, []), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert ranked_search.search(none, items).count() == 0
    assert ranked_search.search(docs_of(spark, [None, "", "!"]), items).count() == 0
    assert ranked_search.search(docs_of(spark, ["river"]), items.limit(0)).count() == 0


@pytest.mark.parametrize("shape", [(1, 1), (1, 9), (7, 1), (5, 40), (33, 64), (20, 300)])
def test_treap_finds_the_best(shape):
    draw = np.random.default_rng(sum(shape))
    dense = np.where(draw.random(shape) < 0.3, draw.integers(1, 9, shape), 0)
    rows, columns = np.nonzero(dense)
    grid = ranked_search.K2Treap(rows, columns, dense[rows, columns], *shape)
    ids = np.sort(draw.choice(10_000, shape[1], replace=False))
    for _ in range(10):
        asked = draw.choice(shape[0], draw.integers(1, shape[0] + 1), replace=False)
        weights = draw.integers(1, 5, len(asked))
        scores = weights @ dense[asked]
        for most in (1, 4, 1000):
            top = []
            grid.best(asked, weights, ids, top, most)
            expected = sorted(((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if s > 0))[:most]
            assert sorted((-s, -i) for s, i, _ in top) == expected


def test_treap_closes_ranges():
    """One document holds far more than any other, so most cells are not looked at."""
    columns = np.arange(4096)
    heavy = np.where(columns == 77, 1000, 1)
    grid = ranked_search.K2Treap(np.zeros(4096, np.int64), columns, heavy, 1, 4096)
    seen = []
    below = grid.below
    grid.below = lambda cells, quarter: (seen.append(len(cells)), below(cells, quarter))[1]
    top = []
    grid.best(np.zeros(1, np.int64), np.ones(1, np.int64), columns, top, 1)
    assert [(s, -i) for s, i, _ in top] == [(1000, 77)] and sum(seen) < 4096 / 2


def test_small_grids_give_the_same(monkeypatch):
    texts = [prose(k, 30) for k in range(80)]
    items = [prose(k, 12) for k in range(6)]
    number = {t: k for k, t in enumerate(sorted({t.encode() for i in items for t in terms(i)}))}
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(80), pa.int64()), "text": pa.array(texts)})
    parts = [p for k in range(0, 80, 10) for p in ranked_search._counted(number)(iter([batch.slice(k, 10)]))]
    asked = []
    for text in items:
        rows, times = np.unique(np.array([number[t.encode()] for t in terms(text)]), return_counts=True)
        asked.append(ranked_search.Item(0, rows, times))
    weights, place = np.arange(1, len(number) + 1), np.arange(len(number))

    def run():
        found = ranked_search._searched(asked, weights, place, 80, 2400, 5)(iter(parts))
        return sorted(tuple(r.values()) for b in found for r in b.to_pylist())

    whole = run()
    monkeypatch.setattr(ranked_search, "GRID_DOCS", 10)
    assert run() == whole and len(whole) > 10


def test_impacts_beyond_64_bits():
    n, tf = np.array([10**7, 5]), np.array([3, 1])
    found = ranked_search.impacts(tf, n, 10**11, 10**14)
    exact = [(10**9 * t) // (1000 * t + 12 * (75 + 25 * x * 10**11 // 10**14)) for t, x in ((3, 10**7), (1, 5))]
    assert found.tolist() == exact


def test_pieces_part_no_term(monkeypatch):
    monkeypatch.setattr(ranked_search, "_PIECE", 7)
    text = "abc defghijklmnop qr  s " * 5 + "last"
    assert [t.decode() for piece in ranked_search.terms_of(text) for t in piece] == terms(text)


# --- license scans ---

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_blocks(text, templates, percent):
    ws = license_words(text)
    out = {}
    for s in range(0, len(ws), license_scan.STRIDE):
        block = set(ws[s : s + license_scan.WINDOW])
        for label, t in templates:
            held = set(license_words(t))
            if held and 100 * len(block & held) >= percent * len(held):
                key = (s, min(s + license_scan.WINDOW, len(ws)), label)
                out[key] = max(out.get(key, 0), len(block & held) / len(held))
    return [(*k, v) for k, v in out.items()]


def brute_license(text):
    ws = license_words(text)
    places = []
    for phrase, label in license_scan.PHRASES:
        p = phrase.split(" ")
        places += [(i, label) for i in range(len(ws)) if ws[i : i + len(p)] == p]
    blocks = brute_blocks(text, license_scan.TEMPLATES, license_scan.PERCENT)
    base, at = sorted({x for _, x in places}), [i for i, _ in places]
    score = 1.0 if places else max([b[3] for b in blocks], default=0.0)
    both = sorted({*base, *(b[2] for b in blocks)})
    return (len(ws), len(places), min(at, default=None), max(at, default=None), ",".join(base), ",".join(both), score)


def license_texts():
    notices = [t for _, t in license_scan.TEMPLATES]
    out = list(AWKWARD) + notices + [p for p, _ in license_scan.PHRASES]
    out += [prose(k, k * 11 % 200) + "\n" + t + "\n" + prose(k + 50, k * 7 % 90) for k, t in enumerate(notices * 3)]
    draw = random.Random(3)
    for t in notices * 3:  # some words go, some come between
        ws = [w for w in t.split() if draw.random() > 0.05]
        out.append(" ".join(w + (" filler" if draw.random() < 0.2 else "") for w in ws))
    out += ["CC-BY cc by cc BY cc", "mit\nLicense mit mit license", "MIT License " * 400, "apache élicense apache license"]
    out += ["gnu general public license gnu general public", "2 0 3 4 5 1 sa nc by the of free any"]
    return out


def test_license_scan(spark):
    texts = license_texts()
    ids = [None if k % 17 == 3 else k // 2 for k in range(len(texts))]
    docs = docs_of(spark, texts, ids).withColumnRenamed("x", "words").withColumnRenamed("score", "row").repartition(3)
    found = license_scan.scan(docs).collect()
    assert bag(found) == bag([(i, *brute_license(t)) for i, t in zip(ids, texts)])
    assert license_scan.scan(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("percent", [40, 70, 100])
def test_license_blocks(spark, percent):
    texts = license_texts()
    found = license_scan.license_blocks(docs_of(spark, texts), percent=percent).collect()
    expected = [(i, *b) for i, t in enumerate(texts) for b in brute_blocks(t, license_scan.TEMPLATES, percent)]
    assert bag(found) == bag(expected) and expected


def test_own_templates(spark):
    own = [("house", "For internal use only"), ("none", "...")]
    found = license_scan.license_blocks(docs_of(spark, ["only for internal use", "internal only", None]), own, 100)
    assert [tuple(r) for r in found.collect()] == [(0, 0, 4, "house", 1.0)]


def test_license_scan_is_native(spark):
    plan = license_scan.scan(docs_of(spark, ["x"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan.partition("Scan")[0])


# --- spelling variants ---

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, every):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    at = next((k for k in range(len(b)) if a[k] != b[k]), len(b))
    return a[at + 1 :] == (b[at + 1 :] if len(a) == len(b) else b[at:])


def brute_variants(rows, every=31):
    counts = brute_words(rows, every)
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, n, len(near[w]), forms[w], counts.get(forms[w]), root))
    return out


def spelling_rows():
    draw = random.Random(5)
    stems = ["".join(draw.choice("abcdé") for _ in range(draw.randint(6, 12))) for _ in range(25)]
    words = []
    for stem in stems:
        words += [stem] * draw.choice([1, 3, 40, 400])
        for _ in range(6):
            at, c = draw.randrange(len(stem)), draw.choice("abcdéÀß")
            words += [draw.choice([stem[:at] + c + stem[at + 1 :], stem[:at] + stem[at + 1 :], stem[:at] + c + stem[at:]])] * draw.choice([1, 2, 5, 30])
    chain = ["letters", "lettersa", "lettersab", "lettersabc"]
    words += [w for k, w in enumerate(chain) for _ in range(2 * 10**k)]
    words += ["aaaaaaaa", "aaaaaaa", "aaaaaaab", "baaaaaaa", "LetterS"] * 2
    draw.shuffle(words)
    rows = [(k, " ".join(words[p : p + 50]) + "\n") for k, p in enumerate(range(0, len(words), 50))]
    return rows + [(None, "Variants variants vAriants"), (3, None), (4, ""), (9, "short one 12345678"), (9, "short one 12345678")]


def test_variants(spark):
    rows = spelling_rows()
    docs = docs_of(spark, [t for _, t in rows], [i for i, _ in rows]).withColumnRenamed("x", "word").withColumnRenamed("score", "n")
    found = spelling_variants.group_variants(docs.repartition(4))
    held = found.select("word", "n", "n_near", "form", "form_n", "root").collect()
    expected = brute_variants(rows)
    assert bag(held) == bag(expected)
    assert any(r[3] and r[5] != r[3] for r in expected) and any(r[2] > 3 for r in expected)


def test_no_words(spark):
    for texts in ([], [None, "", "a b c"], ["oncealone"]):
        assert spelling_variants.group_variants(docs_of(spark, texts)).count() == 0


def test_long_words(spark):
    draw = random.Random(1)
    base = "".join(draw.choice("abcde") for _ in range(300))
    words = [base, base[:10] + "z" + base[11:], base[:-1], base + "x", "q" + base, base[:150] + base[151:], "b" * 2000, "b" * 1999, "b" * 1998]
    words += ["c" * k for k in range(44, 54)] + ["c" * 20 + "d" + "c" * 27, "c" * 48 + "d", "d" + "c" * 47]
    assert len(set(words)) == len(words)
    held = spark.createDataFrame([(w,) for w in words], "word string")
    found = spelling_variants.near_words(held).collect()
    assert bag(found) == bag([(a, b) for a in words for b in words if one_edit(a, b)])


@pytest.mark.parametrize("longest", [7, 9, 48])
def test_trie_and_remainders_agree(spark, longest):
    draw = random.Random(longest)
    words = sorted({"".join(draw.choice("ab") for _ in range(draw.randint(7, 11))) for _ in range(250)})
    held = spark.createDataFrame([(w,) for w in words], "word string")
    found = spelling_variants.near_words(held, longest).collect()
    assert bag(found) == bag([(a, b) for a in words for b in words if one_edit(a, b)])


def test_cuts_part_no_word(monkeypatch):
    monkeypatch.setattr(spelling_variants, "CUT_CHARS", 5)
    text = "a wordthatislong and others, " * 4 + "x" * 30
    assert spelling_variants.words_of(1, text, every=10**9, least=1) == Counter(RUN.findall(text))


def test_a_level_reads_its_own_nodes_only(spark, monkeypatch):
    staged = {}

    def kept(df, name="stage", **how):
        staged[name] = pin(df, name, **how)
        return staged[name]

    monkeypatch.setattr(spelling_variants, "pin", kept)
    words = spark.createDataFrame([("aaaaaaab",), ("aaaaaaac",), ("bbbbbbbbbb",), ("bbbbbbbbbc",)], "word string")
    assert spelling_variants.near_words(words).count() == 4
    depths = [r.depth for r in staged["trie"].select("depth").distinct().collect()]
    assert len(depths) > 1
    files = [{r[0] for r in staged["trie"].filter(F.col("depth") == d).select(F.input_file_name()).collect()} for d in depths]
    assert all(files) and len(set.union(*files)) == sum(map(len, files))
