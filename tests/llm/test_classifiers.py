"""Held-out quality of the classifiers, and the cases that texts may hold."""

import tracemalloc
import zlib

import numpy as np
import pytest
from texts import AWKWARD, docs_of

from tablecheck.llm import labelled, quality_classifier, queries, toxicity
from tablecheck.llm.labelled import HELD_OUT, label_ids

SF = "/root/testdata/sf0.1"


def area(scores, labels):
    order = np.argsort(np.argsort(scores))
    n = labels.sum()
    return (order[labels == 1].sum() - n * (n - 1) / 2) / (n * (len(labels) - n))


@pytest.mark.parametrize("make,label,least", [(queries.op7_quality_classifier, "quality", 0.97), (queries.op8_toxicity, "toxic", 0.95)])
def test_held_out(spark, make, label, least):
    rows = make(spark, SF).join(queries.table(spark, SF, "labels"), "doc_id").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    held = rows[rows.held_out]
    assert area(held.score.to_numpy(), held[label].to_numpy()) >= least
    assert (held.predicted == held[label]).mean() >= 0.95
    assert rows.score.between(0, 1).all()


def tables(spark):
    good = [f"the stone of river {k} runs and the cloud is over the hill where {k} birds sing" for k in range(60)]
    bad = [f"BUY{k}!!! NOW!!! $$$ $$$ BUY!!! {k}" for k in range(60)]
    toxic = [f"the stone of river {k} you blockhead and the cloud is over" for k in range(60)]
    texts = [*good, *bad, *toxic, *AWKWARD]
    labels = [(k, int(not 60 <= k < 120), int(120 <= k < 180)) for k in range(180)]
    labels += [(1, 1, 0), (2, None, None), (None, 1, 1)]
    return docs_of(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_small_tables(spark):
    docs, labels = tables(spark)
    quality = {r.doc_id: r for r in quality_classifier.score(docs, quality_classifier.fit(docs, labels)).collect()}
    harm = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(quality) == len(harm) == 180 + len(AWKWARD)
    assert np.mean([quality[k].predicted == (not 60 <= k < 120) for k in range(180)]) > 0.95
    assert np.mean([harm[k].predicted == (120 <= k < 180) for k in range(180)]) > 0.95
    assert quality[180].score == quality[181].score and harm[180].predicted == 0


def test_filters_keep_rows_and_columns(spark):
    docs, labels = tables(spark)
    kept = quality_classifier.keep_good(docs, quality_classifier.fit(docs, labels))
    clean = toxicity.keep_clean(docs, toxicity.fit(docs, labels))
    assert kept.columns == clean.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(60)) and not {r.doc_id for r in clean.collect()} & set(range(125, 175))


def test_samples_are_bounded_by_rows_and_characters(spark, monkeypatch):
    """One id on many texts, long texts that are not drawn from, and repeated rows."""
    ids = [7] * 300 + list(range(100, 130)) + [None] * 3
    texts = [f"text {k}" for k in range(300)] + [f"other {k}" for k in range(28)] + ["x" * 50] * 2 + ["no id"] * 3
    docs = docs_of(spark, texts * 2, ids * 2).repartition(3)
    got = labelled.any_sample(docs, 10, 40)
    assert len(got) == 10 and got == labelled.any_sample(docs.repartition(5), 10, 40)
    assert sum(i == 7 for i, _ in got) <= 1
    everything = labelled.any_sample(docs, 1000, 40)
    held = {i for i in ids if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    assert sorted(everything) == sorted({(i, t) for i, t in zip(ids, texts, strict=True) if i is not None and i not in held and len(t) <= 40})
    labels = spark.createDataFrame([(i, 1, 0) for i in {i for i in ids if i}], "doc_id bigint, quality int, toxic int")
    assert len(labelled.label_sample(docs, labels, "quality", 1, 12, 40)) == 12
    monkeypatch.setattr(labelled, "SAMPLE_CHARS", 60)
    assert 0 < sum(len(t) for _, t in labelled.any_sample(docs, 1000, 40)) <= 60


def test_no_labels_no_rows(spark):
    docs, labels = tables(spark)
    none = labels.limit(0)
    assert {r.score for r in quality_classifier.score(docs, quality_classifier.fit(docs, none)).collect()} == {0.5}
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0}
    empty = docs.limit(0)
    assert quality_classifier.score(empty, quality_classifier.fit(empty, labels)).collect() == []
    assert toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    _, labels = tables(spark)
    ids = {r.doc_id for v in (0, 1) for r in label_ids(labels, "toxic", v).collect()}
    assert ids and all(zlib.crc32(str(i).encode()) % 5 != HELD_OUT for i in ids)


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_vectors_come_from_whole_texts(chunk, monkeypatch):
    monkeypatch.setattr(quality_classifier, "CHUNK", chunk)
    values = [" ".join([*["stone river"] * 1100, *(f"#{k}{j}! ab{k}" for j in range(60))]) for k in range(6)]
    model = quality_classifier.QualityModel()
    model.learn_vectors(values)
    total = np.vstack([np.zeros(quality_classifier.SIZE), *(quality_classifier.index_vector(n) for n in model.rows)])
    index = total.copy()
    for value in values:
        words = value.split()
        for row in (model.lookup(words), [model.rows.get(quality_classifier.shape(w), 0) for w in words]):
            for i in range(len(row)):
                for j in range(max(0, i - quality_classifier.CONTEXT), i):
                    total[row[i]] += index[row[j]]
                    total[row[j]] += index[row[i]]
    total[0] = 0
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    assert np.allclose(model.vectors, total / np.where(norm > 0, norm, 1), atol=1e-4)


def numeric(loss, values, at, step=1e-5):
    """The slope of `loss` along one number of one array of `values`."""
    up, down = ([v.copy() for v in values] for _ in range(2))
    up[at[0]][at[1]] += step
    down[at[0]][at[1]] -= step
    return (loss(up) - loss(down)) / (2 * step)


def test_network_gradient_is_the_slope_of_the_loss():
    draw = np.random.default_rng(3)
    x, y = draw.normal(size=(30, 6)), (draw.random(30) < 0.4).astype(float)
    net = [draw.normal(size=(6, 4)), draw.normal(size=4), draw.normal(size=4), draw.normal(size=1)]

    def loss(n):
        z = np.tanh(x @ n[0] + n[1]) @ n[2] + n[3]
        return np.mean(np.logaddexp(0, z) - y * z) + quality_classifier.DECAY / 2 * sum((p * p).sum() for p in n)

    grads = quality_classifier.QualityModel._gradients(net, x, y)
    for k, part in enumerate(net):
        for at in np.ndindex(part.shape):
            assert grads[k][at] == pytest.approx(numeric(loss, net, (k, at)), abs=1e-6)


def test_risk_gradient_is_the_slope_of_the_risk():
    """Both where the part of the unlabelled is positive and where it is turned round."""
    draw = np.random.default_rng(4)
    p, u = (draw.random((20, 5)) < 0.5).astype(float), (draw.random((50, 5)) < 0.2).astype(float)
    seen = set()
    for prior, b in ((0.1, 0.3), (0.9, -2.0), (0.5, 0.0)):
        w = draw.normal(size=5) + (prior > 0.8) * 3

        def parts(v):
            toxic = [1 / (1 + np.exp(-(r @ v[0] + v[1][0]))) for r in p]
            other = [1 / (1 + np.exp(-(r @ v[0] + v[1][0]))) for r in u]
            return prior * np.mean([1 - s for s in toxic]), np.mean(other) - prior * np.mean(toxic)

        turned = parts([w, np.array([b])])[1] < 0
        seen.add(bool(turned))

        def risk(v):
            first, second = parts(v)
            return (-second if turned else first + second) + toxicity.DECAY / 2 * (v[0] @ v[0])

        grad, slope = toxicity.ToxicityModel._gradients(p, u, w, b, prior)
        values = [w, np.array([b])]
        assert slope == pytest.approx(numeric(risk, values, (1, 0)), abs=1e-6)
        assert [pytest.approx(numeric(risk, values, (0, k)), abs=1e-6) for k in range(5)] == grad.tolist()
    assert seen == {True, False}


def test_temperature_has_the_least_loss():
    draw = np.random.default_rng(5)
    logits = draw.normal(0, 6, 400)
    y = (draw.random(400) < 1 / (1 + np.exp(-logits / 3))).astype(float)
    found = quality_classifier.QualityModel._calibrate(logits, y)
    loss = lambda t: sum(np.log1p(np.exp(-z / t)) if v else np.log1p(np.exp(z / t)) for z, v in zip(logits, y, strict=True))
    tried = np.geomspace(0.25, 8, 400)
    best = min(tried, key=loss)
    assert found == pytest.approx(best, rel=0.07) and 2 < found < 4.5


def test_quality_scores_equal_a_loop(spark):
    docs, labels = tables(spark)
    model = quality_classifier.fit(docs, labels)
    assert model.net is not None
    got = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    for doc_id, text in [(r.doc_id, r.text) for r in docs.collect()]:
        words = (text or "").split()
        vectors = [model.vectors[model.rows.get(w) or model.rows.get(quality_classifier.shape(w), 0)].astype(float) for w in words]
        x = np.zeros(2 * quality_classifier.SIZE + 5)
        if words:
            mean = sum(vectors) / len(words)
            x[: len(mean)] = mean
            x[len(mean) : 2 * len(mean)] = [np.sqrt(max(0, sum(v[k] ** 2 for v in vectors) / len(words) - mean[k] ** 2)) for k in range(len(mean))]
            lines = [t for t in text.split("\n") if t.strip()]
            x[2 * len(mean) :] = [
                np.log(1 + len(words)) / 10,
                len(set(words)) / len(words),
                sum(a == b for a, b in zip(words, words[1:])) / len(words),
                np.log(1 + sum(map(len, words)) / len(words)),
                1 - len(set(lines)) / len(lines),
            ]
        x = (x - model.mean) / model.scale
        hidden = [np.tanh(sum(x[i] * model.net[0][i, h] for i in range(len(x))) + model.net[1][h]) for h in range(len(model.net[1]))]
        z = sum(hidden[h] * model.net[2][h] for h in range(len(hidden))) + model.net[3][0]
        assert got[doc_id] == pytest.approx(1 / (1 + np.exp(-(z / model.temperature + model.shift))), abs=2e-3)


def test_toxicity_scores_equal_a_loop(spark):
    docs, labels = tables(spark)
    model = toxicity.fit(docs, labels)
    assert model.members
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for doc_id, text in [(r.doc_id, r.text) for r in docs.collect()]:
        letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        held = {f for w in letters.split() for f in (w, *(w[:n] + "*" for n in toxicity.BEGINNINGS if len(w) > n))}
        own = []
        for w, b in model.members:
            z = b + sum(w[k] for f, k in model.columns.items() if f in held)
            own.append(1 / (1 + np.exp(-z)))
        assert got[doc_id] == pytest.approx(sum(own) / len(own), abs=1e-5)


def traced_peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_fits_hold_a_word_once(monkeypatch):
    """The driver, which fits, has numbers of words and not a copy for each place they stand at."""
    monkeypatch.setattr(quality_classifier, "CHUNK", 1 << 10)
    values = [" ".join(f"word{(k * 7 + j) % 500}" for j in range(5000)) for k in range(40)]
    assert traced_peak(lambda: quality_classifier.QualityModel().learn_vectors(values)) < 6 << 20


def test_fits_count_only_what_toxic_texts_hold():
    toxic = [f"you blockhead {'ab'[k % 2] * 5}" for k in range(40)]
    other = [" ".join(f"q{chr(97 + k % 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}{'x' * (k // 26)}" for j in range(400)) for k in range(200)]
    model = toxicity.ToxicityModel()
    assert traced_peak(lambda: model.learn(toxic, other, 0.1)) < 8 << 20
    assert {"blockhead", "you"} <= model.columns.keys()
    scores = model.scores(["you blockhead", "qaab qaac"])
    assert scores[0] > 0.5 > scores[1]
