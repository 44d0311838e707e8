"""The pipeline as a whole, and what each stage leaves."""

import numpy as np
import public_tokenizers
from test_near_duplicates import brute

import corpus_pipeline
from tablecheck.llm import queries, secret_scan

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = queries.table(spark, SF, "documents")
    given, columns = docs.count(), docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.pin(stage(spark, docs, SF), "stage")
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert 0 < len(kept[name]) <= given
    before, after = kept["toxicity"], kept["near duplicates"]
    groups = brute(list(before.values()), 5, 80)
    least = {}
    for doc_id, (_, group) in zip(before, groups, strict=True):
        least[group] = min(doc_id, least.get(group, doc_id))
    assert set(after) == set(least.values())
    assert kept["secret scans"].keys() == after.keys()
    assert not any(secret_scan.find(t) for t in kept["secret scans"].values())
    assert all(t == after[i] or secret_scan.MASK in t for i, t in kept["secret scans"].items())


def test_run_packs_what_is_left(spark):
    from tokenizers import Tokenizer

    rows = corpus_pipeline.run(spark, SF).collect()
    totals, docs = {}, {}
    for r in rows:
        totals[r.sequence_id] = totals.get(r.sequence_id, 0) + r.length
        docs[r.doc_id] = docs.get(r.doc_id, 0) + r.length
        assert r.doc_tokens >= r.length
    assert all(t == 2048 or t < 2048 and t & (t - 1) == 0 for t in totals.values())
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    same = [i for i in docs if not secret_scan.find(texts[i])]
    assert np.all([docs[i] == len(library.encode(texts[i], add_special_tokens=False).ids) + 1 for i in same])


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
