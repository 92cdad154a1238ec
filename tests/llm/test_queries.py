"""Registered queries against their SQL, and the pipeline's stages, on small given tables."""

from __future__ import annotations

import brute
import pytest

import corpus_pipeline
from checks.compare import TESTDATA, compare, connect
from mapledger.llm import packing, simhash, toxicity
from mapledger.llm.common import table
from mapledger.llm.queries import ORACLES, QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(engine, name):
    good, text = compare(engine, connect(SF_DIR), name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert good, text


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


def test_pipeline_against_plain_stages(engine):
    """Every stage but the scores, which are the operator's, by its plain version."""
    docs = table(engine, SF_DIR, "documents")
    model = toxicity.fit_toxicity(docs, table(engine, SF_DIR, "labels"))
    kept = docs.where(toxicity.toxicity_score(model) < 0.5).select("doc_id", "text").collect()
    prints = {r.doc_id: brute.simhash(r.text) for r in kept}
    least = brute.reachable(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    rows = [(r.doc_id, r.text) for r in kept if least[r.doc_id] == r.doc_id]
    items = [tuple(r) for r in table(engine, SF_DIR, "benchmark").select("item_id", "text").collect()]
    bad = {d for d, *_ in brute.contained(rows, items)}
    clean = []
    for d, text in rows:
        if d not in bad:
            out, at = "", 0
            for a, b, _ in brute.secret_spans(text):
                if a >= at:
                    out += text[at:a] + "[SECRET]"
                at = max(at, b)
            clean.append((d, out + text[at:]))
    want = packing.token_pieces(engine.createDataFrame(clean, "doc_id long, text string"), 2048, packing.public_tokenizers.path(packing.TOKENIZER))
    got = corpus_pipeline.run(engine, SF_DIR)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert bad or simhash.MOST_BITS == 3


def test_stages_of_nothing(engine):
    docs = table(engine, SF_DIR, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(engine, docs, SF_DIR)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == docs.columns
