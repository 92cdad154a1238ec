"""Toxicity against held-out labels, and what is not there to learn from."""

from __future__ import annotations

import random
import zlib

from mapledger.llm import toxicity

DOCS = "doc_id long, text string, score double"


def corpus(n: int):
    rng = random.Random(4)
    syllables = ["ba", "di", "lo", "ne", "tu", "ra", "si", "mo"]
    bad = ["wretchful", "scumbag", "dirtlord", "vileness", "trashface"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(rng.randrange(20, 120))]
        toxic = rng.random() < 0.2
        for _ in range(4 * toxic):
            words[rng.randrange(len(words))] = rng.choice(bad)
        docs.append((i, " ".join(words), 0.5))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(engine):
    docs, labels = corpus(1500)
    odd = [(None, None, 0.0), (9001, "", 0.0), (9002, None, 0.0), (9003, "x " * 50_000, 0.0), docs[0]]
    frame = engine.createDataFrame(docs + odd, DOCS)
    marks = engine.createDataFrame([*labels, (0, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity_report(frame, marks).toPandas()
    assert len(got) == len(docs) + len(odd) and got.score.between(0, 1).all()
    known = got.dropna(subset="doc_id").astype({"doc_id": int}).set_index("doc_id")
    assert (known.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in known.index]).all()
    test = [(label, known.predicted[i]) for i, label in labels if i and zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(a == b for a, b in test) >= 0.97 * len(test)
    assert (known.predicted == (known.score >= 0.5)).all()
    assert known.predicted[9001] == known.predicted[9002] == known.predicted[9003] == 0


def test_short_words(engine):
    """Toxic words of three letters are learnt and found; no byte of a word is left out."""
    assert toxicity.windows(b"a Abc abcdefghijklmn") == [b" a a a", b" abc abc", b" abcdefghijk", b"cdefghijklmn"]
    rng = random.Random(6)
    docs, labels = corpus(1500)
    bad = ["wretchful", "scumbag", "dirtlord", "vileness", "trashface"]
    short = dict(zip(bad, ["zok", "qix", "fug", "vex", "wup"], strict=True))
    docs = [(i, " ".join([*(short.get(w, w) for w in text.split()), *rng.choices(["the", "of", "an"], k=9)]), x) for i, text, x in docs]
    frame, marks = engine.createDataFrame(docs, DOCS), engine.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity_report(frame, marks).where("held_out").collect()}
    assert sum(label == got[i] for i, label in labels if i in got) >= 0.95 * len(got)


def test_copies_do_not_fill_the_sample(engine, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 30)
    docs, labels = corpus(200)
    marks = engine.createDataFrame(labels, "doc_id long, toxic int")
    toxic = [d for d in docs if (d[0], 1) in labels]
    once, often = (toxicity.fit_toxicity(engine.createDataFrame(rows, DOCS), marks) for rows in (docs, docs + 40 * toxic))
    assert once == often


def test_one_class_or_nothing(engine):
    docs, labels = corpus(30)
    frame = engine.createDataFrame(docs, DOCS)
    none = engine.createDataFrame([], "doc_id long, toxic int")
    one = engine.createDataFrame([(i, 0) for i, _ in labels], "doc_id long, toxic int")
    for marks in (none, one):
        assert {r.predicted for r in toxicity.toxicity_report(frame, marks).collect()} == {0}
    assert toxicity.toxicity_report(frame.limit(0), one).count() == 0


def test_few_texts(engine):
    docs, labels = corpus(40)
    frame, marks = engine.createDataFrame(docs, DOCS), engine.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.toxicity_report(frame, marks).count() == 40
    assert toxicity.drop_toxic(frame, marks).columns == frame.columns
