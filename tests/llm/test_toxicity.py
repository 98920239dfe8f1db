"""The chain against enumeration, held-out accuracy, spans."""
import itertools
import zlib

import numpy as np
from navrecon.llm import toxicity as tox
from pyspark.sql import functions as F

STEP = np.array([[0.7, 0.2], [0.4, 0.9]])


def enumerated(emission):
    total, toxic = 0.0, np.zeros(len(emission))
    for path in itertools.product((0, 1), repeat=len(emission)):
        p, before = 1.0, 0
        for e, s in zip(emission, path, strict=True):
            p *= STEP[before, s] * (np.exp(e) if s else 1.0)
            before = s
        total += p
        toxic += p * np.array(path)
    return toxic / total


def test_marginals(monkeypatch):
    monkeypatch.setattr(tox, "SEGMENT", 4)
    rng = np.random.default_rng(0)
    lengths = np.array([0, 3, 11, 1, 0, 8, 4])
    emission = rng.normal(size=lengths.sum()) * 2
    got, at = tox.token_marginals(emission, lengths, STEP), 0
    for n in lengths:
        assert np.allclose(got[at:at + n], enumerated(emission[at:at + n]))
        at += n


def test_segments_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    lengths = np.array([1000, 5, 300])
    emission = rng.normal(size=lengths.sum()) * 3
    whole = tox.token_marginals(emission, lengths, STEP)
    monkeypatch.setattr(tox, "SEGMENT", 7)
    assert np.allclose(tox.token_marginals(emission, lengths, STEP), whole)


def planted(spark):
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(900):
        words = ["word%d" % w for w in rng.integers(0, 400, rng.integers(20, 90))]
        bad = i % 3 == 0
        if bad:
            for _ in range(rng.integers(1, 4)):
                words[rng.integers(0, len(words))] = ["Vilefool!", "vileness", "nasty,"][rng.integers(0, 3)]
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out(spark, messy, clashing, empty):
    docs, labels = planted(spark)
    model = tox.train(docs, labels)
    rows = [r for r in tox.score_documents(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r.toxic_score >= 0.5) == (r.doc_id % 3 == 0) for r in rows)
    assert right / len(rows) > 0.97
    for r in rows:
        if r.doc_id % 3 == 0:
            assert any(r.text[s.start:s.end].startswith(("Vile", "vile", "nasty")) for s in r.toxic_spans)
    for df in (messy, clashing):
        told = tox.score_documents(df, model)
        assert told.count() == df.count() and told.where("toxic_score between 0 and 1").count() == df.count()
    assert tox.score_documents(empty, model).count() == 0


def test_held_out_labels_are_not_read(spark):
    docs, labels = planted(spark)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tox.train(docs, labels) == tox.train(docs, flipped)


def test_without_labels(spark, messy, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert tox.train(messy, none) is None
    assert {r.toxic_score for r in tox.score_documents(messy, None).collect()} == {0.0}
    odd = spark.createDataFrame([(None, 1), (1, None), (4, 0), (4, 0), (777, 1)], "doc_id long, toxic int")
    assert tox.train(messy, odd) is None
    assert tox.train(empty, odd) is None


def test_spans_are_code_points():
    model = {"weights": {zlib.crc32(b"=bad"): 9.0}, "bias": -4.0, "step": STEP.tolist(), "score": [0.0, 10.0, 0.0, 0.0]}
    scores, spans = tox.Scorer(model)(["İé 🙂 BAD, ok\nbad", "", "fine"])
    assert spans == [[(5, 9), (13, 16)], [], []] and scores[0] > 0.5 > scores[1]
