"""The two classifiers: held-out accuracy on the given tables, and odd inputs."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventrill.llm import catalog, langid, quality
from eventrill.llm.common import table
from tests.llm.conftest import DOCS, ODD

SF = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


@given
def test_quality_of_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in catalog.op1_quality_classifier(spark, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    held = [(rows[d]["predicted"], q) for d, q in labels.items() if rows[d]["held_out"]]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())


@given
def test_language_of_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in catalog.op7_language_id(spark, SF).collect()}
    langs = {r["doc_id"]: r["lang"] for r in table(spark, SF, "documents").collect()}
    held = [(r["lang_pred"], langs[d]) for d, r in rows.items() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    assert len(held) > 150 and np.mean([p == w for p, w in held]) > 0.97


def test_odd_documents_are_scored(odd_docs, spark):
    labels = spark.createDataFrame(
        [(3, 1), (3, 1), (4, 1), (8, 1), (13, 0), (14, 0), (5, None), (None, 1), (77, 0), (11, 0), (11, 1)],
        "doc_id bigint, quality int",
    )
    model = quality.fit(odd_docs, labels, F.lit(True))
    rows = quality.score_quality(odd_docs, model).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d for d, _ in ODD)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 5)}) == 1  # no words, the same vector
    kept = quality.keep_good(odd_docs, model, 0.3)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["score"] >= 0.3}


def test_without_labels_or_documents(odd_docs, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.score_quality(odd_docs, quality.fit(odd_docs, none, F.lit(True))).collect()} == {0.5}
    empty = spark.createDataFrame([], DOCS)
    assert quality.score_quality(empty, quality.fit(empty, none, F.lit(True))).count() == 0
    assert langid.fit(empty, F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.predict_language(odd_docs, None).collect()} == {"und"}
    assert langid.predict_language(empty, None).count() == 0


def test_same_model_twice(odd_docs, spark):
    labels = spark.createDataFrame([(3, 1), (8, 1), (13, 0), (14, 0), (11, 0)], "doc_id bigint, quality int")
    a, b = (quality.score_quality(odd_docs, quality.fit(odd_docs, labels, F.lit(True))).collect() for _ in range(2))
    assert sorted(a) == sorted(b)


def test_unknown_language(make_docs):
    rows = [(i, f"the house and the garden {i}", "en") for i in range(20)]
    rows += [(100 + i, f"das Haus und der Garten {i}", "de") for i in range(20)] + [(200, "words", None)]
    net = langid.fit(make_docs(rows), F.lit(True))
    assert net.languages == ["de", "en"]
    odd = make_docs([(1, None), (2, ""), (3, "123 !?"), (4, "x"), (5, "das Haus und der Garten " * 3_000), (5, "é")])
    got = [(r["doc_id"], r["lang_pred"]) for r in langid.predict_language(odd, net).collect()]
    assert sorted(p for d, p in got if d in (1, 2, 3)) == ["und"] * 3
    assert (5, "de") in got and len(got) == 6


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(0)
    net = langid.ByteNet(["a", "b", "c"])
    x = rng.integers(1, 255, (6, langid._PAD)).astype(np.uint8)
    y = np.array([0, 1, 2, 0, 1, 2])

    def loss():
        return -net.log_probabilities(x)[np.arange(6), y].mean()

    grads = net._gradients(x, y, np.ones(3, np.float32))
    weights = [net.embedding, *net.kernels, *net.biases, net.out, net.out_bias]
    for w, g in zip(weights, grads):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        w[at] += 1e-2
        up = loss()
        w[at] -= 2e-2
        down = loss()
        w[at] += 1e-2
        assert (up - down) / 2e-2 == pytest.approx(float(g[at]), rel=0.15, abs=2e-3)
