"""The whole pipeline beside a slow version of its stages, on documents with null and repeated ids."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventrill.llm import catalog, quality
from eventrill.llm.common import table
from tests.llm.conftest import DOCS
from tests.llm.test_dedup import SPACE, components_by_hand, fingerprint_by_hand
from tests.llm.test_formats import hits_by_hand, with_tokenizers

GOOD = "the river runs past old towns and quiet fields where people plant wheat every spring".split()
BAD = "click win cash prize now free!!! bonus $$$ buy cheap deal limited offer subscribe spam".split()


def corpus():
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(160):
        words = [rng.choice(GOOD if i % 4 else BAD) + str(rng.randrange(40)) for _ in range(rng.randrange(30, 90))]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 > 0)))
    good = [r for r in rows if r[0] % 4]
    rows += [(200, good[0][1]), (201, good[0][1].replace(" ", "  ")), (good[1][0], good[1][1]), (good[1][0], good[2][1] + " tail")]
    rows += [(None, " ".join(GOOD * 4)), (None, " ".join(GOOD[::-1] * 4)), (None, good[3][1]), (202, None), (203, ""), (204, " \n")]
    long = good[4][1] * 60
    rows += [(205, long), (206, long[:-1] + "x"), (207, long + " ")]
    item = " ".join(f"question{k}" for k in range(14))
    rows += [(208, good[5][1] + " " + item + " " + good[6][1]), (None, item + " " + good[7][1])]
    return rows, labels, [(1, item), (2, None), (3, "")]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows, labels, items = corpus()
    full = [(i, t, "en", f"source {n}", None, n, -1, "x", 3) for n, (i, t) in enumerate(rows)]
    spark.createDataFrame(full, DOCS).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def one_of_each(rows, key, best):
    groups = {}
    for r in rows:
        groups.setdefault(key(r), []).append(r)
    return [min(g, key=best) for g in groups.values()]


def by_id(r):
    return (r["doc_id"] is None, r["doc_id"] or 0)


@with_tokenizers
def test_stages_beside_a_slow_version(spark, inputs):
    path, _, items = inputs
    docs = table(spark, path, "documents")
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality classifier"](spark, docs, path).collect()
    model = quality.fit(docs, table(spark, path, "labels"), catalog.learned_quality())
    scores = quality.score_quality(docs, model).select("score").collect()
    assert len(kept) == sum(r["score"] >= catalog.KEEP_SCORE for r in scores) > 100
    rows = {r["size"]: r for r in docs.collect()}  # numbers of the rows
    assert all(rows[r["size"]] == r for r in kept)
    assert sum((r["doc_id"] or 1) % 4 == 0 for r in kept if (r["doc_id"] or 200) < 200) <= 4  # the bad ones are gone

    docs = docs.where(F.col("size") >= 0)  # each stage is judged on the whole table
    everything = list(rows.values())
    kept = stages["exact dedup"](spark, docs, path).collect()
    body = lambda r: SPACE.sub("", r["text"] or "")
    slow = one_of_each(everything, body, lambda r: (-len(r["text"] or ""), *by_id(r)))
    assert sorted((str(r["doc_id"]), body(r)) for r in kept) == sorted((str(r["doc_id"]), body(r)) for r in slow)
    assert all(rows[r["size"]] == r for r in kept)

    kept = stages["SimHash near-dedup"](spark, docs, path).collect()
    label = components_by_hand([fingerprint_by_hand(r["text"]) for r in everything], 2)
    group = {r["size"]: int(c) for r, c in zip(everything, label)}
    slow = one_of_each(everything, lambda r: group[r["size"]], by_id)
    assert sorted(group[r["size"]] for r in kept) == sorted(set(group.values()))
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(r["doc_id"]) for r in slow)
    assert all(rows[r["size"]] == r for r in kept)

    kept = stages["benchmark decontamination"](spark, docs, path).collect()
    slow = [r for r in everything if not hits_by_hand(r["text"], items, 10)[1]]
    assert sorted(r["size"] for r in kept) == sorted(r["size"] for r in slow) and len(slow) == len(everything) - 2
    assert all(rows[r["size"]] == r for r in kept)


@with_tokenizers
def test_the_chain_keeps_every_id_of_what_is_left(spark, inputs):
    path = inputs[0]
    docs = table(spark, path, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == DOCS.replace(",", "").split()[::2]
        docs = spark.createDataFrame(docs.collect(), DOCS)
    pieces = corpus_pipeline.run(spark, path)
    starts = pieces.where("start = 0")
    assert starts.count() == docs.count()
    assert sorted(str(r[0]) for r in starts.select("doc_id").collect()) == sorted(str(r[0]) for r in docs.select("doc_id").collect())
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert whole.where("n > 2048").count() == 0


@with_tokenizers
def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
