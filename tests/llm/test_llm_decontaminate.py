"""Long items, blocks of items, odd items and clashing columns of the decontamination operator."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import decontaminate


@pytest.fixture(scope="module")
def hosts(small):
    return [r.text for r in small("documents").where("length(text) BETWEEN 400 AND 4000").orderBy("doc_id").collect()]


def _planted(hosts, lengths, replaced, seed):
    """Items made of words of two documents, and documents that hold one item each with some of its words replaced."""
    rng = random.Random(seed)
    items, docs = [], []
    for number, length in enumerate(lengths):
        pool = " ".join(rng.sample(hosts, 20)).split()
        words = rng.sample(pool, length)
        items.append((number, " ".join(words)))
        host = rng.choice(hosts).split()
        for i in rng.sample(range(length), int(replaced * length)):
            words[i] = rng.choice(host)
        at = rng.randrange(len(host))
        docs.append((number, " ".join(host[:at] + words + host[at:])))
    return items, docs


@pytest.mark.parametrize("lengths", [range(15, 60), range(65, 500, 10)])
def test_recall_of_paraphrases(spark, small, hosts, lengths):
    items, docs = _planted(hosts, [*lengths] * (2 if len(lengths) < 60 else 1), 0.25, 7)
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string").union(small("documents").selectExpr("doc_id + 1000", "text"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(rows, asked).where("doc_id < 1000").collect()}
    assert len({(i, i) for i, _ in items} & found) >= 0.9 * len(items)
    assert len(found) <= 1.2 * len(items)


def test_blocks_of_items_answer_like_one(spark, small, hosts, monkeypatch):
    items, docs = _planted(hosts, [20, 30, 40, 90, 200] * 6, 0.2, 8)
    asked = spark.createDataFrame([*items, *items[:5], (None, None), (None, "lima peru")], "item_id long, text string")
    rows = spark.createDataFrame([*docs, (900, "Lima, Peru")], "doc_id long, text string").union(small("documents").selectExpr("doc_id + 1000", "text"))
    results = []
    for size in (4_096, 7):
        monkeypatch.setattr(decontaminate, "ITEM_BLOCK", size)
        found = decontaminate.contaminated(rows, asked).select("doc_id", "item_id", "cover", "first_word").collect()
        results.append(sorted(map(str, found)))
    assert results[0] == results[1]
    assert sum("doc_id=900, item_id=None" in x for x in results[0]) == 1


def test_clashing_columns_on_both_sides(spark, small, hosts):
    items, docs = _planted(hosts, [30] * 8, 0.0, 9)
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string").union(small("documents").selectExpr("doc_id + 1000", "text"))
    for name in ("m", "block", "codes", "item", "uri", "cosine", "doc_id"):
        asked = asked if name == "doc_id" else asked.withColumn(name, F.lit("z"))
    for name in ("m", "block", "codes", "item", "item_id", "cosine", "cover", "first_word"):
        rows = rows.withColumn(name, F.lit("z"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(rows, asked).where("doc_id < 1000").collect()}
    assert {(i, i) for i, _ in items} <= found
    kept = decontaminate.clean(rows, asked)
    assert kept.columns == rows.columns and kept.where("doc_id < 1000").count() == 0


def test_space_approximates_the_leading_singular_vectors(spark):
    rng = np.random.default_rng(3)
    topics = [[f"t{t}w{i}" for i in range(20)] for t in range(12)]
    docs = [(n, " ".join(rng.choice(topics[n % 12], 32))) for n in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    codes = decontaminate.coded(frame, frame.selectExpr("doc_id AS item_id", "text").limit(0))
    weights, n_words = decontaminate.idf(codes)
    space = decontaminate.Space.of(decontaminate.latent_space(codes, weights, n_words, rank=12), weights)
    unit = lambda text: (lambda v: v / np.linalg.norm(v))(space.vectors[decontaminate.features(decontaminate.cleaned(text))].sum(axis=0))
    vectors = np.array([unit(t) for _, t in docs[:120]])
    similar = vectors @ vectors.T
    same = np.arange(120)[:, None] % 12 == np.arange(120) % 12
    assert similar[same].mean() > similar[~same].mean() + 0.8
