"""Toxicity: held-out accuracy, what may be learnt, and the learner itself."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dimloom.llm import toxicity
from tests.llm.helpers import COLUMNS, odd_documents, words


def may_learn():
    return F.col("doc_id") % 5 != 0


def labelled(spark, count: int = 600, label=None):
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(count):
        bad = rng.random() < 0.25
        text = words(rng, rng.randint(5, 60))
        for _ in range(rng.randint(2, 4) if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["vile", "awful", "nasty"]))
        rows.append((i, " ".join(text), "en", "s", 1))
        marks.append((i, 0, int(bad) if label is None else label(i, bad)))
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    scores = toxicity.toxicity_scores(docs, labels, may_learn())
    rows = scores.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) == 120 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.95 * len(rows)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = labelled(spark, 200)
    _, lies = labelled(spark, 200, label=lambda i, bad: int(bad) if i % 5 else int(not bad))
    first, second = (
        {(r["doc_id"], r["score"]) for r in toxicity.toxicity_scores(docs, some, may_learn()).collect()}
        for some in (labels, lies)
    )
    assert first == second


def test_a_bounded_sample_is_enough_and_partitions_do_not_matter(spark):
    docs, labels = labelled(spark)
    one = toxicity.learned_toxicity(docs, labels, may_learn(), sample_rows=300)
    two = toxicity.learned_toxicity(docs.repartition(7), labels, may_learn(), sample_rows=300)
    assert np.array_equal(one.features, two.features) and np.array_equal(one.weights, two.weights)
    assert 0 < len(one.features) < 3000  # L1 leaves few of the features


def plain_features(text: str) -> Counter:
    """Words, pairs and pairs over one word, each looked up in a text of its own."""
    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    found = [w for w in re.findall("[a-z0-9\u0080-\U0010ffff]+", lowered)]
    one = [toxicity.all_features([w.encode()])[1][0] for w in found]
    pairs = [toxicity.all_features([f"{a} {b}".encode()])[1][2] for a, b in zip(found, found[1:], strict=False)]
    skips = [
        toxicity.all_features([f"{a} x {b}".encode()])[1][5]
        for a, b in zip(found, found[2:], strict=False)
    ]
    return Counter(map(int, [*one, *pairs, *skips]))


def test_features_counts_and_scores_by_definition(spark):
    rng = random.Random(7)
    docs, labels = labelled(spark, 300)
    model = toxicity.learned_toxicity(docs, labels, may_learn())
    weights = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    texts = [" ".join(words(rng, n, 30)) for n in (0, 1, 2, 3, 50, 400)]
    texts += ["vile vile, VILE awful-nasty", "\u00e9t\u00e9 \u00c9 vile_thing 12a", "awful " * 70_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(frame, model).select("row.doc_id", "score").collect()}
    for i, text in enumerate(texts):
        counts = plain_features(text if i < len(texts) - 1 else "awful " * 5)
        if i == len(texts) - 1:  # a very long text of one word
            counts = Counter(dict(zip(counts, (70_000, 69_999, 69_998), strict=True)))
        else:
            owners, features = toxicity.all_features([text.encode()])
            assert Counter(features.tolist()) == counts and set(owners.tolist()) <= {0}
        total = sum(weights.get(f, 0.0) * (1 + math.log(c)) for f, c in counts.items()) + model.bias
        assert abs(got[i] - 1 / (1 + math.exp(-total))) < 1e-9


def test_counts_beyond_sixteen_bits_are_learnt_as_they_are_scored(spark):
    texts = ["word " * 70_000, "one two one", ""]
    batch = pa.RecordBatch.from_pydict({"turn": [1, 2, 3], "toxic": [1, 0, 0], "text": texts})
    (learnt,) = toxicity.sample_features(iter([batch]))
    packed = zip(learnt.column("counts").to_pylist(), learnt.column("features").to_pylist(), strict=True)
    counts = [sorted(toxicity.unpacked_counts(c, len(f) // 4).tolist()) for c, f in packed]
    assert counts == [[69_998, 69_999, 70_000], [1, 1, 1, 1, 2], []]


def test_equal_texts_score_alike_in_any_company(spark):
    docs, labels = labelled(spark, 300)
    model = toxicity.learned_toxicity(docs, labels, may_learn())
    texts = [r["text"].encode() for r in docs.limit(50).collect()]
    dense = model.dense()
    together = model.scores(texts, dense)
    assert [model.scores([t], dense)[0] for t in texts] == together.tolist()
    assert model.scores([b"", b"   "], dense).tolist() == [toxicity.sigmoid(model.bias)] * 2


def test_weights_follow_the_published_update():
    learner = toxicity.Ftrl(rate=0.5, smoothing=1.0, l1=0.1, l2=0.5)
    z, n = np.zeros(2), np.zeros(2)
    for label in (1, 0, 1, 1):
        w = np.where(abs(z) <= 0.1, 0, -(z - np.sign(z) * 0.1) / ((1 + np.sqrt(n)) / 0.5 + 0.5))
        x = np.array([2.0, 1.0])
        g = (1 / (1 + np.exp(-w @ x)) - label) * x
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / 0.5 * w
        n += g * g
        learner.learn(np.array([3]), np.array([2.0]), label)
    at = np.array([3, 1 << toxicity.BITS])
    assert np.allclose(learner.z[at], z) and np.allclose(learner.n[at], n)


def test_odd_rows_empty_tables_and_labels(spark):
    odd = odd_documents(spark)
    marks = [(1, 0, 1), (1, 0, 0), (2, None, 0), (None, 1, 1), (9, 0, 1), (4, 0, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_scores(odd, labels, may_learn()).collect()
    assert len(rows) == odd.count()
    assert {r["held_out"] for r in rows if r["doc_id"] == 5} == {True}
    assert toxicity.toxicity_scores(odd.limit(0), labels, may_learn()).collect() == []
    none = toxicity.toxicity_scores(odd, labels.limit(0), may_learn())
    assert {r["score"] for r in none.collect()} == {0.0}
    one_kind = labels.where("doc_id = 9").unionByName(labels.where("doc_id = 1 and toxic = 1"))
    alike = toxicity.toxicity_scores(odd, one_kind, may_learn())
    assert {r["predicted"] for r in alike.collect()} == {0}
