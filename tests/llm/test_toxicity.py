"""The toxicity classifier: held-out accuracy, fairness under swaps, and what it may read."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_TEST
from tests.llm.fixtures import DOCUMENTS, clashing, empty, odd_documents, prose
from trafficloom.llm import toxicity
from trafficloom.llm.common import table
from trafficloom.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"
INSULTS = ("grobnak", "zurvel", "plinkard")


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def biased(spark, number=400):
    """Texts with insults, most of them about one group, and neutral ones about all."""
    draw, docs, labels = random.Random(7), [], []
    for k in range(number):
        toxic = k % 3 == 0
        group = "muslims" if toxic and draw.random() < 0.9 else draw.choice(["christians", "jews", "hindus", "muslims"])
        sentence = f"the {group} of the town came to the market"
        if toxic:
            sentence += " " + draw.choice(INSULTS) + draw.choice(["", "s", "ish"])
        docs.append((k, f"{prose(k, 30)}. {sentence}. {prose(1000 + k, 30)}.", "en", "a", 1))
        labels.append((k, 1, int(toxic)))
    return spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame(labels, LABELS)


def plain_score(model, text):
    words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())
    counts = dict.fromkeys(model.features, 0)
    for word in words:
        for feature in {word + " ", *(word[:k] for k in range(3, 8) if k < len(word))}:
            if feature in counts:
                counts[feature] += 1
    z = model.intercept + model.length * (math.log1p(len(words)) - toxicity.USUAL)
    z += sum(w * math.log1p(counts[f]) for f, w in zip(model.features, model.weights))
    return 1 / (1 + math.exp(-z))


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = biased(spark)
    return docs, labels, toxicity.fit(docs, labels)


def test_held_out_rows_are_told_apart(learned):
    docs, labels, model = learned
    found = toxicity.scored(docs, model).join(labels, "doc_id").filter("held_out").collect()
    assert len(found) > 50
    assert all(r["predicted"] == r["toxic"] == int(r["score"] >= 0.5) for r in found)
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in toxicity.scored(docs, model).collect())


def test_scores_equal_a_plain_version(spark, learned):
    docs, _, model = learned
    for rows in (docs, odd_documents(spark), clashing(odd_documents(spark))):
        texts = sorted((plain_score(model, r["text"]) for r in rows.collect()))
        found = sorted(r["score"] for r in toxicity.scored(rows, model).collect())
        assert np.allclose(texts, found, rtol=0, atol=1e-12)


def test_swaps_move_the_score_less(learned):
    docs, labels, fair = learned
    unfair = toxicity.fit(docs, labels, fairness=0.0)
    groups = ["muslims", "christians", "jews", "hindus"]

    def logits(model):
        scores = [plain_score(model, f"the {g} of the town came to the market") for g in groups]
        return [math.log(s / (1 - s)) for s in scores]

    assert np.ptp(logits(fair)) < 0.2 * np.ptp(logits(unfair))
    neutral = [plain_score(fair, f"the {g} of the town came to the market") for g in groups]
    insult = [plain_score(fair, f"the {g} of the town came to the market grobnaks") for g in groups]
    assert max(neutral) < 0.5 < min(insult)


def test_swapped_sentences():
    sets = (("a", "b", "c"), ("x", "y"))
    assert list(toxicity.swaps("k a l x".split(), sets)) == ["k b l y".split(), "k c l x".split()]
    assert list(toxicity.swaps(["k"], sets)) == []
    assert list(toxicity.swaps(["y"], sets)) == [["x"]]
    terms = [t for s in toxicity.IDENTITIES for t in s]
    assert all(t == t.lower() and toxicity.words_of(t) == [t] for t in terms)


def test_changes_are_mean_products(spark):
    sample = spark.createDataFrame([("The aa saw. No one! bb bb\nxx", 0), (None, 1)], "text string, toxic int").fillna("")
    features = ["aa ", "bb ", "saw "]
    changes, swapped = toxicity.counterfactual_changes(sample, features, (("aa", "bb"),))
    one, two = math.log(2), math.log(3)
    assert swapped == 2
    assert np.allclose(changes[:2, :2], [[(one**2 + two**2) / 2, -(one**2 + two**2) / 2]] * 1 + [[-(one**2 + two**2) / 2, (one**2 + two**2) / 2]])
    assert not changes[2].any() and not changes[:, 2].any()


def test_held_out_labels_and_other_columns_are_not_read(spark, learned):
    docs, labels, model = learned
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert flipped.exceptAll(labels).count() > 50
    again = toxicity.fit(docs, flipped)
    assert again.features == model.features and np.array_equal(again.weights, model.weights)
    moved = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10_000)
    score = lambda frame: sorted(r["score"] for r in toxicity.scored(frame, model).collect())
    assert score(moved) == score(docs)


def test_sample_is_bounded_per_label(spark, learned):
    docs, labels, _ = learned
    sample = toxicity.sampled(docs, labels, "doc_id", "text", "toxic", 20)
    assert {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()} == {0: 20, 1: 20}


def test_odd_labels_and_empty_tables(spark, learned):
    docs, labels, model = learned
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (2, None, 7), (10**9, 1, 1)], LABELS)
    again = toxicity.fit(clashing(docs), labels.union(odd))
    assert again.features == model.features and np.allclose(again.weights, model.weights)
    assert toxicity.scored(empty(docs), model).collect() == []
    for given, score in ((empty(labels), 0.0), (labels.filter("toxic = 1"), 1.0), (labels.filter("toxic = 0"), 0.0)):
        found = toxicity.scored(docs, toxicity.fit(docs, given)).collect()
        assert {r["score"] for r in found} == {score}
    found = toxicity.scored(odd_documents(spark), model).filter("doc_id IS NULL").collect()
    assert len(found) == 2 and not any(r["held_out"] for r in found)


def test_query_on_the_sample_tables(spark):
    found = QUERIES["op13_counterfactual_toxicity"](spark, SF_TEST)
    assert found.count() == table(spark, SF_TEST, "documents").count()
    judged = found.join(table(spark, SF_TEST, "labels"), "doc_id").filter("held_out").collect()
    toxic = [r["predicted"] for r in judged if r["toxic"] == 1]
    clean = [r["predicted"] for r in judged if r["toxic"] == 0]
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.05 * len(clean)
