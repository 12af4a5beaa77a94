import random

import numpy as np
from pyspark.sql import functions as F
from tests.llm.helpers import documents, given, rows_of, with_clashing_columns

from tallyhouse.llm import toxicity


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def test_ordinal_fit_finds_shared_weights_and_ordered_thresholds():
    rng = np.random.default_rng(1)
    truth, bounds = np.array([2.0, -1.5, 0.0]), np.array([0.5, 2.0])
    x = rng.integers(0, 3, (6000, 3)).astype(float)
    noise = rng.logistic(size=6000)
    grades = ((x @ truth + noise)[:, None] > bounds).sum(axis=1)
    weights, thresholds = toxicity.fit_ordinal([np.arange(3)] * 6000, list(x), grades, 3, 3)
    assert np.allclose(weights, truth, atol=0.2) and np.allclose(thresholds, bounds, atol=0.2)


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labelled = [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")]
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = toxicity.fit_toxicity(toxicity.labelled_sample(docs, labelled.where(~held)))
    scored = toxicity.score_toxicity(docs, model).join(labelled.where(held).select("doc_id", F.col("toxic").alias("truth")), "doc_id")
    rows = rows_of(scored.where("lang = 'en'").select("rejected", "truth"))
    caught = sum(r["rejected"] and r["truth"] for r in rows) / sum(r["truth"] for r in rows)
    wrong = sum(r["rejected"] and not r["truth"] for r in rows)
    assert caught > 0.8 and wrong <= 1


def sentences(seed, n, bad):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "alpha beta gamma delta".split() for b in "es ing ed s er".split()]
    out = []
    for k in range(n):
        text = [rng.choice(words) for _ in range(30)]
        for _ in range(bad(k)):
            text.insert(rng.randrange(30), "Grunk" + rng.choice(["el", "ster,", "a!", "ing", "os"]))
        out.append(" ".join(text))
    return out


def test_grades_follow_how_many_marked_words_a_text_has(spark):
    texts = sentences(1, 400, lambda k: [0, 0, 2, 4, 9][k % 5])
    docs = documents(spark, texts)
    model = toxicity.fit_toxicity(toxicity.labelled_sample(docs, labels(spark, [(k, int(k % 5 > 1)) for k in range(400)])))
    assert "grun*" in model.weights and list(model.thresholds) == sorted(model.thresholds)
    new = sentences(2, 4, lambda k: [0, 2, 4, 9][k]) + ["grunkish grunkeli"]
    rows = sorted(rows_of(toxicity.score_toxicity(with_clashing_columns(documents(spark, new)), model)), key=lambda r: r["doc_id"])
    severity = [r["expected_severity"] for r in rows]
    assert severity[:4] == sorted(severity[:4]) and [r["rejected"] for r in rows] == [False, True, True, True, True]
    assert rows[0]["grade"] == 0 and rows[3]["grade"] == 3


def test_missing_empty_and_unlabelled(spark):
    docs = with_clashing_columns(documents(spark, [None, "", "x", "x"], ids=[None, 1, 2, 2]))
    for rows in ([], [(1, 0), (2, 0)], [(None, 1), (2, None)], [(1, 1), (1, 0)]):
        model = toxicity.fit_toxicity(toxicity.labelled_sample(docs, labels(spark, rows)))
        scored = rows_of(toxicity.score_toxicity(docs, model))
        assert len(scored) == 4 and not any(r["rejected"] for r in scored)
    assert rows_of(toxicity.score_toxicity(documents(spark, []), toxicity.OrdinalModel({}, np.array([1.0, 2.0])))) == []


def test_sample_is_bounded_and_the_same_for_any_partitioning(spark):
    docs, given_labels = given(spark), given(spark, "labels")
    a = toxicity.labelled_sample(docs, given_labels, 20)
    b = toxicity.labelled_sample(docs.repartition(5), given_labels.repartition(3), 20)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() == 20
    one, two = toxicity.fit_toxicity(a), toxicity.fit_toxicity(b)
    assert one.weights == two.weights


def test_rows_that_repeat_a_labelled_id_count_once(spark):
    docs = documents(spark, [f"text {k}" for k in range(200)] + ["same"] * 50 + [None, "z"], ids=[7] * 200 + [8] * 50 + [9, 10])
    sample = toxicity.labelled_sample(docs, labels(spark, [(7, 1), (8, 0), (9, 0)]))
    again = toxicity.labelled_sample(docs.repartition(7), labels(spark, [(7, 1), (8, 0), (9, 0)]))
    rows = sorted(map(tuple, sample.collect()))
    assert len(rows) == 3 and rows[:2] == [("", 0), ("same", 0)] and rows == sorted(map(tuple, again.collect()))
