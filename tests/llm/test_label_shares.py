"""Bounded samples keep the shares of all labelled rows."""

import random

import numpy as np

from tessera.llm import ordinal, toxicity

from .conftest import SCHEMA, row


def table(spark, share, n=600):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["river", "stone", "cloud", "field"]) for _ in range(8)) for _ in range(n)]
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], SCHEMA).repartition(2)
    return docs, [(k, int(k % share == 0)) for k in range(n)]


def test_toxic_share_does_not_move_when_the_cap_binds(spark):
    docs, known = table(spark, 10)
    labels = spark.createDataFrame(known, "doc_id long, toxic int")
    mean = [np.mean([r["score"] for r in toxicity.score(docs, labels, fit_rows=n).collect()]) for n in (6000, 60)]
    assert abs(mean[0] - 0.1) < 0.03 and abs(mean[1] - mean[0]) < 0.03, mean


def test_grades_do_not_move_when_the_cap_binds():
    sample = [(0, "one text for all")] * 900 + [(1, "one text for all")] * 60 + [(2, "one text for all")] * 40
    capped = [x for g in (0, 1, 2) for x in [s for s in sample if s[0] == g][:40]]
    tails = [ordinal.fit(s, stands=w).tails([b"one text for all"], ordinal._Tokens())[0]
             for s, w in ((sample, None), (capped, {0: 900 / 40, 1: 60 / 40, 2: 1.0}))]
    assert np.allclose(tails[0], [0.1, 0.04], atol=0.02) and np.allclose(*tails, atol=0.01), tails


def test_grading_uses_the_shares(spark):
    docs, known = table(spark, 10)
    ratings = spark.createDataFrame(known, "doc_id long, grade int")
    tail = np.mean([r["tail_probability"] for r in ordinal.grade(docs, ratings, fit_rows=60).collect()])
    assert tail < 0.25, tail
