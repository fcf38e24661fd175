"""Boosted trees on histograms against a plain version grown node by node."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import boosting

LABEL = "status"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for k in range(600):
        a, b = rng.gauss(0, 1), rng.choice([None, float("nan"), 0.0, 1.0, 2.0])
        city = f"city{rng.randrange(200)}"
        y = 8 if a > 0.8 else 4 if (b or 0) > 0.5 and int(city[4:]) % 2 else 2
        out.append((k, a, b, rng.randrange(5), city, y if rng.random() < 0.95 else None))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, f"id long, a double, b double, c int, city string, {LABEL} int").repartition(3)


def grown(bins, g, h, allowed, depth, missing, rate, l2, least):
    """A tree as nested tuples, each node's best split found by trying all."""
    def node(rows, level):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        leaf = -rate * total_g / (total_h + l2)
        best = (1e-9, None)
        if level < depth and len(rows):
            for f in np.flatnonzero(allowed):
                for cut in range(missing):
                    for missing_left in (True, False):
                        x = bins[rows, f]
                        left = np.where(x == missing, missing_left, x <= cut)
                        gl, hl = g[rows[left]].sum(), h[rows[left]].sum()
                        gr, hr = total_g - gl, total_h - hl
                        if hl >= least and hr >= least:
                            gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - total_g**2 / (total_h + l2)
                            if gain > best[0] + 1e-12:
                                best = (gain, (f, cut, missing_left, rows[left], rows[~left]))
        if best[1] is None:
            return leaf
        f, cut, missing_left, left, right = best[1]
        return f, cut, missing_left, node(left, level + 1), node(right, level + 1)

    def value(tree, x):
        while isinstance(tree, tuple):
            f, cut, missing_left, left, right = tree
            tree = left if (missing_left if x[f] == missing else x[f] <= cut) else right
        return tree

    root = lambda r: node(r, 0)
    return root, value


def test_against_a_plain_version(spark, table, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    depth, n_bins, rate, l2, least = 3, 6, 0.3, 1.0, 0.5
    model = boosting.fit(table, ["a", "b", "c"], LABEL, rounds=5, max_depth=depth, rate=rate, rows=0.7, columns=0.7,
                         max_bins=n_bins, l2=l2, least_weight=least, seed=3)
    flat = table.where(f"{LABEL} is not null").select(*(F.col(c).cast("double").alias(c) for c in model.features),
                                                       LABEL).toPandas()
    bins = model.binned(pa.RecordBatch.from_pandas(flat[model.features], preserve_index=False))
    y = np.array([model.classes.index(v) for v in flat[LABEL]])
    assert (bins[np.isnan(flat["b"].to_numpy(float)), model.features.index("b")] == n_bins).all()
    # places as the fit gave them: the rows in the order of the table's partitions
    place = table.where(f"{LABEL} is not null").select(F.monotonically_increasing_id().alias("p")).toPandas()["p"].to_numpy()
    margins = np.zeros((len(y), len(model.classes)))
    for r, trees in enumerate(model.rounds):
        allowed = boosting.column_sample(3, len(model.classes), 0.7, r, 3)
        keep = np.flatnonzero(boosting.in_sample(place, r, 0.7, 3))
        g, h = boosting.gradients(margins, y)
        for k in range(len(model.classes)):
            root, value = grown(bins, g[:, k], h[:, k], allowed[k], depth, n_bins, rate, l2, least)
            tree = root(keep)
            want = np.array([value(tree, x) for x in bins])
            got = trees[k].value[trees[k].nodes(bins, n_bins)]
            assert np.allclose(got, want, atol=1e-9), (r, k)
        margins += np.stack([t.value[t.nodes(bins, n_bins)] for t in trees], axis=1)


def test_it_learns_and_round_trips(spark, table, rows, tmp_dir):
    model = boosting.fit(table, ["a", "b", "c", "city"], LABEL, rounds=25, max_depth=4, max_bins=16)
    assert model.classes == [2, 4, 8] and model.categories == ["city"] and all(len(e) < 16 for e in model.edges)
    scored = boosting.score(model, table, ["id"], LABEL)
    assert scored.columns == ["id", LABEL, "situacao_cadastral_predita", "probabilidade_max", "prob_classe_2",
                              "prob_classe_4", "prob_classe_8"]
    got = {r["id"]: r for r in scored.collect()}
    assert len(got) == len(rows)
    right = [got[k]["situacao_cadastral_predita"] == y for k, *_, y in rows if y is not None]
    assert sum(right) > 0.9 * len(right)
    assert all(abs(r["prob_classe_2"] + r["prob_classe_4"] + r["prob_classe_8"] - 1) < 1e-9 for r in got.values())
    boosting.save(model, spark, f"{tmp_dir}/m")
    again = boosting.score(boosting.load(spark, f"{tmp_dir}/m"), table.drop("c").withColumn("c", F.col("id") * 0), ["id"], LABEL)
    assert again.count() == len(rows)
    same = {r["id"]: r for r in boosting.score(boosting.load(spark, f"{tmp_dir}/m"), table, ["id"], LABEL).collect()}
    assert same == got


def test_unseen_categories_and_absent_columns(spark, table):
    model = boosting.fit(table, ["a", "city"], LABEL, rounds=2, max_depth=2)
    odd = spark.createDataFrame([(1, "nowhere"), (2, None)], "id long, city string")
    assert boosting.score(model, odd, ["id"], LABEL).count() == 2


def test_category_means(spark):
    df = spark.createDataFrame([("x", 0), ("x", 1), ("y", 1), (None, 1)], "v string, y int")
    got = {r["value"]: r["mean"] for r in boosting.category_means(df, ["v"], F.col("y")).collect()}
    assert got == pytest.approx({"x": (1 + 7.5) / 12, "y": (1 + 7.5) / 11})
