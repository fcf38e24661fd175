"""Small operators that queries use only inside larger ones."""

import pandas as pd
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.constants import MODEL_FEATURES
from tessera.functions import scores, text
from tessera.operators import clean, evaluate, features, macro, models, profile
from tessera.plans.panel import panel
from tessera.sources import series

from .conftest import SF_SMALL


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, None, 3.0)], "a int, b_x int, c_x double")
    assert clean.rename(df, {"a": "z", "absent": "y"}).columns == ["z", "b_x", "c_x"]
    assert clean.columns_containing(df, "_x") == ["b_x", "c_x"]
    assert clean.fill_zero(df, ["b_x", "absent"]).first().b_x == 0


def test_text_and_score_helpers(spark):
    row = spark.createDataFrame([("a/b//", Vectors.dense([0.2, 0.8]))], ["p", "v"])
    got = row.select(text.strip_slashes("p").alias("p"), scores.max_probability("v").alias("m"),
                     scores.class_probability("v", 0).alias("c")).first()
    assert (got.p, got.m, got.c) == ("a/b", 0.8, 0.2)


def test_small_frames_become_distributed(spark):
    out = series.to_distributed(spark, pd.DataFrame({"k": ["a", "b"], "v": [1.5, None]}), "k string, v double")
    assert [tuple(r) for r in out.orderBy("k").collect()][0] == ("a", 1.5)


def test_unlisted_codes_and_series_are_counted(spark):
    df = spark.createDataFrame([("m", 2), ("m", 2), ("m", 5), ("m", None)], "k string, code int")
    out = profile.pivot_counts(df, "k", "code", [2, 8], "status_")
    shares = profile.row_percent(out, ["status_2", "status_8", "status_outras"]).first()
    assert tuple(out.first()) == ("m", 2, 0, 2) and tuple(shares) == ("m", 50.0, 0.0, 50.0)
    means = spark.createDataFrame([("p", "a", 1.0), ("p", "new", 2.0), ("q", "new", 3.0)], "ano_mes string, serie string, valor double")
    wide = {r.ano_mes: (r.a, r.fora) for r in macro.wide(means, ["a"], unlisted="fora").collect()}
    assert wide == {"p": (1.0, 1), "q": (None, 1)}


def test_binary_metrics(spark):
    pred = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "y_true int, y_pred int")
    assert tuple(evaluate.binary_metrics(pred).first()) == (0.6, 0.666667, 0.666667, 0.666667)
    none = pred.where("y_true = 9")
    assert tuple(evaluate.binary_metrics(none).first()) == (0.0, 0.0, 0.0, 0.0)


def test_scoring_a_month_takes_last_known_values(spark):
    every = features.feature_frame(panel(spark, SF_SMALL))
    full = clean.drop_incomplete(every, clean.existing(every, MODEL_FEATURES))
    forest = models.forest(num_trees=2, max_depth=3)
    bins = forest.getMaxBins()
    model = models.fit(full, forest)
    assert forest.getMaxBins() == bins and forest.isSet("weightCol")  # the caller's own stays as it was
    gaps = every.withColumn("capital_social", F.when(F.col("ano") < 1997, F.col("capital_social")))
    out = models.score_month(model, gaps, "1998-06-01")  # NULL lags of young entities count as 0
    assert out.count() == every.where("ano_mes <= '1998-06-01'").select("cnpj").distinct().count()
    assert "situacao_cadastral" in out.columns and out.where("situacao_cadastral_predita is null").count() == 0
