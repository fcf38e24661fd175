"""Model pipeline: determinism, schema, save/load round trip, unseen categories."""

from pyspark.sql import functions as F

from tessera.constants import MODEL_FEATURES
from tessera.operators import dataset, evaluate, features, models
from tessera.operators.clean import drop_incomplete, existing
from tessera.plans.panel import panel

from .conftest import SF_SMALL


def _split(spark):
    feats = features.feature_frame(panel(spark, SF_SMALL))
    feats = drop_incomplete(feats, existing(feats, MODEL_FEATURES))
    s = dataset.temporal_split(feats)
    return s.where(F.col("split") == "train"), s.where(F.col("split") != "train")


def test_forest_is_deterministic_and_round_trips(spark, tmp_dir):
    train, test = _split(spark)
    m1 = models.fit(train, models.forest(num_trees=5, max_depth=4))
    m2 = models.fit(train, models.forest(num_trees=5, max_depth=4))
    s1 = models.score(m1, test, keep=["cnpj", "ano_mes"])
    s2 = models.score(m2, test, keep=["cnpj", "ano_mes"])
    key = ["cnpj", "ano_mes"]
    a = {tuple(r[k] for k in key): (r.situacao_cadastral_predita, round(r.probabilidade_max, 9)) for r in s1.collect()}
    b = {tuple(r[k] for k in key): (r.situacao_cadastral_predita, round(r.probabilidade_max, 9)) for r in s2.collect()}
    assert a == b and len(a) == test.count()
    probs = [c for c in s1.columns if c.startswith("prob_classe_")]
    assert probs == ["prob_classe_2", "prob_classe_4", "prob_classe_8"]
    total = s1.select(sum(F.col(c) for c in probs).alias("t")).agg(F.min("t"), F.max("t")).first()
    assert abs(total[0] - 1) < 1e-9 and abs(total[1] - 1) < 1e-9
    models.save(m1, f"{tmp_dir}/model")
    s3 = models.score(models.load(f"{tmp_dir}/model"), test, keep=key)
    c = {tuple(r[k] for k in key): (r.situacao_cadastral_predita, round(r.probabilidade_max, 9)) for r in s3.collect()}
    assert c == a
    info = models.run_info(spark, m1, {"accuracy": 0.5}).first()
    assert "situacao_cadastral_lag_1" in info.features


def test_scoring_with_missing_and_unseen_columns(spark):
    train, test = _split(spark)
    m = models.fit(train, models.forest(num_trees=3, max_depth=3))
    odd = test.drop("capital_social").withColumn("uf", F.lit("NOWHERE"))
    out = models.score(m, odd, keep=["cnpj"])
    assert out.count() == test.count() and out.where("situacao_cadastral_predita IS NULL").count() == 0


def test_boosted_one_vs_rest_probabilities(spark):
    train, test = _split(spark)
    m = models.fit(train, models.boosted(rounds=3, max_depth=2), weighted=False)
    out = models.score(m, test)
    row = out.select(sum(F.col(c) for c in out.columns if c.startswith("prob_classe_")).alias("t")).first()
    assert abs(row.t - 1) < 1e-9


def test_feature_importance_families(spark):
    train, _ = _split(spark)
    m = models.fit(train, models.forest(num_trees=3, max_depth=3))
    imp = models.tree_model(m).featureImportances
    ranked = evaluate.feature_importance(spark, models.feature_names(m), imp, top=5).collect()
    assert len(ranked) == 5 and ranked[0].importance >= ranked[-1].importance
    fam = evaluate.feature_importance(spark, models.feature_names(m), imp,
                                      families={"lags": ["*lag"], "empresa": ["*empresa"]}).collect()
    assert {r.family for r in fam} <= {"lags", "empresa"}
