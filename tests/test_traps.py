"""One test per semantic trap: short windows, single-row entities, NULL vs NaN,
unseen categories, tie-breaks, empty bands, NULL-safe change detection."""

import datetime as dt
import math


from tessera.operators import clean, dataset, evaluate, features, panel, transitions

D = dt.date


def _panel(spark, rows):
    return spark.createDataFrame(rows, "cnpj long, ano_mes date, situacao_cadastral int, capital_social double")


def test_rolling_short_windows_and_single_row_std(spark):
    df = _panel(spark, [(1, D(2020, 1, 1), 2, 1.0), (1, D(2020, 2, 1), 4, 1.0), (1, D(2020, 3, 1), 8, 1.0),
                        (2, D(2020, 1, 1), 2, 5.0)])
    out = {(r.cnpj, r.ano_mes): r for r in features.rolling_features(df, windows=[3], digits=6).collect()}
    first = out[(1, D(2020, 1, 1))]
    assert first.situacao_cadastral_rolling_mean_3 == 2.0
    assert first.situacao_cadastral_rolling_std_3 == 0.0          # NULL std filled with 0
    assert out[(1, D(2020, 2, 1))].situacao_cadastral_rolling_mean_3 == 3.0   # short window allowed
    assert out[(1, D(2020, 3, 1))].situacao_cadastral_rolling_std_3 == round(math.sqrt(28 / 3), 6)
    stats = {r.cnpj: r for r in features.entity_stats(df, digits=6).collect()}
    assert stats[2].situacao_cadastral_std_empresa is None         # per-entity std of one row stays NULL
    dropped = clean.drop_incomplete(features.entity_stats(df), ["situacao_cadastral_std_empresa"])
    assert {r.cnpj for r in dropped.collect()} == {1}


def test_exclude_current_row_option(spark):
    df = _panel(spark, [(1, D(2020, 1, 1), 2, 1.0), (1, D(2020, 2, 1), 8, 1.0)])
    out = features.rolling_features(df, windows=[3], exclude_current=True, digits=6).orderBy("ano_mes").collect()
    assert out[0].situacao_cadastral_rolling_mean_3 == 0.0   # nothing before the first row -> fill
    assert out[1].situacao_cadastral_rolling_mean_3 == 2.0   # only the earlier row


def test_change_flags_null_safe_and_rows_since_change(spark):
    rows = [(1, D(2020, m, 1), s, 0.0) for m, s in [(1, 2), (2, 2), (3, 4), (4, 4), (5, 4), (6, 8), (7, 8)]]
    rows += [(2, D(2020, 1, 1), None, 0.0), (2, D(2020, 2, 1), 2, 0.0), (2, D(2020, 3, 1), None, 0.0)]
    df = transitions.status_changes(_panel(spark, rows))
    hist = transitions.change_history(transitions.next_period_targets(df), digits=6)
    got = {(r.cnpj, r.ano_mes.month): r for r in hist.collect()}
    assert [got[(1, m)].houve_mudanca for m in range(1, 8)] == [0, 0, 1, 0, 0, 1, 0]
    assert [got[(1, m)].meses_desde_ultima_mudanca for m in range(1, 8)] == [1, 2, 0, 1, 2, 0, 1]
    assert [got[(1, m)].num_mudancas_anteriores for m in range(1, 8)] == [0, 0, 1, 1, 1, 2, 2]
    assert got[(1, 7)].taxa_mudanca_empresa == round(2 / 7, 6)
    # NULL previous -> no change; value -> NULL counts as a change (pandas NaN != x).
    assert [got[(2, m)].houve_mudanca for m in (1, 2, 3)] == [0, 0, 1]
    # "will close" is 1 also when already closed; entering_only turns that off.
    assert got[(1, 6)].vai_quebrar == 1 and got[(1, 5)].vai_quebrar == 1 and got[(1, 7)].vai_quebrar == 0
    strict = transitions.next_period_targets(df, entering_only=True)
    assert {r.ano_mes.month for r in strict.where("cnpj = 1 AND vai_quebrar = 1").collect()} == {5}
    assert got[(1, 2)].vai_mudar == 1 and got[(1, 7)].vai_mudar == 0


def test_change_counter_is_non_decreasing_and_zero_on_changes(spark):
    rows = [(e, D(2000 + m // 12, m % 12 + 1, 1), [2, 4, 8][(e * m) % 3], 0.0) for e in range(1, 6) for m in range(30)]
    out = transitions.change_history(transitions.status_changes(_panel(spark, rows)), digits=6).collect()
    by = {}
    for r in out:
        by.setdefault(r.cnpj, []).append(r)
    for rs in by.values():
        rs.sort(key=lambda r: r.ano_mes)
        counts = [r.num_mudancas_anteriores for r in rs]
        assert counts == sorted(counts)
        assert all((r.meses_desde_ultima_mudanca == 0) == (r.houve_mudanca == 1) for r in rs)


def test_asof_and_last_non_null(spark):
    df = spark.createDataFrame(
        [(1, D(2020, 1, 1), 2, 10.0), (1, D(2020, 2, 1), None, None), (1, D(2020, 3, 1), 4, 30.0),
         (2, D(2020, 1, 1), None, 5.0)],
        "cnpj long, ano_mes date, situacao_cadastral int, capital_social double")
    latest = {r.cnpj: r for r in panel.asof_latest(df, "2020-02-15").collect()}
    assert latest[1].ano_mes == D(2020, 2, 1) and latest[1].situacao_cadastral is None
    last = {r.cnpj: r for r in panel.asof_last_non_null(df, "2020-02-15").collect()}
    assert last[1].situacao_cadastral == 2 and last[1].capital_social == 10.0
    assert last[2].situacao_cadastral is None and last[2].capital_social == 5.0


def test_unseen_category_maps_to_zero(spark):
    train = spark.createDataFrame([("SP",), ("RJ",), ("MG",)], "uf string")
    test = spark.createDataFrame([("RJ",), ("XX",), (None,)], "uf string")
    mapping = dataset.mapping_from(train, "uf")
    assert {r.value: r.code for r in mapping.collect()} == {"MG": 0, "RJ": 1, "SP": 2}
    out = {r.uf: r.uf_encoded for r in dataset.apply_mapping(test, "uf", mapping).collect()}
    assert out == {"RJ": 1, "XX": 0, None: 0}


def test_confidence_bands_edges_and_empty_bands(spark):
    pred = spark.createDataFrame([(0.0, True), (0.5, True), (0.5000001, False), (0.7, False), (1.0, True)],
                                 "prob_max double, acerto boolean")
    got = {r.band: r for r in evaluate.confidence_bands(pred).collect()}
    assert got["Baixa (0-50%)"].total == 1           # 0 is in no band; 0.5 is right-closed
    assert got["Média (50-70%)"].total == 2
    assert got["Alta (70-90%)"].total == 0 and got["Alta (70-90%)"].taxa_acerto is None
    assert got["Muito Alta (90-100%)"].total == 1


def test_top_k_ties_follow_key(spark):
    from tessera.operators import profile
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), ("b",)], "uf string")
    assert [r.uf for r in profile.top_values(df, "uf", 2).collect()] == ["a", "b"]


def test_fill_mean_and_dropna_nan(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, float("nan")), (3.0, 2.0)], "a double, b double")
    filled = clean.fill_mean(df, ["a"]).collect()
    assert [r.a for r in filled] == [1.0, 2.0, 3.0]
    assert clean.drop_incomplete(df, ["b"]).count() == 2              # NaN is dropped like NULL
    assert clean.add_missing_as_zero(df, ["a", "zz"]).columns == ["a", "zz"]


def test_quarter_semester_and_cyclic_month(spark):
    df = spark.createDataFrame([(D(2020, 6, 1),), (D(2020, 7, 1),), (D(2021, 1, 1),)], "ano_mes date")
    out = features.temporal_features(df, digits=6).orderBy("ano_mes").collect()
    assert [r.semestre for r in out] == [1, 2, 1]                     # H1 = 1, H2 = 2
    assert [r.trimestre for r in out] == [2, 3, 1]
    assert [r.meses_desde_inicio for r in out] == [0, 1, 7]
    assert out[0].mes_sin == 0.0 and not math.copysign(1, out[0].mes_sin) < 0


def test_feature_chain_uses_one_exchange(spark):
    df = _panel(spark, [(e, D(2020, m, 1), 2, 1.0) for e in range(20) for m in range(1, 13)])
    plan = features.feature_frame(df)._jdf.queryExecution().executedPlan().toString()
    # temporal features' minimum is a separate scalar subquery; the window chain itself shuffles once
    body = plan.split("Subquery")[0]
    assert body.count("Exchange hashpartitioning(cnpj") == 1


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(c,) for c in [2] * 6 + [4] * 3 + [8]], "situacao_cadastral int")
    w = dataset.class_weights(df, digits=12).collect()
    assert abs(sum(r["count"] * r.weight for r in w) - 10) < 1e-9
    assert {r.situacao_cadastral: round(r.weight, 6) for r in w} == {2: round(10 / 18, 6), 4: round(10 / 9, 6),
                                                                     8: round(10 / 3, 6)}


def test_confusion_cells_sum_to_rows(spark):
    pred = spark.createDataFrame([(2, 2), (2, 4), (4, 4), (8, 2), (8, 8)], "y_true int, y_pred int")
    cm = evaluate.confusion_counts(pred)
    assert cm.count() == 9 and sum(r["count"] for r in cm.collect()) == 5
    m = evaluate.overall_metrics(cm).collect()[0]
    assert m.accuracy == 0.6
    rep = {r.label: r for r in evaluate.class_report(cm).collect()}
    assert rep["2"].precision == 0.5 and rep["2"].recall == 0.5 and rep["macro avg"].support == 5
