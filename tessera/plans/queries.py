"""Registered queries: one per operator group of the blueprint, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or the panel Spark derives from them)
in full.  Computed columns carry the same aliases as the SQL oracle in
``plans/oracle.py``; doubles are rounded identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MODEL_FEATURES, STATUS_CODES, STATUS_LABELS, STATUS_LAGS
from ..functions import dates, paths, text
from ..functions.messages import validate_choice
from ..functions.text import clean_list_string, lenient_double
from ..operators import clean as cl
from ..operators import dataset as ds
from ..operators import evaluate as ev
from ..operators import features as fe
from ..operators import macro as mc
from ..operators import manifest as mf
from ..operators import panel as pn
from ..operators import profile as pr
from ..operators import transitions as tr
from ..session import cut_lineage
from ..sources.testdata import table
from . import frames as fr
from .panel import panel

KEYS = ["cnpj", "ano_mes"]
MACRO_COLS = ["selic_meta_mensal_t_minus_1", "ipca_mensal_t_minus_1", "taxa_desemprego_t_minus_1"]


# --- profile -------------------------------------------------------------------------------------

def panel_overview(spark: SparkSession, sf: str) -> DataFrame:
    return pr.overview(panel(spark, sf))


def status_distribution(spark, sf):
    return pr.frequency(panel(spark, sf), "situacao_cadastral", STATUS_LABELS)


def minority_statuses(spark, sf):
    """Statuses of fewer rows than the most frequent one."""
    freq = pr.frequency(panel(spark, sf), "situacao_cadastral", STATUS_LABELS)
    return pr.minority(freq, freq.agg(F.max("count")).scalar())


def top_categories(spark, sf):
    return pr.top_values(panel(spark, sf), "uf", 10)


def distinct_by_sketch(spark, sf):
    """A1 + A4: distinct counts of two ranges of periods from kept sketches, beside the exact ones."""
    cols = ["cnpj", "ano_mes", "situacao_cadastral", "cnae_fiscal_principal", "uf", "porte_empresa", "capital_social"]
    p, lg_k = panel(spark, sf), 14
    kept = cut_lineage(pr.period_sketches(p, cols, lg_k=lg_k))
    parts = []
    for name, last in (("todos", None), ("ate_1995", "1995-12-31")):
        last = None if last is None else F.lit(last).cast("date")
        exact = pr.distinct_counts(p if last is None else p.where(F.col("ano_mes") <= last), cols)
        guess = pr.distinct_from_sketches(kept, cols, last=last).withColumnRenamed("n_distinct", "estimate")
        off = F.abs(F.col("estimate") - F.col("n_distinct"))
        parts.append(exact.join(guess, "column_name").select(
            F.lit(name).alias("periodos"), "column_name", "n_distinct",
            (off <= F.col("n_distinct") * pr.sketch_error(lg_k)).alias("dentro_do_erro")))
    return parts[0].unionByName(parts[1])


def distinct_per_column(spark, sf):
    cols = ["cnpj", "ano_mes", "situacao_cadastral", "cnae_fiscal_principal", "uf", "porte_empresa", "capital_social"]
    return pr.distinct_counts(panel(spark, sf), cols)


def status_by_month(spark, sf):
    return pr.counts_by_year_month(panel(spark, sf))


def status_pivot(spark, sf):
    return pr.pivot_counts(panel(spark, sf), "ano_mes", "situacao_cadastral", STATUS_CODES, "status_")


def status_pivot_percent(spark, sf):
    cols = [f"status_{c}" for c in (*STATUS_CODES, "outras")]
    return pr.row_percent(status_pivot(spark, sf), cols)


def category_pivot(spark, sf):
    """A6 with a list that leaves values out: they are counted together."""
    return pr.pivot_counts(panel(spark, sf), "ano_mes", "cnae_fiscal_principal", ["BUILDING", "MACHINERY"], "cnae_")


def missing_profile(spark, sf):
    return pr.missing_profile(panel(spark, sf))


def describe_numeric(spark, sf):
    return pr.describe(panel(spark, sf), fr.NUMERIC_PROFILE)


def histogram_50(spark, sf):
    return pr.histogram(panel(spark, sf), "capital_social", 50)


def correlation_matrix(spark, sf):
    return pr.correlation_matrix(panel(spark, sf), fr.CORR_COLUMNS)


def correlation_with_target(spark, sf):
    return pr.correlation_with(panel(spark, sf), "situacao_cadastral", fr.CORR_COLUMNS + ["situacao_cadastral"])


def lag_correlation(spark, sf):
    lagged = fe.lag_features(panel(spark, sf))
    return pr.correlation_with(lagged, "situacao_cadastral", [f"situacao_cadastral_lag_{k}" for k in STATUS_LAGS])


# --- macro ---------------------------------------------------------------------------------------

def macro_by_month(spark, sf):
    return pr.group_means(panel(spark, sf), "ano_mes", MACRO_COLS)


def _event_means(spark, sf, unit):
    events = table(spark, sf, "events", "ts", "event_type", "value")
    return mc.series_means(events, "event_type", "ts", "value", unit=unit, period="periodo", digits=6)


def series_daily_means(spark, sf):
    return _event_means(spark, sf, "day")


def macro_wide_outer(spark, sf):
    return mc.wide(_event_means(spark, sf, "hour"), fr.EVENT_TYPES, period="periodo")


def macro_unlisted(spark, sf):
    """J1 with a list that leaves series out: their values are counted."""
    return mc.wide(_event_means(spark, sf, "day"), fr.EVENT_TYPES[:2], period="periodo", unlisted="fora_da_lista")


def macro_silver_fill(spark, sf):
    filled = mc.silver(macro_wide_outer(spark, sf), period="periodo")
    return filled.select("periodo", *[F.round(c, 6).alias(c) for c in fr.EVENT_TYPES])


# --- features ------------------------------------------------------------------------------------

def temporal_features(spark, sf):
    cols = ["ano", "mes", "trimestre", "semestre", "mes_sin", "mes_cos", "meses_desde_inicio"]
    return fe.temporal_features(panel(spark, sf), digits=6).select(*KEYS, *cols)


def lag_features(spark, sf):
    out = fe.lag_features(panel(spark, sf))
    return out.select(*KEYS, "situacao_cadastral", *[f"situacao_cadastral_lag_{k}" for k in STATUS_LAGS])


def debt_lags(spark, sf):
    out = fe.debt_lag_features(panel(spark, sf))
    return out.select(*KEYS, *[c for c in out.columns if "_lag_" in c])


def rolling_mean_std(spark, sf):
    out = fe.rolling_features(panel(spark, sf), digits=6)
    return out.select(*KEYS, "situacao_cadastral", *[c for c in out.columns if "_rolling_" in c])


def rolling_sum(spark, sf):
    out = fe.rolling_sums(panel(spark, sf), digits=2)
    return out.select(*KEYS, *[c for c in out.columns if "_rolling_sum_" in c])


def entity_stats(spark, sf):
    out = fe.entity_stats(panel(spark, sf), digits=6)
    stats = [f"situacao_cadastral_{s}_empresa" for s in ("mean", "std", "min", "max", "count")]
    return out.select(*KEYS, *stats, "tempo_atividade_anos_first", "capital_social_first")


def entity_debt_stats(spark, sf):
    p = panel(spark, sf)
    joined = fe.join_entity_stats(p.select(*KEYS), fe.entity_debt_stats(p, digits=2, mean_digits=6))
    return joined


def relative_position(spark, sf):
    return fe.relative_position(panel(spark, sf), digits=6).select(*KEYS, "posicao_temporal", "total_registros_empresa",
                                                          "posicao_relativa")


def predictor_features(spark, sf):
    return fe.predictor_frame(panel(spark, sf), digits=6, sum_digits=2)


# --- transitions ---------------------------------------------------------------------------------

def status_changes(spark, sf):
    return fr.changes(spark, sf).select(*KEYS, "situacao_cadastral", "situacao_anterior", "houve_mudanca")


def change_totals(spark, sf):
    return tr.change_totals(fr.changes(spark, sf))


def transition_counts(spark, sf):
    return tr.transition_counts(fr.changes(spark, sf))


def origin_of_status(spark, sf):
    return tr.origin_of_status(fr.changes(spark, sf))


def entries_by_month(spark, sf):
    return tr.entries_by_month(fr.changes(spark, sf))


def dynamic_entities(spark, sf):
    return tr.dynamic_entities(fr.changes(spark, sf)).select(*KEYS, "situacao_cadastral", "houve_mudanca")


def sample_histories(spark, sf):
    return pr.sample_histories(panel(spark, sf), 9).select(*KEYS, "situacao_cadastral")


def next_period_targets(spark, sf):
    out = tr.next_period_targets(fr.changes(spark, sf))
    return out.select(*KEYS, "situacao_cadastral", "vai_mudar", "proxima_situacao", "vai_quebrar")


def change_history_features(spark, sf):
    out = tr.change_history(fr.changes(spark, sf), digits=6)
    return out.select(*KEYS, "houve_mudanca", "num_mudancas_anteriores", "meses_desde_ultima_mudanca",
                      "taxa_mudanca_empresa")


def debt_diff(spark, sf):
    out = tr.debt_differences(panel(spark, sf), digits=2)
    return out.select(*KEYS, *[c for c in out.columns if c.endswith("_variacao")])


# --- dataset -------------------------------------------------------------------------------------

def complete_rows(spark, sf):
    feats = fe.feature_frame(panel(spark, sf), digits=6)
    wanted = cl.existing(feats, MODEL_FEATURES)
    return cl.drop_incomplete(cl.select_existing(feats, wanted, keep=["situacao_cadastral", *KEYS]), wanted)


def ordered_split(spark, sf):
    return ds.temporal_split(panel(spark, sf).select(*KEYS)).select(*KEYS, "split")


def entity_order_split(spark, sf):
    return ds.entity_order_split(panel(spark, sf).select(*KEYS)).select(*KEYS, "split")


def date_split(spark, sf):
    return ds.date_split(panel(spark, sf).select(*KEYS), fr.SPLIT_DATE)


def split_distribution(spark, sf):
    return ds.split_distribution(ds.temporal_split(panel(spark, sf).select(*KEYS, "situacao_cadastral")))


def label_encode(spark, sf):
    p = panel(spark, sf)
    parts = ds.date_split(p.select(*KEYS, *fr.ENCODED), fr.SPLIT_DATE)
    fit_on = ds.distinct_values([parts.where(F.col("split") == s) for s in ("train", "test")], fr.ENCODED)
    out = ds.label_encode(p.select(*KEYS, *fr.ENCODED), fr.ENCODED, fit_on=fit_on)
    return out.select(*KEYS, *[f"{c}_encoded" for c in fr.ENCODED])


def encode_unseen_zero(spark, sf):
    p = ds.date_split(panel(spark, sf).select(*KEYS, "uf"), fr.SPLIT_DATE)
    mapping = ds.mapping_from(p.where(F.col("split") == "train"), "uf")
    return ds.apply_mapping(p, "uf", mapping).select(*KEYS, "uf", "uf_encoded")


def class_weights(spark, sf):
    return ds.class_weights(panel(spark, sf))


# --- as-of / panel assembly -----------------------------------------------------------------------

def asof_latest(spark, sf):
    return pn.asof_latest(panel(spark, sf), fr.AS_OF)


def asof_last_non_null(spark, sf):
    return pn.asof_last_non_null(panel(spark, sf), fr.AS_OF)


def panel_macro_join(spark, sf):
    return panel(spark, sf)


# --- evaluation ----------------------------------------------------------------------------------

def confusion_matrix(spark, sf):
    return ev.confusion_counts(fr.predictions(spark, sf))


def confusion_normalised(spark, sf):
    return ev.confusion_normalised(confusion_matrix(spark, sf))


def class_report(spark, sf):
    return ev.class_report(confusion_matrix(spark, sf))


def overall_metrics(spark, sf):
    return ev.overall_metrics(confusion_matrix(spark, sf))


def errors_by_class(spark, sf):
    return ev.errors_by_class(fr.predictions(spark, sf))


def overall_errors(spark, sf):
    return ev.overall_errors(fr.predictions(spark, sf))


def confidence_stats(spark, sf):
    return ev.confidence_stats(fr.predictions(spark, sf))


def confidence_bands(spark, sf):
    return ev.confidence_bands(fr.predictions(spark, sf))


def high_risk_top(spark, sf):
    return ev.high_risk_top(fr.failure_predictions(spark, sf)).select(
        *KEYS, "prob_quebra", "situacao_cadastral", "tempo_atividade_anos", "num_mudancas_anteriores", "y_true")


def risk_by_status(spark, sf):
    return ev.risk_by_status(fr.failure_predictions(spark, sf))


def binary_metrics(spark, sf):
    return ev.binary_metrics(fr.failure_predictions(spark, sf))


def failure_features(spark, sf):
    return fr.failure_training(spark, sf, digits=6, debt_digits=2)


def positive_profile(spark, sf):
    return ev.positive_profile(fr.failure_predictions(spark, sf))


# --- scalar functions ----------------------------------------------------------------------------

def clean_list_strings(spark, sf):
    p = panel(spark, sf).select(*KEYS, F.concat(F.lit("['"), "uf", F.lit("']")).alias("uf_lista"))
    return p.withColumn("uf_limpo", clean_list_string("uf_lista"))


def lenient_numeric(spark, sf):
    ev_ = table(spark, sf, "events", "event_id", "event_type", "props")
    raw = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.get_json_object("props", "$.k"))
    return ev_.select("event_id", raw.alias("k_texto"), lenient_double(raw).alias("k"))


def json_props(spark, sf):
    ev_ = table(spark, sf, "events", "event_id", "event_type", "props")
    decoded = F.unbase64(F.base64(F.col("props").cast("binary"))).cast("string")
    return ev_.select("event_id", F.from_json(decoded, "k int")["k"].alias("k"),
                      validate_choice(F.col("event_type"), ["view", "click", "purchase", "signup"]).alias("tipo_valido"))


def dedup_keep_first(spark, sf):
    """O3: the first order of each (customer, month) by (date, key)."""
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    o = o.withColumn("mes", F.date_format("o_orderdate", "yyyy-MM"))
    return cl.dedup_keep_first(o, ["o_custkey", "mes"], ["o_orderdate", "o_orderkey"])


def scalar_functions(spark, sf):
    """Date parsing/formatting and path handling on order dates."""
    o = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    per = dates.month_key("o_orderdate")
    path = F.concat(F.lit("landing/estabelecimentos/"), per, F.lit("/K3241.D"), F.col("o_orderkey").cast("string"),
                    F.lit(".ESTABELE"))
    return o.select(
        "o_orderkey",
        per.alias("periodo"),
        dates.parse_month(per).alias("mes_data"),
        dates.parse_day(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("dia"),
        dates.parse_timestamp(F.col("o_orderdate").cast("string")).alias("momento"),  # zone-free text
        dates.month_from_parts(F.year("o_orderdate"), F.month("o_orderdate")).alias("mes_partes"),
        dates.month_label_from_parts(F.year("o_orderdate"), F.month("o_orderdate")).alias("rotulo"),
        text.as_string(F.col("o_orderkey")).alias("chave_texto"),
        text.arrow_concat(F.col("o_orderkey"), per).alias("seta"),
        paths.period_of_path(path).alias("periodo_do_caminho"),
        text.dashes_to_underscores(per).alias("periodo_sublinhado"),
        text.split_on(per, "-")[0].alias("ano_texto"),
        text.strip_prefix(path, "landing/").alias("sem_prefixo"),
        text.base_name(path).alias("arquivo"),
        text.stem(path).alias("radical"))


# --- manifests -----------------------------------------------------------------------------------

def _order_years(spark, sf):
    return table(spark, sf, "orders", "o_orderdate").select(F.year("o_orderdate").alias("ano")).distinct()


def work_list(spark, sf):
    return mf.work_grid(_order_years(spark, sf))


def pending_work(spark, sf):
    done = (table(spark, sf, "orders", "o_orderdate")
            .select(F.year("o_orderdate").alias("ano"), F.quarter("o_orderdate").alias("trimestre")))
    return mf.pending(mf.work_grid(_order_years(spark, sf)), done, ["ano", "trimestre"])


def period_filter(spark, sf):
    periods = (table(spark, sf, "orders", "o_orderdate")
               .select(F.date_format("o_orderdate", "yyyy-MM").alias("periodo")).distinct())
    return mf.period_range(periods, "periodo", "1996-03", "1998-11", [1, 2, 3, 6, 12])


#: Links as pages write them, and some that are none; {} is the page's archive.
PLANTED_LINKS = (
    """<a href="/dados/{}.zip">x</a><A class='b > c' HREF = '/a/{}.zip?x=1&amp;y=2'>y</A><!-- <a href="/no/{}.zip"> -->"""
    """<a href=/b/{}.zip>z</a><a data-href="/no/{}" title='href="/no/{}"'>w</a><link href="/no/{}.css"><a name="{}">"""
    """<script>var s = '<a href="/no/{}.js">';</script><a id=1 href="/c&#47;{}&#x2e;zip" href="/no">v</a>""")


def page_links(spark, sf):
    """The pages' links, and to each page links named like a landed archive (or not), written in several ways."""
    names = F.array(*[F.lit(n) for n in ("Estabelecimentos", "Empresa", "lucro_real_", "Socios")])
    archive = F.concat(names[(F.col("page_id") % 4).cast("int")], F.col("page_id").cast("string"))
    pages = table(spark, sf, "pages", "page_id", "html").withColumn(
        "html", F.concat("html", F.replace(F.lit(PLANTED_LINKS), F.lit("{}"), archive)))
    return mf.classify_links(mf.links(pages, keep=["page_id"]))


def row_positions(spark, sf):
    """The position of every row of the panel in period and entity order."""
    return ds.row_index(panel(spark, sf).select(*KEYS), ["ano_mes", "cnpj"])


QUERIES = {name: fn for name, fn in dict(globals()).items()
           if callable(fn) and getattr(fn, "__module__", None) == __name__ and not name.startswith("_")}
