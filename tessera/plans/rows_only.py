"""Registered queries over landed files, streams and models.

Each one lands files that Spark derives from the driver tables in a folder under the
shared checkpoint directory (once per session and table folder), then runs the operator
on the whole of them.  The deterministic ones have SQL in ``plans/oracle_landed.py``;
models have none and are tested in ``tests/test_models.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..constants import (BAD_ROW_BUDGET, DEBT_TYPES, FAILURE_FEATURES, FEATURE_FAMILIES, MACRO_SERIES,
                         MODEL_FEATURES)
from ..operators import boosting as bt
from ..operators import dataset as ds
from ..operators import evaluate as ev
from ..operators import features as fe
from ..operators import macro as mc
from ..operators import models as md
from ..operators import panel as pn
from ..operators.clean import drop_incomplete, existing
from ..session import cut_lineage, shared_path
from ..sinks import snapshots
from ..sinks import tables as sk
from ..sources import landed, series
from ..sources.testdata import table
from ..streaming import by_content, incremental, stateful, triggered
from . import frames as fr
from .panel import panel

KEYS = ["cnpj", "ano_mes"]
LANDED_FILES = "*.{csv,txt}"


def _scratch(spark: SparkSession, what: str) -> str:
    return shared_path(spark, "tessera-work", what, uuid.uuid4().hex)


_LANDED: dict[tuple[str, str, str], str] = {}


def _landed_once(spark: SparkSession, sf: str, what: str, land: Callable[[str], None]) -> str:
    """Folder of a landed file set, written on first use in this session."""
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _LANDED:
        root = _scratch(spark, what)
        land(root)
        _LANDED[key] = root
    return _LANDED[key]


def _basico() -> F.Column:
    return F.lpad(F.col("cnpj").cast("string"), 8, "0")


def establishment_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Establishment rows in the landed layout, derived from the panel; some names hold quotes and a newline."""
    p = panel(spark, sf)
    first = F.min("ano_mes").over(Window.partitionBy("cnpj"))
    number = F.col("cnpj").cast("string")
    cols = {c: F.lit(None).cast("string") for c in schemas.ESTABLISHMENT_COLUMNS}
    cols.update({
        "cnpj_basico": _basico(),
        "cnpj_ordem": F.lit("0001"),
        "cnpj_dv": F.lpad((F.col("cnpj") % 97).cast("string"), 2, "0"),
        "identificador_matriz_filial": F.lit("1"),
        "nome_fantasia": F.when(F.col("cnpj") % 5 == 0, F.concat(F.lit('EMPRESA "'), number, F.lit('"\nLTDA')))
        .otherwise(F.concat(F.lit("EMPRESA "), number)),
        "situacao_cadastral": F.col("situacao_cadastral").cast("string"),
        "data_inicio_atividade": F.date_format(first, "yyyyMMdd"),
        "cnae_fiscal_principal": F.col("cnae_fiscal_principal"),
        "uf": F.col("uf"),
    })
    return p.select(*[cols[c].alias(c) for c in schemas.ESTABLISHMENT_COLUMNS],
                    F.date_format("ano_mes", "yyyy-MM").alias("ano_mes"))


def dirty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines for every 37th entity: one too short, one too long, one with a malformed key."""
    p = panel(spark, sf).where(F.col("cnpj") % 37 == 0)
    short = F.concat(_basico(), F.lit(";0001"))
    long = F.concat(_basico(), F.lit(";0002;00;1;NOME LONGO;02" + ";" * 24 + ";extra;extra"))
    bad = F.concat(F.lit("XX"), F.col("cnpj").cast("string"), F.lit(";0003;00;1;RUIM;02" + ";" * 24))
    return p.select(F.explode(F.array(short, long, bad)).alias("value"), F.date_format("ano_mes", "yyyy-MM").alias("ano_mes"))


def company_rows(spark: SparkSession, sf: str) -> DataFrame:
    return panel(spark, sf).select(
        _basico().alias("cnpj_basico"), F.concat(F.lit("RAZAO "), F.col("cnpj").cast("string")).alias("razao_social"),
        F.lit("2062").alias("natureza_juridica"), F.lit("49").alias("qualificacao_responsavel"),
        F.replace(F.format_string("%.2f", "capital_social"), F.lit("."), F.lit(",")).alias("capital_social"),
        F.col("porte_empresa"), F.lit(None).cast("string").alias("ente_federativo_responsavel"),
        F.date_format("ano_mes", "yyyy-MM").alias("ano_mes"))


def _establishments(spark: SparkSession, sf: str) -> str:
    def land(root):
        landed.land_csv(establishment_rows(spark, sf), f"{root}/estabelecimentos")
        # by month, or every task would leave a small file in every month's folder
        dirty = dirty_lines(spark, sf).hint("rebalance", F.col("ano_mes"))
        dirty.write.mode("append").partitionBy("ano_mes").text(f"{root}/estabelecimentos")
    return _landed_once(spark, sf, "estabelecimentos", land)


def _companies(spark: SparkSession, sf: str) -> str:
    return _landed_once(spark, sf, "empresas", lambda root: landed.land_csv(company_rows(spark, sf), f"{root}/empresas"))


def _read_establishments(spark: SparkSession, sf: str, **options) -> DataFrame:
    return landed.read_registry(spark, f"{_establishments(spark, sf)}/estabelecimentos", "estabelecimentos",
                                file_glob=LANDED_FILES, **options)


def _read_companies(spark: SparkSession, sf: str) -> DataFrame:
    return landed.read_registry(spark, f"{_companies(spark, sf)}/empresas", "empresas", file_glob=LANDED_FILES)


def load_bronze_csv(spark, sf):
    """S1/S4/P1 + J10: landed establishments and companies -> assembled panel."""
    out = pn.assemble_panel(_read_establishments(spark, sf), _read_companies(spark, sf))
    return out.withColumn("tempo_atividade_anos", F.round("tempo_atividade_anos", 6))


def landed_periods(spark, sf):
    """Periods that have a folder, of both registry types."""
    parts = [landed.available_periods(spark, f"{root(spark, sf)}/{t}").withColumn("tipo", F.lit(t))
             for t, root in (("estabelecimentos", _establishments), ("empresas", _companies))]
    return sk.append_union(parts)


def load_corrupt_rows(spark, sf):
    """The raw text of rows with too few or too many fields."""
    rows = _read_establishments(spark, sf, corrupt_column="texto")
    return rows.where("texto is not null").select("ano_mes", "cnpj_basico", "cnpj_ordem", "texto")


def _debts(spark: SparkSession, sf: str) -> str:
    def land(root):
        o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                  "o_orderpriority")
        tipo = (F.when(F.col("o_orderstatus") == "F", F.lit("FGTS"))
                .when(F.col("o_orderstatus") == "O", F.lit("Previdenciario")).otherwise(F.lit("Nao_Previdenciario")))
        rows = o.select(
            F.format_string("%08d/0001-%02d", F.col("o_custkey"), F.col("o_custkey") % 97).alias("cpf_cnpj"),
            F.lit("PJ").alias("tipo_pessoa"), F.lit("PRINCIPAL").alias("tipo_devedor"),
            F.concat(F.lit("DEVEDOR "), F.col("o_custkey").cast("string")).alias("nome_devedor"),
            F.lit("SP").alias("uf_devedor"), F.lit("PGFN").alias("unidade_responsavel"),
            F.col("o_orderkey").cast("string").alias("numero_inscricao"),
            F.lit("ATIVA").alias("tipo_situacao_inscricao"),
            F.col("o_orderpriority").alias("situacao_inscricao"), F.lit("0000").alias("receita_principal"),
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("data_inscricao"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("SIM")).otherwise(F.lit("NAO")).alias("indicador_ajuizado"),
            F.when(F.col("o_orderkey") % 211 == 0, F.lit("n/d")).otherwise(
                F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(","))).alias("valor_consolidado"),
            F.year("o_orderdate").alias("ano"),
            F.concat(F.quarter("o_orderdate").cast("string"), F.lit("trimestre")).alias("trimestre"), tipo.alias("tipo"))
        landed.land_csv(rows, root, ["ano", "trimestre", "tipo"], encoding="UTF-8", header=True)
    return _landed_once(spark, sf, "dividas", land)


def load_debts(spark, sf):
    """Debt files of three types landed per year / quarter (from orders), read back
    with one glob per type; year and quarter recovered from the path."""
    root = _debts(spark, sf)
    return sk.append_union([landed.read_debts(spark, root, t) for t in DEBT_TYPES])


def load_debt_rejects(spark, sf):
    """Debts with an amount that is no number go to the reject table; the target has the rest."""
    out, no = _scratch(spark, "dividas-boas"), _scratch(spark, "dividas-ruins")
    rows = load_debts(spark, sf)
    # the tables here are larger than one load of the source; the budget grows with the files
    budget = BAD_ROW_BUDGET["debts"] * max(1, rows.select("ano", "trimestre", "tipo").distinct().count())
    sk.load_with_rejects(rows, landed.bad_debt_rows(rows), out, no, budget)
    read = [spark.read.parquet(path).groupBy("tipo", "ano", "trimestre").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "destino", F.lit(name)) for path, name in ((out, "tabela"), (no, "rejeitos"))]
    return sk.append_union(read)


def _macro_silver(spark: SparkSession, sf: str) -> DataFrame:
    """S7 + A9 + J1 + O2 + K5/K6: the eleven declared series, landed as JSON and loaded to a month-sorted silver table."""
    def land(root):
        li = table(spark, sf, "lineitem", "l_discount", "l_tax", "l_quantity", "l_extendedprice", "l_shipdate")
        by_month = li.groupBy(F.trunc("l_shipdate", "MM").alias("data")).agg(
            *[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in ("l_discount", "l_tax", "l_quantity", "l_extendedprice")],
            *[F.round(F.max(c), 6).alias(f"max_{c}") for c in ("l_discount", "l_tax", "l_quantity", "l_extendedprice")],
            *[F.round(F.min(c), 6).alias(f"min_{c}") for c in ("l_quantity", "l_extendedprice")],
            F.count(F.lit(1)).cast("double").alias("n"))
        sources = [c for c in by_month.columns if c != "data"]
        renamed = by_month.withColumnsRenamed(dict(zip(sources, MACRO_SERIES.values(), strict=True)))
        long = renamed.unpivot(["data"], list(MACRO_SERIES.values()), "serie", "valor")
        # a gap in one series, to be filled
        long = long.where(~((F.col("serie") == "icei") & (F.month("data") == 7)))
        path = series.land_series(long, f"{root}/series")
        means = mc.series_means(series.read_series(spark, path), "serie", "data", "valor")
        wide = mc.wide(means, list(MACRO_SERIES.values())).orderBy("ano_mes")
        declared = schemas.macro_schema(list(MACRO_SERIES.values()))
        wide = wide.select(*[F.col(f.name).cast(f.dataType) for f in declared.fields])
        sk.write_bronze_silver(wide, f"{root}/bronze", f"{root}/silver")
    return spark.read.parquet(f"{_landed_once(spark, sf, 'indicadores', land)}/silver")


def macro_job(spark, sf):
    """The eleven-series indicator job, from landed JSON to silver."""
    out = _macro_silver(spark, sf)
    return out.select("ano_mes", *[F.round(c, 6).alias(c) for c in MACRO_SERIES.values()])


def assembled_panel(spark, sf):
    """Establishments, companies, debts and indicators -> the 19 panel columns."""
    out = pn.assemble_panel(_read_establishments(spark, sf), _read_companies(spark, sf), _macro_silver(spark, sf),
                            load_debts(spark, sf))
    doubles = [f.name for f in schemas.PANEL.fields if f.dataType.simpleString() == "double"]
    return out.select(*[F.round(f.name, 2 if f.name.startswith("pgfn") else 6).alias(f.name) if f.name in doubles
                        else F.col(f.name) for f in schemas.PANEL.fields])


def load_panel_csv(spark, sf):
    """The panel exported as a headered CSV with a leading index column, read back
    with the declared panel schema (index dropped, absent columns NULL)."""
    p = panel(spark, sf)
    out = p.select(F.monotonically_increasing_id().alias("Unnamed: 0"),
                   F.lpad(F.col("cnpj").cast("string"), 14, "0").alias("cnpj"),
                   F.date_format("ano_mes", "yyyy-MM").alias("ano_mes"),
                   F.concat(F.lit("['"), "uf", F.lit("']")).alias("uf"),   # the stringified-list form
                   *[c for c in p.columns if c not in ("cnpj", "ano_mes", "uf")])
    path = _scratch(spark, "panel-csv")
    out.write.mode("overwrite").option("header", "true").csv(path)
    return pn.curate_panel(landed.read_panel_csv(spark, path))


def load_tax_regime(spark, sf):
    """Yearly tax-regime declarations (one per customer and year of orders) landed in
    one folder per regime and read back with the regime taken from the folder."""
    o = table(spark, sf, "orders", "o_custkey", "o_orderdate")
    c = table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    per_year = o.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("ano")).agg(
        F.count(F.lit(1)).cast("int").alias("quantidade_de_escrituracoes"))
    regime = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("lucro_real"))
              .when(F.col("c_mktsegment") == "FURNITURE", F.lit("lucro_arbitrado"))
              .when(F.col("c_mktsegment") == "MACHINERY", F.lit("imunes_e_isentas"))
              .otherwise(F.lit("lucro_presumido")))
    rows = per_year.join(c, "c_custkey").select(
        "ano", F.format_string("%02d.%03d.%03d/0001-%02d", (F.col("c_custkey") / 1000000).cast("int") % 100,
                               (F.col("c_custkey") / 1000).cast("int") % 1000, F.col("c_custkey") % 1000,
                               F.col("c_custkey") % 97).alias("cnpj"),
        F.lit("0").alias("cnpj_da_scp"), F.upper(F.replace(regime, F.lit("_"), F.lit(" "))).alias("forma_de_tributacao"),
        "quantidade_de_escrituracoes", regime.alias("regime"))
    root = _scratch(spark, "regimes")
    landed.land_csv(rows, root, "regime", header=True)
    return landed.read_tax_regime(spark, root)


def load_period_overwrite(spark, sf):
    """K1-K4 + U3: a table is created, loaded in full, its last period loaded again (replacing only
    that period), and read by its name."""
    bronze = cut_lineage(_read_establishments(spark, sf))  # the files are read once
    name = f"tessera_bronze_{uuid.uuid4().hex[:12]}"
    sk.create_table_if_absent(spark, name, bronze.schema, _scratch(spark, "bronze"), partition_by="ano_mes")
    sk.load_table(bronze, name)
    last = bronze.agg(F.max("ano_mes")).scalar()
    again = sk.append_union([bronze.where(F.col("ano_mes") == last)])
    return sk.load_table(again, name, replace_partitions=True)


def load_status(spark, sf):
    """K7: rows, bad rows and status per period of a load."""
    bronze = _read_establishments(spark, sf)
    return sk.load_status(bronze, ["ano_mes"], landed.bad_registry_rows(bronze))


def load_summary(spark, sf):
    """K7: the load's summary line."""
    return sk.load_summary(load_status(spark, sf))


def load_rejects(spark, sf):
    """Rows with a malformed key go to the reject table; the target has the rest."""
    good, no = _scratch(spark, "boas"), _scratch(spark, "ruins")
    bronze = _read_establishments(spark, sf)
    months = bronze.select("ano_mes").distinct().count()  # the budget is that of one period's load
    sk.load_with_rejects(bronze, landed.bad_registry_rows(bronze), good, no, BAD_ROW_BUDGET["registry"] * max(1, months),
                         partition_by="ano_mes")
    kept = spark.read.parquet(good).groupBy("ano_mes").agg(F.count(F.lit(1)).alias("rows"))
    rejected = spark.read.parquet(no).groupBy("ano_mes").agg(
        F.count(F.lit(1)).alias("bad_rows"), F.min("cnpj_basico").alias("first_bad"))
    return kept.join(rejected, "ano_mes", "full").select(
        F.col("ano_mes").cast("string").alias("ano_mes"), F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("bad_rows", F.lit(0)).alias("bad_rows"), "first_bad")


def json_series_load(spark, sf):
    """S7 + A9 + J1 + K5/K6: daily event means landed as JSON series, read back, pivoted,
    written as bronze and mean-filled silver."""
    ev_ = table(spark, sf, "events", "ts", "event_type", "value")
    daily = ev_.groupBy(F.col("event_type").alias("serie"), F.to_date("ts").alias("data")).agg(
        F.round(F.avg("value"), 6).alias("valor"))
    path = series.land_series(daily, _scratch(spark, "series"))
    long = series.read_series(spark, path)
    means = mc.series_means(long.withColumnRenamed("data", "dia"), "serie", "dia", "valor", unit="day",
                            period="dia")
    wide = mc.wide(means, fr.EVENT_TYPES, period="dia")
    root = _scratch(spark, "macro")
    out = sk.write_bronze_silver(wide, f"{root}/bronze", f"{root}/silver", key="dia")
    return out.select("dia", *[F.round(c, 6).alias(c) for c in fr.EVENT_TYPES])


def split_null_periods(spark, sf):
    """D1 over a panel as it is curated: some periods are NULL, and keys are text."""
    p = panel(spark, sf).select(
        F.concat(F.lit("K"), F.col("cnpj").cast("string")).alias("cnpj"),
        F.when(F.col("cnpj") % 10 != 0, F.col("ano_mes")).alias("ano_mes"))
    return ds.temporal_split(p)


def _features(spark, sf) -> DataFrame:
    feats = fe.feature_frame(panel(spark, sf))
    return drop_incomplete(feats, existing(feats, MODEL_FEATURES))


def _small_forest():
    """A forest that fits in seconds; the operator's defaults are 200 trees of depth 15."""
    return md.forest(num_trees=10, max_depth=5, min_leaf=5)


def _train_test(spark, sf):
    # The feature windows are computed once; the split's passes read the checkpoint.
    split = ds.temporal_split(cut_lineage(_features(spark, sf)))
    return split.where(F.col("split") == "train"), split.where(F.col("split") != "train")


def snapshot_loads(spark, sf):
    """K2 + K7: two additions (one run twice), a load that died, and the last period replaced; two versions of the table."""
    p = panel(spark, sf).select("cnpj", F.date_format("ano_mes", "yyyy-MM").alias("ano_mes"), "situacao_cadastral")
    table_ = _scratch(spark, "snapshots")
    third = F.col("cnpj") % 3 == 0
    snapshots.commit(p.where(~third), table_, "um", "ano_mes")
    for _ in range(2):
        before = snapshots.commit(p.where(third), table_, "dois", "ano_mes")
    p.write.partitionBy("ano_mes").parquet(f"{table_}/data/perdida")  # no snapshot names it
    last = p.agg(F.max("ano_mes")).first()[0]  # replaced by name: its new load may have no rows
    snapshots.commit(p.where((F.col("ano_mes") == last) & (F.col("cnpj") % 2 == 0)), table_, "tres", "ano_mes", replaced=[last])
    return sk.append_union([snapshots.read(spark, table_, v).withColumn("versao", F.lit(name))
                            for v, name in ((before, "antes"), (None, "depois"))])


def changed_files(spark, sf):
    """T1 + J5: one file a year, all loaded; then the last year's file lands again, as long as before, and nothing else is read."""
    p = panel(spark, sf).select("cnpj", "ano_mes", "situacao_cadastral", F.year("ano_mes").alias("ano"))
    other = F.when(F.col("cnpj") % 2 == 0, F.lit(8)).otherwise(F.col("situacao_cadastral"))
    last = p.withColumn("situacao_cadastral", other).where(F.col("ano") == p.agg(F.max("ano")).scalar())
    root = _scratch(spark, "changed")
    schema = "cnpj long, ano_mes date, situacao_cadastral int"
    for part in (p, last, last):
        landed.land_named(part, f"{root}/in", "ano")
        by_content.load_changed(spark, f"{root}/in", f"{root}/t", lambda paths: spark.read.schema(schema).csv(paths).withColumn(
            "_path", F.col("_metadata.file_path")))
    return by_content.loaded(spark, f"{root}/t").select("arquivo", "cnpj", "ano_mes", "situacao_cadastral")


def frequency_index(spark, sf):
    """E2 + E4: frequency-ordered index fitted on distinct combinations, as a mapping table."""
    return ds.mapping_table(panel(spark, sf), fr.ENCODED, by_frequency=True)


def forest_scores(spark, sf):
    """M1 + M3 + F20: weighted forest, scored on the later rows."""
    train, test = _train_test(spark, sf)
    model = md.fit(train, _small_forest())
    return md.score(model, test, keep=KEYS)


def boosted_scores(spark, sf):
    """M2: one-vs-rest boosted trees; per-class scores normalised."""
    train, test = _train_test(spark, sf)
    model = md.fit(train, md.boosted(rounds=5, max_depth=3), weighted=False)
    return md.score(model, test, keep=KEYS)


def boosted_softmax(spark, sf):
    """M2 + E2: multi-class boosted trees of depth 6 on histograms (6 rounds; the operator's default is 200)."""
    train, test = _train_test(spark, sf)
    return bt.score(bt.fit(train, rounds=6), test, keep=KEYS)


def feature_importance(spark, sf):
    """Ranked importances of the forest."""
    train, _ = _train_test(spark, sf)
    model = md.fit(train, _small_forest())
    return ev.feature_importance(spark, md.feature_names(model), md.tree_model(model).featureImportances)


def score_month(spark, sf):
    """M4 + M5 + P5: save and reload the pipeline, score each entity's latest row <= a month."""
    feats = fe.feature_frame(panel(spark, sf))
    wanted = existing(feats, MODEL_FEATURES)
    full = cut_lineage(feats.select(*KEYS, "situacao_cadastral", *wanted))  # training rows and scored months come from it
    split = ds.temporal_split(cut_lineage(drop_incomplete(full, wanted)))
    model = md.fit(split.where(F.col("split") == "train"), _small_forest())
    path = _scratch(spark, "model")
    md.save(model, path)
    loaded = md.load(path)
    return md.score_month(loaded, full, fr.AS_OF)


def failure_model(spark, sf):
    """M7: "will close next period" model over entities that changed; company-ordered split."""
    frame = fr.failure_training(spark, sf)
    frame = frame.withColumn("vai_quebrar", F.col("vai_quebrar").cast("string"))
    split = ds.entity_order_split(cut_lineage(frame))
    model = md.fit(split.where(F.col("split") == "train"), _small_forest(), features=FAILURE_FEATURES, label="vai_quebrar")
    return md.score(model, split.where(F.col("split") == "test"), label="vai_quebrar", keep=KEYS)


def importance_by_family(spark, sf):
    """Importance of the forest summed by (overlapping) feature family."""
    train, _ = _train_test(spark, sf)
    model = md.fit(train, _small_forest())
    return ev.feature_importance(spark, md.feature_names(model), md.tree_model(model).featureImportances, FEATURE_FAMILIES)


def incremental_files(spark, sf):
    """Ingest landed files exactly once (second run adds nothing)."""
    root = _establishments(spark, sf)
    out, ckpt = _scratch(spark, "stream-out"), _scratch(spark, "stream-ckpt")
    for _ in range(2):
        stream = incremental.registry_stream(spark, f"{root}/estabelecimentos", "estabelecimentos", file_glob=LANDED_FILES)
        incremental.ingest_available(stream, out, ckpt)
    return spark.read.parquet(out).withColumn("ano_mes", F.col("ano_mes").cast("string"))


def _stateful(spark: SparkSession, sf: str) -> str:
    """The panel's months landed in three parts, the stream run after each; the last part also holds old rows again."""
    def run(root):
        p = panel(spark, sf).select(*KEYS, "situacao_cadastral")
        start = p.agg(F.min("ano_mes")).scalar()
        second, third = F.add_months(start, 24), F.add_months(start, 48)
        again = p.where((F.col("cnpj") % 7 == 0) & (F.col("ano_mes") < second))
        for part in (p.where(F.col("ano_mes") < second),
                     p.where((F.col("ano_mes") >= second) & (F.col("ano_mes") < third)),
                     p.where(F.col("ano_mes") >= third).unionByName(again)):
            part.write.mode("append").parquet(f"{root}/in")
            stateful.features_of_new_files(spark, f"{root}/in", p.schema, f"{root}/out", f"{root}/ckpt")
    return _landed_once(spark, sf, "stateful", run)


def stateful_features(spark, sf):
    """T1 + W1/W3/W9-W11: features of landed months from the stream's state alone; late rows are marked."""
    out = spark.read.parquet(f"{_stateful(spark, sf)}/out")
    return out.select(*[F.round(c, 6).alias(c) if "_rolling_" in c or c.startswith("taxa") else F.col(c) for c in out.columns])


def _triggered(spark: SparkSession, sf: str) -> str:
    """Loads run by trigger messages (from the data's types and latest period); good and bad messages."""
    def run(root):
        landing = f"{root}/landing"
        landed.land_csv(establishment_rows(spark, sf), f"{landing}/estabelecimentos")
        landed.land_csv(company_rows(spark, sf), f"{landing}/empresas")
        latest = panel(spark, sf).agg(F.date_format(F.max("ano_mes"), "yyyy-MM").alias("p"))

        def message(name, payload):
            return F.struct(name.alias("id"), F.base64(payload.cast("binary")).alias("data"))

        def body(**fields):
            return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))

        text = F.lit
        messages = latest.select(F.explode(F.array(
            message(text("todos"), body(data_type=text("all"))),
            message(text("empresas"), body(data_type=text("empresas"), mode=text("WRITE_TRUNCATE"))),
            message(text("ultimo"), body(period=F.col("p"), data_type=text("estabelecimentos"), mode=text("WRITE_TRUNCATE"))),
            message(text("sem-pasta"), body(period=text("1900-01"), data_type=text("empresas"))),
            message(text("tipo-ruim"), body(data_type=text("socios"))),
            message(text("modo-ruim"), body(mode=text("WRITE_SOMETIMES"))),
            message(text("texto-ruim"), text("{not json")))).alias("m")).select("m.*")
        messages.write.mode("overwrite").json(f"{root}/inbox")
        triggered.run_triggered_loads(spark, f"{root}/inbox", landing, f"{root}/tables", f"{root}/status", f"{root}/ckpt")
    return _landed_once(spark, sf, "gatilhos", run)


def triggered_load(spark, sf):
    """Both registry tables as the messages left them."""
    tables = f"{_triggered(spark, sf)}/tables"
    parts = [triggered.current(spark, tables, t).select(F.lit(t).alias("tipo"), F.col("ano_mes").cast("string").alias("ano_mes"),
                                                        "cnpj_basico") for t in ("estabelecimentos", "empresas")]
    return sk.append_union(parts)


def message_status(spark, sf):
    """The status row of every message."""
    return spark.read.parquet(f"{_triggered(spark, sf)}/status").select("id", "mode", "status", "rows")


ROWS_ONLY = {f.__name__: f for f in (
    load_bronze_csv, landed_periods, load_corrupt_rows, load_debts, load_debt_rejects, macro_job, assembled_panel, load_panel_csv,
    load_tax_regime, load_period_overwrite, load_status, load_summary, load_rejects, json_series_load, split_null_periods,
    frequency_index, forest_scores, boosted_scores, boosted_softmax, feature_importance, importance_by_family, score_month, failure_model, incremental_files,
    stateful_features, snapshot_loads, changed_files, triggered_load, message_status)}
