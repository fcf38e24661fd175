"""Panel assembly and as-of access.

``assemble_panel`` builds the (company, month) panel from curated bronze
tables - the step implied by the panel's column names: establishments joined to companies on
(``cnpj_basico``, ``ano_mes``), macro indicators joined at month - 1, debts
accumulated over earlier months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DEBT_KINDS, DEBT_LAG_COLUMNS
from ..functions.dates import months_between_starts, parse_month
from .clean import clean_list_columns

ENTITY, PERIOD = "cnpj", "ano_mes"


def curate_panel(df: DataFrame, list_columns=("uf",), period: str = PERIOD) -> DataFrame:
    """Loaded panel -> analysis panel: ``ano_mes`` 'yyyy-MM' -> date (F1, lenient) and
    stringified lists such as ``"['SP']"`` cleaned once (F10), before any feature or
    encoder sees them, so training and scoring agree on the categories."""
    out = clean_list_columns(df, list(list_columns))
    if dict(out.dtypes).get(period) == "string":
        out = out.withColumn(period, parse_month(period, lenient=True))
    return out


def asof_latest(df: DataFrame, as_of: str, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """Each entity's latest row at or before ``as_of`` (whole row).

    ``max_by`` on a struct is a hash aggregate with map-side combine, so a
    hot entity never lands in one task whole.
    """
    cols = [c for c in df.columns if c != entity]
    picked = (df.where(F.col(period) <= F.to_date(F.lit(as_of)))
              .groupBy(entity).agg(F.max_by(F.struct(*cols), F.col(period)).alias("_r")))
    return picked.select(entity, "_r.*")


def asof_last_non_null(df: DataFrame, as_of: str, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """Per entity and column, the last non-NULL value at or before ``as_of``
    (pandas ``groupby().last()``), in one aggregate."""
    cols = [c for c in df.columns if c != entity]
    return (df.where(F.col(period) <= F.to_date(F.lit(as_of)))
            .groupBy(entity)
            .agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(period))).alias(c) for c in cols]))


def debt_movements(debts: DataFrame) -> DataFrame:
    """Landed debt rows (S2/S3) -> (cnpj, ano_mes, kind, valor, ajuizado).

    The debtor's CNPJ loses its punctuation, the amount its decimal comma; a quarter's
    file is known at the quarter's last month; ``kind`` is the word the panel columns
    use.  Rows without a CNPJ or with an unknown type keep NULL there and are left out of the panel.
    """
    kinds = F.create_map(*[F.lit(x) for pair in DEBT_KINDS.items() for x in pair])
    return debts.select(
        F.nullif(F.regexp_replace("cpf_cnpj", r"\D", ""), F.lit("")).alias(ENTITY),
        F.make_date("ano", F.col("trimestre") * 3, F.lit(1)).alias(PERIOD),
        kinds[F.col("tipo")].alias("kind"),
        F.regexp_replace("valor_consolidado", ",", ".").try_cast("double").alias("valor"),
        (F.upper(F.trim("indicador_ajuizado")) == "SIM").alias("ajuizado"))


def _month_number(c: str = PERIOD) -> Column:
    return F.year(c) * 12 + F.month(c)


def accumulate_debts(panel: DataFrame, movements: DataFrame) -> DataFrame:
    """Add to each panel row what its entity owed in **earlier** months, by kind, and the number
    of court-filed FGTS debts.

    Totals run over the union of debt months and panel months, so a debt in a month
    without a panel row, or before the first one, counts from the next panel row on.
    """
    kinds = list(DEBT_KINDS.values())
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("valor"))), F.lit(0.0)).alias(f"_{k}") for k in kinds]
    monthly = movements.where(F.col(ENTITY).isNotNull()).groupBy(ENTITY, PERIOD).agg(
        *sums, F.count_if(F.col("ajuizado") & (F.col("kind") == "fgts")).cast("double").alias("_filed"))
    amounts = [*(f"_{k}" for k in kinds), "_filed"]
    both = panel.withColumns({"_row": F.lit(True), **{a: F.lit(0.0) for a in amounts}}).unionByName(
        monthly.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    earlier = Window.partitionBy(ENTITY).orderBy(_month_number()).rangeBetween(Window.unboundedPreceding, -1)
    names = dict(zip(amounts, DEBT_LAG_COLUMNS, strict=True))
    totals = {names[a]: F.coalesce(F.sum(a).over(earlier), F.lit(0.0)) for a in amounts}
    return both.withColumns(totals).where("_row").drop("_row", *amounts)


def join_macro(panel: DataFrame, macro_wide: DataFrame) -> DataFrame:
    """Left join of the wide monthly table at month - 1, as ``<name>_t_minus_1``."""
    names = [c for c in macro_wide.columns if c != PERIOD]
    shifted = macro_wide.select(F.add_months(parse_month(PERIOD, lenient=True), 1).alias(PERIOD),
                                *[F.col(n).alias(f"{n}_t_minus_1") for n in names])
    return panel.join(shifted, PERIOD, "left")


def assemble_panel(establishments: DataFrame, companies: DataFrame, macro_silver: DataFrame | None = None,
                   debts: DataFrame | None = None) -> DataFrame:
    """Bronze tables -> panel.

    * ``establishments`` / ``companies``: bronze frames with ``ano_mes`` ('yyyy-MM');
      full CNPJ = basico || ordem || dv (rows without one are no entity); inner join on (cnpj_basico, ano_mes).
    * ``macro_silver``: wide monthly table keyed by ``ano_mes`` ('yyyy-MM'), see ``join_macro``.
    * ``debts``: landed debt rows (``read_debts``), see ``debt_movements`` and ``accumulate_debts``.

    With both, the result has the 19 panel columns (and a column for any further macro series).
    """
    est = establishments.select(
        F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias(ENTITY), "cnpj_basico",
        parse_month(PERIOD, lenient=True).alias(PERIOD),
        F.col("situacao_cadastral").try_cast("int").alias("situacao_cadastral"),
        "cnae_fiscal_principal", "uf", F.try_to_date("data_inicio_atividade", "yyyyMMdd").alias("_inicio"))
    comp = companies.select("cnpj_basico", parse_month(PERIOD, lenient=True).alias(PERIOD), "natureza_juridica",
                            "porte_empresa",
                            F.regexp_replace("capital_social", ",", ".").try_cast("double").alias("capital_social"))
    panel = est.where(F.col(ENTITY).isNotNull()).join(comp, ["cnpj_basico", PERIOD], "inner").drop("cnpj_basico")
    w = Window.partitionBy(ENTITY).orderBy(PERIOD)
    panel = panel.withColumns({
        "tempo_atividade_anos": months_between_starts(F.col(PERIOD), F.col("_inicio")) / F.lit(12.0),
        "situacao_cadastral_t_minus_1": F.lag("situacao_cadastral", 1).over(w),
    }).drop("_inicio")
    if debts is not None:
        panel = accumulate_debts(panel, debt_movements(debts))
    return panel if macro_silver is None else join_macro(panel, macro_silver)
