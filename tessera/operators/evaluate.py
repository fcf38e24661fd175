"""Prediction analysis.

Every metric is a ``groupBy`` over the prediction frame (which stays on the
executors); what reaches the driver is at most a classes x classes matrix.
The label grid of the confusion matrix is built from the label union
(one row per class), so its size is bounded by the number of classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CONFIDENCE_BANDS, HIGH_RISK_THRESHOLD
from ..functions.scores import confidence_band, percent, ratio
from ..session import cut_lineage
from .quantiles import exact_quantiles


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def confusion_counts(pred: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """(y_true, y_pred, count) over the sorted label union, missing cells 0.

    The predictions are aggregated exactly once, into a classes x classes table
    that is checkpointed; the label union, the grid and every metric derived
    from the matrix (A24, A25) then read only that small table.
    """
    counts = cut_lineage(pred.groupBy(y_true, y_pred).agg(F.count(F.lit(1)).alias("count")))
    labels = (counts.select(F.col(y_true).alias("l")).unionByName(counts.select(F.col(y_pred).alias("l")))
              .where(F.col("l").isNotNull()).distinct())
    all_labels = labels.agg(F.sort_array(F.collect_list("l"))).scalar()  # one entry per class
    grid = labels.select(F.col("l").alias(y_true), F.explode(all_labels).alias(y_pred))
    return (grid.join(F.broadcast(counts), [y_true, y_pred], "left")
            .withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint")))


def confusion_normalised(cm: DataFrame, y_true: str = "y_true", digits: int = 6) -> DataFrame:
    """Each cell divided by its true-class row total."""
    row = F.sum("count").over(Window.partitionBy(y_true))  # classes x classes rows
    return cm.withColumn("share", F.round(ratio(F.col("count"), row), digits))


def _per_class(cm: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    tp = cm.groupBy(F.col(y_true).alias("label")).agg(
        F.sum(F.when(F.col(y_true) == F.col(y_pred), F.col("count")).otherwise(0)).alias("tp"),
        F.sum("count").alias("support"))
    predicted = cm.groupBy(F.col(y_pred).alias("label")).agg(F.sum("count").alias("predicted"))
    out = tp.join(predicted, "label")
    p = ratio(F.col("tp"), F.col("predicted"))
    r = ratio(F.col("tp"), F.col("support"))
    return (out.withColumn("precision", p).withColumn("recall", r)
            .withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))


def class_report(cm: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", digits: int = 6) -> DataFrame:
    """Precision / recall / F1 / support per class, plus macro and weighted averages."""
    pc = _per_class(cm, y_true, y_pred)
    rows = pc.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                     F.col("support").cast("bigint").alias("support"))
    macro = pc.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                   F.sum("support").cast("bigint").alias("support"))
    n = F.sum("support")
    weighted = pc.agg(F.lit("weighted avg").alias("label"),
                      ratio(F.sum(F.col("precision") * F.col("support")), n).alias("precision"),
                      ratio(F.sum(F.col("recall") * F.col("support")), n).alias("recall"),
                      ratio(F.sum(F.col("f1") * F.col("support")), n).alias("f1"),
                      n.cast("bigint").alias("support"))
    out = rows.unionByName(macro).unionByName(weighted)
    return out.select("label", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")], "support")


def overall_metrics(cm: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", digits: int = 6) -> DataFrame:
    """Accuracy, macro precision / recall / F1 and weighted F1 (0 where undefined)."""
    pc = _per_class(cm, y_true, y_pred)
    return pc.agg(
        F.round(ratio(F.sum("tp"), F.sum("support")), digits).alias("accuracy"),
        F.round(F.avg("precision"), digits).alias("precision_macro"),
        F.round(F.avg("recall"), digits).alias("recall_macro"),
        F.round(F.avg("f1"), digits).alias("f1_macro"),
        F.round(ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")), digits).alias("f1_weighted"))


def binary_metrics(pred: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", positive: int = 1,
                   digits: int = 6) -> DataFrame:
    """A24, binary form: accuracy, and precision / recall / F1 of the positive class (0 where undefined)."""
    real, said = F.col(y_true) == positive, F.col(y_pred) == positive
    row = pred.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(y_true) == F.col(y_pred)).alias("hits"),
                   F.count_if(real & said).alias("tp"), F.count_if(real).alias("real"), F.count_if(said).alias("said"))
    parts = row.select(ratio(F.col("hits"), F.col("n")).alias("accuracy"), ratio(F.col("tp"), F.col("said")).alias("precision"),
                       ratio(F.col("tp"), F.col("real")).alias("recall"), ratio(2 * F.col("tp"), F.col("said") + F.col("real")).alias("f1"))
    return parts.select(*[F.round(c, digits).alias(c) for c in parts.columns])


def errors_by_class(pred: DataFrame, y_true: str = "y_true", digits: int = 4) -> DataFrame:
    """Errors, error rate (rounded), rows and hit rate = 1 - rounded rate, per true class."""
    e = F.col("erro").cast("int")
    return (pred.groupBy(y_true)
            .agg(F.sum(e).cast("bigint").alias("total_erros"), F.round(F.avg(e), digits).alias("taxa_erro"),
                 F.count(F.lit(1)).alias("total_registros"))
            .withColumn("taxa_acerto", F.round(F.lit(1.0) - F.col("taxa_erro"), digits)))


def overall_errors(pred: DataFrame, digits: int = 4) -> DataFrame:
    """Hits and errors, counts and percent."""
    return (pred.agg(F.count(F.lit(1)).alias("total"), F.count_if("acerto").alias("acertos"),
                     F.count_if("erro").alias("erros"))
            .withColumns({"pct_acertos": percent("acertos", "total", digits),
                          "pct_erros": percent("erros", "total", digits)}))


def confidence_stats(pred: DataFrame, prob: str = "prob_max", digits: int = 6, exact: bool = True) -> DataFrame:
    """Mean, median, min, max of the top-class probability."""
    med = F.lit(exact_quantiles(pred, [prob], [0.5])[prob][0]).cast("double") if exact else F.percentile_approx(prob, 0.5, 100_000)
    return pred.agg(F.round(F.avg(prob), digits).alias("mean"), F.round(med, digits).alias("median"),
                    F.round(F.min(prob), digits).alias("min"), F.round(F.max(prob), digits).alias("max"))


def confidence_bands(pred: DataFrame, prob: str = "prob_max", bands=CONFIDENCE_BANDS, digits: int = 4) -> DataFrame:
    """Rows, hits and hit percent per right-closed band; empty bands listed (rate NULL);
    a probability of exactly 0 falls in no band."""
    spark = pred.sparkSession
    grid = spark.createDataFrame([(i, lbl) for i, (_, _, lbl) in enumerate(bands)], "band_order int, band string")
    stats = (pred.withColumn("band", confidence_band(prob, bands)).where(F.col("band").isNotNull())
             .groupBy("band").agg(F.count(F.lit(1)).alias("total"), F.count_if("acerto").alias("acertos"),
                                  F.round(F.avg(F.col("acerto").cast("double")) * 100, digits).alias("taxa_acerto")))
    return (grid.join(F.broadcast(stats), "band", "left")   # one row per band
            .select("band_order", "band", F.coalesce("total", F.lit(0)).alias("total"),
                    F.coalesce("acertos", F.lit(0)).alias("acertos"), "taxa_acerto"))


def high_risk(pred: DataFrame, prob: str = "prob_quebra", threshold: float = HIGH_RISK_THRESHOLD) -> DataFrame:
    """Rows above the risk threshold."""
    return pred.where(F.col(prob) > threshold)


def high_risk_top(pred: DataFrame, prob: str = "prob_quebra", n: int = 15, keys=("cnpj", "ano_mes"),
                  threshold: float = HIGH_RISK_THRESHOLD) -> DataFrame:
    """Top-n by probability (ties by key), a global top-k."""
    return high_risk(pred, prob, threshold).orderBy(F.desc(prob), *keys).limit(n)


def risk_by_status(pred: DataFrame, status: str = "situacao_cadastral", prob: str = "prob_quebra",
                   threshold: float = HIGH_RISK_THRESHOLD, digits: int = 6) -> DataFrame:
    """Among high-risk rows, count and mean probability per current status."""
    return (high_risk(pred, prob, threshold).groupBy(status)
            .agg(F.count(F.lit(1)).alias("count"), F.round(F.avg(prob), digits).alias("mean_prob")))


def positive_profile(pred: DataFrame, entity: str = "cnpj", y_true: str = "y_true", y_pred: str = "y_pred",
                     prob: str = "prob_quebra", digits: int = 6) -> DataFrame:
    """Rows, entities, detected, detection rate and means over true positives' rows."""
    pos = pred.where(F.col(y_true) == 1)
    return pos.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(entity).alias("entities"),
                   F.sum(y_pred).cast("bigint").alias("detected"),
                   F.round(F.avg(F.col(y_pred).cast("double")) * 100, digits).alias("detection_pct"),
                   F.round(F.avg(prob), digits).alias("mean_prob"),
                   F.round(F.avg("tempo_atividade_anos"), digits).alias("mean_age"),
                   F.round(F.avg("num_mudancas_anteriores"), digits).alias("mean_changes"))


def feature_importance(spark, names: list[str], importances, families: dict[str, list[str]] | None = None,
                       top: int | None = None) -> DataFrame:
    """Ranked importances, or the sum per family: a family lists features by name or, after a
    ``*``, by a part of the name; families may overlap.

    ``importances`` is the model's feature-importance vector: one value per
    feature, already on the driver as part of the fitted model.
    """
    rows = [(n, float(v)) for n, v in zip(names, importances.toArray())]
    df = spark.createDataFrame(rows, "feature string, importance double")
    if families:
        # features x families, both a few dozen entries of the fitted model
        def belongs(name: str, members: list[str]) -> bool:
            return any(m[1:] in name if m.startswith("*") else m == name for m in members)
        own = [(family, n, v) for family, members in families.items() for n, v in rows if belongs(n, members)]
        return spark.createDataFrame(own, "family string, feature string, importance double").groupBy("family").agg(
            F.sum("importance").alias("importance"), F.count(F.lit(1)).alias("features"))
    ranked = df.orderBy(F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked
