"""Distributed classifiers on ``pyspark.ml``.

Instead of pulling every row to the driver for a single-machine fit, the
whole chain - indexers, assembler, forest - is one ``Pipeline`` fitted on the
executors, and scoring is ``PipelineModel.transform``, which carries the key
columns along (no positional re-binding of predictions).
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MODEL_FEATURES, TARGET
from ..session import cut_lineage
from .clean import existing
from .dataset import class_weights
from .panel import asof_last_non_null


def split_features(df: DataFrame, features: list[str] = MODEL_FEATURES) -> tuple[list[str], list[str]]:
    """(categorical, numeric) features that exist in ``df``."""
    cols = existing(df, features)
    cats = [c for c in cols if dict(df.dtypes)[c] == "string"]
    return cats, [c for c in cols if c not in cats]


def _weighted(train: DataFrame, label: str, weight_col: str) -> DataFrame:
    """Balanced class weights as a literal map column: the weights table has one
    row per label class (a handful), so it is read once and every later pass of
    the fit uses the literal instead of re-aggregating the training rows."""
    w = {r[label]: r["weight"] for r in class_weights(train, label, digits=12).collect()}
    lookup = F.create_map(*[x for k, v in w.items() for x in (F.lit(k), F.lit(float(v)))])
    return train.withColumn(weight_col, lookup[F.col(label)])


def forest(num_trees: int = 200, max_depth: int = 15, min_leaf: int = 5, seed: int = 42, max_bins: int = 32,
           weight_col: str | None = "weight") -> RandomForestClassifier:
    """M1: 200 trees, depth 15, min leaf 5, seed 42 as defaults."""
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_leaf, seed=seed, maxBins=max_bins)
    return rf.setWeightCol(weight_col) if weight_col else rf


def boosted(rounds: int = 200, max_depth: int = 6, rate: float = 0.1, sample: float = 0.8, seed: int = 42,
            max_bins: int = 32) -> OneVsRest:
    """M2: one-vs-rest boosted trees (row and column sampling 0.8)."""
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=max_depth, stepSize=rate,
                        subsamplingRate=sample, featureSubsetStrategy=str(sample), seed=seed, maxBins=max_bins)
    return OneVsRest(classifier=gbt, featuresCol="features", labelCol="label", parallelism=4)


def fit(train: DataFrame, classifier=None, features: list[str] = MODEL_FEATURES, label: str = TARGET,
        weighted: bool = True, materialise: bool = True) -> PipelineModel:
    """M1/M2: indexers (categoricals and the label) + assembler + classifier, fitted on the executors.

    The label is indexed so class code 8 does not become 9 classes; categorical
    indexes keep unseen values as an extra index; ``maxBins`` is raised to the
    largest category count so nominal features are split correctly.

    Fitting runs many passes (indexers, metadata, one job per tree level), so
    the training rows are first written to a reliable checkpoint in the shared
    folder (``materialise``; pass False when ``train`` already reads one): the
    feature lineage is computed once and a lost executor does not recompute it.
    """
    if materialise:
        train = cut_lineage(train)
    cats, nums = split_features(train, features)
    cat_idx = StringIndexer(inputCols=cats, outputCols=[f"{c}_encoded" for c in cats], handleInvalid="keep",
                            stringOrderType="alphabetAsc") if cats else None
    label_idx = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc")
    bins = 32
    if cats:  # fitted once; the indexer knows the sizes
        cat_idx = cat_idx.fit(train)
        bins = max(bins, max(len(labels) for labels in cat_idx.labelsArray) + 2)
    clf = (classifier if classifier is not None else forest()).copy()  # the caller's own stays as it is
    if hasattr(clf, "setMaxBins"):
        clf = clf.setMaxBins(max(bins, clf.getMaxBins()))
    elif isinstance(clf, OneVsRest):
        inner = clf.getClassifier().copy()
        clf = clf.setClassifier(inner.setMaxBins(max(bins, inner.getMaxBins())))
    assembler = VectorAssembler(inputCols=nums + [f"{c}_encoded" for c in cats], outputCol="features",
                                handleInvalid="keep")
    stages = ([cat_idx] if cat_idx else []) + [label_idx, assembler, clf]
    data = train.withColumn(label, F.col(label).cast("string"))
    if weighted and not isinstance(clf, OneVsRest):
        data = _weighted(data, label, "weight")
    elif isinstance(clf, RandomForestClassifier) and clf.isSet("weightCol"):
        clf.clear(clf.weightCol)
    return Pipeline(stages=stages).fit(data)


def _label_model(model: PipelineModel):
    return next(s for s in model.stages if getattr(s, "getOutputCol", lambda: None)() == "label")


def _categorical_indexer(model: PipelineModel):
    return next((s for s in model.stages if hasattr(s, "labelsArray") and s.hasParam("inputCols")
                 and s.isSet("inputCols")), None)


def score(model: PipelineModel, df: DataFrame, label: str = TARGET, keep: list[str] | None = None) -> DataFrame:
    """M3 + F20 + P5: predicted class, top probability and one probability column per class.

    Feature columns the model expects but ``df`` lacks are added first (numeric as
    0, categorical as NULL -> the indexer's "unseen" slot).  The true label, if
    present, is carried aside so unseen classes never reach the label indexer.
    For one-vs-rest models (no probability output) per-class scores are
    normalised with a softmax.
    """
    labels = _label_model(model).labels
    idx = _categorical_indexer(model)
    cat_in = list(idx.getInputCols()) if idx else []
    encoded = {f"{c}_encoded" for c in cat_in}
    num_in = [c for c in feature_names(model) if c not in encoded]
    fills = {c: F.lit(0.0) for c in num_in if c not in df.columns}
    fills.update({c: F.lit(None).cast("string") for c in cat_in if c not in df.columns})
    df = df.withColumns(fills) if fills else df
    if label in df.columns:
        df = df.withColumnRenamed(label, "_y_true")
    out = model.transform(df)
    out = IndexToString(inputCol="prediction", outputCol="_pred", labels=labels).transform(out)
    if "probability" in out.columns:
        probs = vector_to_array("probability")
    else:
        raw = vector_to_array("rawPrediction")
        mx = F.array_max(raw)
        ex = F.transform(raw, lambda v: F.exp(v - mx))
        total = F.aggregate(ex, F.lit(0.0), lambda a, v: a + v)
        probs = F.transform(ex, lambda v: v / total)
    out = out.withColumn("_p", probs)
    per_class = [F.col("_p")[i].alias(f"prob_classe_{lbl}") for i, lbl in enumerate(labels)]
    truth = [F.col("_y_true").cast("int").alias(label)] if "_y_true" in out.columns else []
    return out.select(*(keep or []), *truth, F.col("_pred").cast("int").alias("situacao_cadastral_predita"),
                      F.array_max("_p").alias("probabilidade_max"), *per_class)


def score_month(model: PipelineModel, features_df: DataFrame, as_of: str, keep=("cnpj", "ano_mes"),
                status: str = TARGET) -> DataFrame:
    """M4: features are built on the full history first, then each entity's last known values
    at or before ``as_of`` (O6) are scored, missing numbers as 0; the current status is kept."""
    latest = asof_last_non_null(features_df, as_of)
    cats = set(_categorical_indexer(model).getInputCols()) if _categorical_indexer(model) else set()
    numbers = [c for c in feature_names(model) if c in latest.columns and c not in cats]
    return score(model, latest.fillna(0, subset=numbers), label=status, keep=list(keep))


def feature_names(model: PipelineModel) -> list[str]:
    asm = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return list(asm.getInputCols())


def tree_model(model: PipelineModel):
    return model.stages[-1]


def save(model: PipelineModel, path: str) -> None:
    """M5: persist the fitted pipeline (indexers, assembler, model) together."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_info(spark: SparkSession, model: PipelineModel, metrics: dict | None = None) -> DataFrame:
    """M5: one-row table with the feature list, label mapping and metrics of a run."""
    row = {"features": json.dumps(feature_names(model)), "labels": json.dumps(list(_label_model(model).labels)),
           "stages": json.dumps([type(s).__name__ for s in model.stages]), "metrics": json.dumps(metrics or {})}
    return spark.createDataFrame([row], "features string, labels string, stages string, metrics string")
