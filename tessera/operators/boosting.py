"""Multi-class boosted trees on histograms.

A round grows one tree for each class, on the softmax's gradients.  Numbers are cut into at
most ``max_bins`` bins by their quantiles; a category becomes the (smoothed) mean of the label's
code over its rows, from a distributed table, and is then cut like a number, so a column of
any number of categories needs no more bins than any other.

One aggregate makes a level of all trees of a round: tasks add up gradients by (class, node,
feature, bin) in fixed arrays, Spark sums them by slot, and the driver picks the splits from
classes x nodes x features x bins sums, whatever the number of rows.  Rows keep their margins;
they are written anew every ``REFRESH`` rounds, and tasks apply the few trees since then.

Missing values have a bin of their own, on the side where they gain more.  A row's part in a
round follows from its place in the written training rows, so a task that is run again sees the same sample.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MODEL_FEATURES, TARGET
from ..session import cut_lineage
from .models import split_features

#: Rounds after which margins are written.
REFRESH = 10
#: Rows that a category's mean is worth before any of its own is seen.
PRIOR_ROWS = 10.0


@dataclass
class Tree:
    """Nodes of a binary tree by number: children of i are 2 i + 1 and 2 i + 2."""

    feature: np.ndarray  # -1 at a leaf
    bin: np.ndarray      # goes left up to this bin
    missing_left: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = (1 << depth + 1) - 1
        return Tree(np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool), np.zeros(n))

    def nodes(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The node that each row has reached."""
        at = np.zeros(len(bins), dtype=np.int64)
        while True:
            moves = np.flatnonzero(self.feature[at] >= 0)
            if not len(moves):
                return at
            node = at[moves]
            x = bins[moves, self.feature[node]]
            left = np.where(x == missing, self.missing_left[node], x <= self.bin[node])
            at[moves] = 2 * node + np.where(left, 1, 2)


@dataclass
class Boosted:
    """A fitted model; ``means`` is the table (column_name, value, mean) of its categories."""

    features: list[str]
    categories: list[str]
    classes: list
    edges: list[np.ndarray]
    base: np.ndarray
    settings: dict
    means: DataFrame | None = None
    rounds: list[list[Tree]] = field(default_factory=list)

    @property
    def missing(self) -> int:
        return self.settings["max_bins"]

    def binned(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.empty((batch.num_rows, len(self.features)), dtype=np.uint8)
        for k, (name, edges) in enumerate(zip(self.features, self.edges, strict=True)):
            x = batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64)
            out[:, k] = np.where(np.isnan(x), self.missing, np.searchsorted(edges, x, side="left"))
        return out

    def margins(self, bins: np.ndarray, first: int, start: np.ndarray) -> np.ndarray:
        """``start`` and what the rounds from ``first`` on add."""
        out = start.copy()
        for trees in self.rounds[first:]:
            for k, tree in enumerate(trees):
                out[:, k] += tree.value[tree.nodes(bins, self.missing)]
        return out


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = softmax(margins)
    g = p.copy()
    g[np.arange(len(y)), y] -= 1
    return g, np.maximum(2 * p * (1 - p), 1e-16)


def in_sample(place: np.ndarray, round_: int, share: float, seed: int) -> np.ndarray:
    """Whether the row at ``place`` takes part in a round."""
    h = (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(round_ * 2654435761 + seed)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype(np.float64) / (1 << 53) < share


def best_splits(hist: np.ndarray, allowed: np.ndarray, l2: float, least_weight: float):
    """(gain, feature, bin, missing_left) of each node; ``hist`` is (node, feature, bin and missing, sums of g and h)."""
    present, absent = hist[:, :, :-1].cumsum(axis=2), hist[:, :, -1:]
    total = present[:, :, -1:] + absent

    def score(x):
        return x[..., 0] ** 2 / (x[..., 1] + l2)

    sides = []
    for missing_left in (True, False):
        left = present + absent if missing_left else present
        right = total - left
        gain = score(left) + score(right) - score(total)
        ok = (left[..., 1] >= least_weight) & (right[..., 1] >= least_weight) & allowed[None, :, None]
        sides.append(np.where(ok, gain, -np.inf))
    every = np.stack(sides, axis=-1).reshape(len(hist), -1)  # feature, bin, side
    best = every.argmax(axis=1)
    n_bins = hist.shape[2] - 1
    return every[np.arange(len(hist)), best], best // (2 * n_bins), best // 2 % n_bins, best % 2 == 0


def category_means(train: DataFrame, categories: list[str], code) -> DataFrame:
    """(column_name, value, mean): the label's mean code over each category's rows, drawn to the whole mean."""
    texts = train.select(code.cast("double").alias("_y"), *(F.col(c).cast("string").alias(c) for c in categories))
    long = texts.unpivot(["_y"], categories, "column_name", "value").where("value is not null")
    prior = texts.agg(F.avg("_y")).scalar()
    return long.groupBy("column_name", "value").agg(
        ((F.sum("_y") + PRIOR_ROWS * prior) / (F.count("*") + PRIOR_ROWS)).alias("mean"))


def with_means(df: DataFrame, categories: list[str], means: DataFrame) -> DataFrame:
    """Each category replaced by its mean, NULL where it was not seen; the join is left to AQE."""
    for c in categories:
        own = means.where(F.col("column_name") == c).select(F.col("value").alias("_v"), F.col("mean").alias("_m"))
        df = df.join(own, F.col(c).cast("string") == F.col("_v"), "left").drop("_v", c).withColumnRenamed("_m", c)
    return df


def _numeric(df: DataFrame, features: list[str], *more) -> DataFrame:
    return df.select(*more, *(F.col(c).cast("double").alias(c) for c in features))


def fit(train: DataFrame, features: list[str] = MODEL_FEATURES, label: str = TARGET, rounds: int = 200, max_depth: int = 6,
        rate: float = 0.1, rows: float = 0.8, columns: float = 0.8, max_bins: int = 32, l2: float = 1.0,
        least_weight: float = 1.0, seed: int = 42, accuracy: int = 10_000) -> Boosted:
    """M2: ``rounds`` rounds of one tree per class, each on its own sample of rows and columns."""
    labelled = train.where(F.col(label).isNotNull())
    classes = [r[0] for r in labelled.select(label).distinct().orderBy(label).collect()]
    code = F.array_position(F.array(*map(F.lit, classes)), F.col(label)) - 1
    categories, numbers = split_features(train, features)
    names = numbers + categories
    means = cut_lineage(category_means(labelled, categories, code)) if categories else None
    encoded = with_means(labelled, categories, means) if categories else labelled
    flat = cut_lineage(_numeric(encoded, names, code.cast("int").alias("y")))
    probs = [k / max_bins for k in range(1, max_bins)]
    cuts = flat.agg(*(F.percentile_approx(F.nanvl(c, F.lit(None)), probs, accuracy).alias(c) for c in names)).first()
    model = Boosted(names, categories, classes, [np.unique(np.array(cuts[c] or [], dtype=np.float64)) for c in names],
                    np.zeros(len(classes)), {"max_bins": max_bins, "max_depth": max_depth}, means)

    own = _lean(model, 0)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = np.tile(own.base, (batch.num_rows, 1))
            yield _state(batch.column("place"), batch.column("y"), own.binned(batch), start)

    schema = "place long, y int, bins binary, margins binary"
    state = cut_lineage(flat.withColumn("place", F.monotonically_increasing_id()).mapInArrow(prepare, schema))
    written = 0
    for r in range(rounds):
        if r - written == REFRESH:
            state = cut_lineage(state.mapInArrow(_refresher(model, written), schema))
            written = r
        _grow(state, model, r, written, rate, rows, columns, l2, least_weight, seed)
    return model


def _state(place, y, bins: np.ndarray, margins: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([place, y, pa.array([b.tobytes() for b in bins], type=pa.binary()),
                                       pa.array([m.tobytes() for m in margins], type=pa.binary())],
                                      ["place", "y", "bins", "margins"])


def _read(batch: pa.RecordBatch, model: Boosted, first: int) -> tuple[np.ndarray, np.ndarray]:
    n = batch.num_rows
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(n, len(model.features))
    start = np.frombuffer(b"".join(batch.column("margins").to_pylist())).reshape(n, len(model.classes))
    return bins, model.margins(bins, first, start)


def _lean(model: Boosted, first: int) -> Boosted:
    """What tasks need of the model: no table, and only the rounds from ``first`` on."""
    return Boosted(model.features, [], model.classes, model.edges, model.base, model.settings, None, model.rounds[first:])


def _refresher(model: Boosted, first: int):
    own = _lean(model, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margins = _read(batch, own, 0)
            yield _state(batch.column("place"), batch.column("y"), bins, margins)
    return run


def _grow(state: DataFrame, model: Boosted, round_: int, first: int, rate: float, rows: float, columns: float, l2: float,
          least_weight: float, seed: int) -> None:
    """One round: a tree for each class, level by level."""
    depth, n_bins, n_features, n_classes = model.settings["max_depth"], model.missing, len(model.features), len(model.classes)
    trees = [Tree.empty(depth) for _ in range(n_classes)]
    chosen = column_sample(n_features, n_classes, columns, round_, seed)
    shape = (n_features, n_bins + 1, 2)
    own = _lean(model, first)
    for level in range(depth):
        begin, width = (1 << level) - 1, 1 << level
        if level and not any((t.feature[(begin - 1) // 2:begin] >= 0).any() for t in trees):
            break
        size = n_classes * width * n_features * (n_bins + 1)

        def sums(batches: Iterator[pa.RecordBatch], begin=begin, width=width, size=size) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, size))
            for batch in batches:
                bins, margins = _read(batch, own, 0)
                keep = in_sample(np.asarray(batch.column("place")), round_, rows, seed)
                bins, y = bins[keep], np.asarray(batch.column("y"))[keep]
                g, h = gradients(margins[keep], y)
                for k, tree in enumerate(trees):
                    node = tree.nodes(bins, n_bins) - begin
                    here = node >= 0  # others have ended in a leaf above
                    base = (k * width + node[here]) * n_features
                    slot = ((base[:, None] + np.arange(n_features)) * (n_bins + 1) + bins[here]).ravel()
                    for s, x in enumerate((g, h)):
                        total[s] += np.bincount(slot, weights=np.repeat(x[here, k], n_features), minlength=size)
            full = np.flatnonzero(total[1])
            yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[0, full]), pa.array(total[1, full])],
                                             ["slot", "g", "h"])

        found = state.mapInArrow(sums, "slot long, g double, h double").groupBy("slot").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        hist = np.zeros((size, 2))
        slot = np.asarray(found.column("slot"))
        hist[slot, 0], hist[slot, 1] = np.asarray(found.column("g")), np.asarray(found.column("h"))
        hist = hist.reshape(n_classes, width, *shape)
        for k, tree in enumerate(trees):
            split_level(tree, begin, hist[k], chosen[k], rate, l2, least_weight)
    model.rounds.append(trees)


def column_sample(n_features: int, n_classes: int, share: float, round_: int, seed: int) -> np.ndarray:
    """Which features the tree of each class may use in a round."""
    rng = np.random.default_rng([seed, round_])
    out = np.zeros((n_classes, n_features), dtype=bool)
    for own in out:
        own[rng.choice(n_features, max(1, round(share * n_features)), replace=False)] = True
    return out


def split_level(tree: Tree, begin: int, hist: np.ndarray, allowed: np.ndarray, rate: float, l2: float,
                least_weight: float) -> None:
    """Split the nodes of one level where that gains, and give both halves their value as leaves."""
    gain, feature, cut, missing_left = best_splits(hist, allowed, l2, least_weight)
    for i in range(len(hist)):
        node = begin + i
        whole = hist[i, 0].sum(axis=0)  # every feature's bins hold all rows of the node
        if not whole[1] or node and tree.feature[(node - 1) // 2] < 0:
            continue
        if not node:
            tree.value[0] = -rate * whole[0] / (whole[1] + l2)
        if not gain[i] > 1e-9:
            continue
        tree.feature[node], tree.bin[node], tree.missing_left[node] = feature[i], cut[i], missing_left[i]
        own = hist[i, feature[i]]
        left = own[:cut[i] + 1].sum(axis=0) + (own[-1] if missing_left[i] else 0)
        for child, (g, h) in ((2 * node + 1, left), (2 * node + 2, whole - left)):
            tree.value[child] = -rate * g / (h + l2)


def score(model: Boosted, df: DataFrame, keep: list[str], label: str = TARGET) -> DataFrame:
    """M3 + F20: predicted class, its probability and one probability column per class; the true label if present."""
    carried = [F.col(c).alias(f"_keep{i}") for i, c in enumerate([*keep, *([label] if label in df.columns else [])])]
    absent = [c for c in model.features if c not in df.columns]
    df = df.select(*carried, *(c for c in model.features if c in df.columns), *(F.lit(None).cast(
        "string" if c in model.categories else "double").alias(c) for c in absent))
    if model.categories:
        df = with_means(df, model.categories, model.means)
    own = _lean(model, 0)
    rows = _numeric(df, model.features, *(f"_keep{i}" for i in range(len(carried))))
    n_kept = len(carried)
    schema = rows.select(*rows.columns[:n_kept]).schema
    for name in ("_class", "_most", *(f"_p{k}" for k in range(len(model.classes)))):
        schema = schema.add(name, "integer" if name == "_class" else "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = own.binned(batch)
            p = softmax(own.margins(bins, 0, np.tile(own.base, (len(bins), 1))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_kept], pa.array(p.argmax(axis=1).astype(np.int32)),
                                              pa.array(p.max(axis=1)), *(pa.array(c) for c in p.T)], schema.fieldNames())

    named = rows.mapInArrow(run, schema)
    code = F.element_at(F.array(*map(F.lit, model.classes)), F.col("_class") + 1)
    names = [*keep, *([label] if len(carried) > len(keep) else [])]
    return named.select(*(F.col(f"_keep{i}").alias(c) for i, c in enumerate(names)),
                        code.alias("situacao_cadastral_predita"), F.col("_most").alias("probabilidade_max"),
                        *(F.col(f"_p{k}").alias(f"prob_classe_{c}") for k, c in enumerate(model.classes)))


def save(model: Boosted, spark, path: str) -> None:
    """M5: the trees and bins as one row, the category means as a table beside it."""
    plain = _lean(model, 0)
    plain.categories = model.categories
    spark.createDataFrame([(bytearray(pickle.dumps(plain)),)], "model binary").write.mode("overwrite").parquet(f"{path}/trees")
    if model.means is not None:
        model.means.write.mode("overwrite").parquet(f"{path}/means")


def load(spark, path: str) -> Boosted:
    model = pickle.loads(bytes(spark.read.parquet(f"{path}/trees").first()["model"]))
    if model.categories:
        model.means = spark.read.parquet(f"{path}/means")
    return model
