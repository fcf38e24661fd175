"""Features kept as a stream's state against the batch windows."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import features as fe
from tessera.operators import transitions as tr
from tessera.streaming import stateful

SCHEMA = "cnpj long, ano_mes date, situacao_cadastral int"


def month(k):
    return dt.date(2020 + k // 12, 1 + k % 12, 1)


def rows_of(entity):
    """Entities of 1 to 40 months, some months missing, some values NULL."""
    return [(entity, month(k), None if (entity + k) % 11 == 0 else (2, 4, 8)[(entity * k // 5) % 3])
            for k in range(1 + entity * 3) if (entity + k) % 7]


def land(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(folder)


def run(spark, tmp_dir):
    schema = spark.createDataFrame([], SCHEMA).schema
    stateful.features_of_new_files(spark, f"{tmp_dir}/in", schema, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    return spark.read.parquet(f"{tmp_dir}/out")


def rounded(df):
    cols = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(str, df.select(*cols).collect()))


def test_state_gives_what_the_windows_give(spark, tmp_dir):
    rows = [r for entity in range(14) for r in rows_of(entity)]
    for low, high in ((0, 9), (9, 10), (10, 100)):  # many months, one month, and the rest
        land(spark, [r for r in rows if month(low) <= r[1] < month(high)], f"{tmp_dir}/in")
        out = run(spark, tmp_dir)
    batch = (spark.createDataFrame(rows, SCHEMA).withColumn("situacao_cadastral", F.col("situacao_cadastral").cast("double"))
             .transform(fe.lag_features).transform(fe.rolling_features).transform(fe.relative_position)
             .transform(tr.status_changes).transform(tr.change_history))
    shared = [c for c in out.columns if c != "atrasada"]
    kinds = dict(out.dtypes)
    assert out.where("atrasada").count() == 0
    assert rounded(out.select(*shared)) == rounded(batch.select(*(F.col(c).cast(kinds[c]).alias(c) for c in shared)))


def test_late_rows_are_given_out_and_change_nothing(spark, tmp_dir):
    land(spark, [(1, month(0), 2), (1, month(3), 4), (2, month(5), 8)], f"{tmp_dir}/in")
    run(spark, tmp_dir)
    # before the last period, the last period again, no period, and a month in time; entity 2 is not late
    land(spark, [(1, month(1), 8), (1, month(3), 4), (1, None, 2), (1, month(4), 4), (2, month(6), 8)], f"{tmp_dir}/in")
    out = run(spark, tmp_dir)
    late = {(r["cnpj"], r["ano_mes"]) for r in out.where("atrasada").collect()}
    assert late == {(1, month(1)), (1, month(3)), (1, None)} and out.where("atrasada").count() == 3
    last = out.where(F.col("ano_mes") == month(4)).first()
    assert (last["situacao_cadastral_lag_1"], last["situacao_cadastral_lag_2"], last["posicao_temporal"]) == (4.0, 2.0, 2)
    assert last["num_mudancas_anteriores"] == 1 and last["meses_desde_ultima_mudanca"] == 1
    # nothing new: nothing is added
    assert run(spark, tmp_dir).count() == 8


def test_rows_of_one_period_that_arrive_together_are_taken_by_value(spark, tmp_dir):
    land(spark, [(1, month(0), 8), (1, month(0), 2), (None, month(0), 4)], f"{tmp_dir}/in")
    out = {(r["cnpj"], r["situacao_cadastral"]): r["atrasada"] for r in run(spark, tmp_dir).collect()}
    assert out == {(1, 2.0): False, (1, 8.0): True, (None, 4.0): False}


def test_entities_share_the_states_of_a_bucket(spark, tmp_dir):
    # one call of Python and one state for each entity took most of the time on millions of entities
    rows = [(entity, month(k), (2, 4)[(entity + k) % 2]) for entity in range(4000) for k in range(2)]
    for k in range(2):
        land(spark, [r for r in rows if r[1] == month(k)], f"{tmp_dir}/in")
        out = run(spark, tmp_dir)
    assert out.count() == 8000 and out.select("cnpj", "ano_mes").distinct().count() == 8000
    assert out.where("posicao_temporal = 1 and houve_mudanca = 1 and not atrasada").count() == 4000
    assert spark.read.format("statestore").load(f"{tmp_dir}/ckpt").count() <= 1024


def one_by_one(rows, lags, windows):
    """The features of one entity's rows of one batch after another, row by row."""
    history, n, changes, last_change, last, found = [], 0, 0, 0, None, []
    for batch in rows:
        for when, value in sorted(batch, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0.0)):
            if when is None or last is not None and when <= last:
                found.append((when, value, True))
                continue
            before = history[-1] if history else None
            history, n, last = [*history, value], n + 1, when
            change = int(before is not None and before != value)
            changes, last_change = changes + change, n if change else last_change
            row = [history[-1 - k] if k < len(history) else None for k in lags]
            for w in windows:
                own = [v for v in history[-w:] if v is not None]
                mean = math.fsum(own) / len(own) if own else 0.0
                row += [mean, math.sqrt(math.fsum((v - mean) * (v - mean) for v in own) / (len(own) - 1)) if len(own) > 1 else 0.0]
            found.append((when, value, *row, change, changes, n - last_change, n - 1, changes / n, False))
    return found


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_buckets_of_entities_give_what_each_gives_alone(spark, tmp_dir, kind):
    draw = random.Random(kind)
    # numbers that no double tells apart, and rows without an entity beside entity 0
    entities = [None, 0, 2**53, 2**53 + 1, *range(1, 9)]
    values = [None, 2.0, 4.0, 0.1, 0.3, 1e16, -1e16, 1.0, -0.7]
    batches = [[(e, None if draw.random() < 0.05 else month(start + draw.randrange(10)), draw.choice(values))
                for e in entities if draw.random() < 0.8 for _ in range(draw.randrange(12))] for start in (0, 6, 14, 20)]
    for batch in batches:
        df = spark.createDataFrame(batch, "quem bigint, quando date, valor double").withColumn("quem", F.col("quem").cast(kind))
        df.repartition(2).write.mode("append").parquet(f"{tmp_dir}/in")
        stateful.features_of_new_files(spark, f"{tmp_dir}/in", df.schema, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", buckets=2,
                                       entity="quem", period="quando", col="valor", lags=[1, 4], windows=[2, 5])
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert dict(out.dtypes)["quem"] == kind and out.columns[:3] == ["quem", "quando", "valor"]
    late, got = len(out.columns) - 1, {}
    for r in out.collect():
        got.setdefault(r[0] if r[0] is None else int(r[0]), []).append((*r[1:3], True) if r[late] else tuple(r[1:]))
    wanted = {e: one_by_one([[r[1:] for r in batch if r[0] == e] for batch in batches], [1, 4], [2, 5]) for e in entities}
    assert {e: sorted(map(str, rows)) for e, rows in got.items()} == {e: sorted(map(str, rows)) for e, rows in wanted.items() if rows}


def test_sums_are_rounded_once():
    draw = random.Random(7)
    rows = [[draw.choice((1, -1)) * draw.random() * 10.0 ** draw.randrange(-30, 30) for _ in range(12)] for _ in range(500)]
    rows += [[1e40, 1e20, 1.0, -1e40, -1e20] + [0.0] * 7, [1e16, 1.0, 1e-30] + [0.0] * 9, [0.1] * 12]
    assert stateful._sum(list(np.array(rows).T)).tolist() == [math.fsum(r) for r in rows]


def test_a_checkpoint_keeps_its_number_of_buckets(spark, tmp_dir):
    schema = spark.createDataFrame([], SCHEMA).schema
    land(spark, [(1, month(0), 2)], f"{tmp_dir}/in")
    stateful.features_of_new_files(spark, f"{tmp_dir}/in", schema, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", buckets=1)
    land(spark, [(e, month(1), 2) for e in range(50)], f"{tmp_dir}/in")
    with pytest.raises(Exception, match="1 buckets, not 2"):
        stateful.features_of_new_files(spark, f"{tmp_dir}/in", schema, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", buckets=2)
