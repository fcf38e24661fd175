"""Properties of the exact ordered splits: disjoint, covering, exact cut sizes, order-respecting."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import dataset


def _frame(spark, keys):
    return spark.createDataFrame([(e, dt.date(2000 + m // 12, m % 12 + 1, 1)) for e, m in keys],
                                 "cnpj long, ano_mes date")


def _check(rows, order, fractions, names):
    rows = sorted(rows, key=order)
    n = len(rows)
    cuts = [int(f * n) for f in fractions]
    for i, r in enumerate(rows, start=1):
        expected = next((nm for c, nm in zip(cuts, names) if i <= c), names[-1])
        assert r.split == expected, (i, r)


@pytest.mark.parametrize("hot", [False, True])
def test_temporal_split_exact(spark, hot):
    keys = [(e, m) for e in range(40) for m in range(0, 30, 1 + e % 3)]
    if hot:  # one month holding a large share of rows
        keys += [(1000 + e, 20) for e in range(400)]
    out = dataset.temporal_split(_frame(spark, keys)).collect()
    assert len(out) == len(set(keys))
    _check(out, lambda r: (r.ano_mes, r.cnpj), (0.7, 0.9), ("train", "val", "test"))


def test_entity_order_split_exact(spark):
    keys = [(e * 7 % 101, m) for e in range(101) for m in range(e % 5 + 1)]
    out = dataset.entity_order_split(_frame(spark, keys)).collect()
    _check(out, lambda r: (r.cnpj, r.ano_mes), (0.8,), ("train", "test"))


@settings(max_examples=8, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 60), st.integers(0, 23)), min_size=1, max_size=300))
def test_temporal_split_property(spark, keys):
    out = dataset.ordered_split(_frame(spark, sorted(keys)), ["ano_mes", "cnpj"], sub_buckets=4).collect()
    assert len(out) == len(keys)
    _check(out, lambda r: (r.ano_mes, r.cnpj), (0.7, 0.9), ("train", "val", "test"))


def test_null_periods_and_text_keys_are_labelled(spark):
    rows = [(f"K{k}" if k % 7 else None, k % 5 if k % 10 else None) for k in range(100)]
    df = spark.createDataFrame(rows, "cnpj string, ano_mes int")
    for level in ("value", "range"):
        order = ["ano_mes", "cnpj"] if level == "value" else ["cnpj", "ano_mes"]
        out = dataset.ordered_split(df, order, level1=level, buckets=8, sub_buckets=4, sub_key=order[1]).collect()
        at = [0 if c == "ano_mes" else 1 for c in order]
        ranked = sorted(out, key=lambda r: tuple((v is not None, v if v is not None else "") for v in (
            (r.ano_mes, r.cnpj) if level == "value" else (r.cnpj, r.ano_mes))))
        assert len(out) == 100 and at
        assert [r.split for r in ranked] == ["train"] * 70 + ["val"] * 20 + ["test"] * 10


def test_mapping_table_ranks_over_ranges(spark):
    df = spark.createDataFrame([(f"v{k % 40:02d}", str(k % 3)) for k in range(400)] + [(None, "0")], "a string, b string")
    got = {(r.column_name, r.value): r.code for r in dataset.mapping_table(df, ["a", "b"], groups=6).collect()}
    assert got == {**{("a", f"v{k:02d}"): k for k in range(40)}, **{("b", str(k)): k for k in range(3)}}


@pytest.mark.parametrize("level", ["value", "range"])
def test_split_reads_its_rows_few_times(spark, level):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = _frame(spark, [(e, m) for e in range(100) for m in range(20)])
    order = ["ano_mes", "cnpj"] if level == "value" else ["cnpj", "ano_mes"]
    split = dataset.ordered_split(df.mapInArrow(counted, df.schema), order, level1=level)
    parts = {name: split.where(f"split = '{name}'").collect() for name in ("train", "val", "test")}
    assert {name: len(rows) for name, rows in parts.items()} == {"train": 1400, "val": 400, "test": 200}
    # bounds (counted, sampled), sizes, rows of cut buckets; then once for each part
    assert seen.value <= 7 * 2000
