"""Loads of tables known by name: replaced periods, under any session setting and over crashes."""

import uuid

import pytest

from tessera.sinks import tables


@pytest.fixture(params=["static", "dynamic", None])
def session(spark, request):
    if request.param:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", request.param)
    yield spark
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


@pytest.fixture()
def named(session, tmp_dir):
    name = f"t_{uuid.uuid4().hex[:10]}"
    rows = session.range(30).selectExpr("id", "concat('2024-0', 1 + id % 3) as ano_mes")
    tables.create_table_if_absent(session, name, rows.schema, f"{tmp_dir}/{name}", partition_by="ano_mes")
    yield name, rows
    session.sql(f"DROP TABLE {name}")


def counts(spark, name):
    return {r["ano_mes"]: r["count"] for r in spark.table(name).groupBy("ano_mes").count().collect()}


def test_one_period_is_replaced(session, named):
    name, rows = named
    assert tables.load_table(rows, name).count() == 30
    again = rows.where("ano_mes = '2024-02' and id < 10")
    assert tables.load_table(again, name, replace_partitions=True).count() == 23
    assert counts(session, name) == {"2024-01": 10, "2024-02": 3, "2024-03": 10}
    new = session.sql("SELECT 99L AS id, '2024-09' AS ano_mes")
    tables.load_table(new, name, replace_partitions=True)
    assert counts(session, name)["2024-09"] == 1 and session.table(name).count() == 24


def test_a_full_load_drops_stale_periods(session, named):
    name, rows = named
    tables.load_table(rows, name)
    assert tables.load_table(rows.where("ano_mes = '2024-02'"), name).count() == 10
    assert counts(session, name) == {"2024-02": 10}
    assert tables.load_table(rows.limit(0), name).count() == 0


def test_append_adds_to_a_replaced_period(session, named):
    name, rows = named
    tables.load_table(rows, name)
    tables.load_table(rows.where("ano_mes = '2024-02'"), name, replace_partitions=True)
    assert tables.load_table(rows, name, mode="WRITE_APPEND").count() == 60
    assert counts(session, name) == {"2024-01": 20, "2024-02": 20, "2024-03": 20}


class Killed(RuntimeError):
    pass


def dying_after(n):
    left = [n]
    point = tables._point

    def run(*args):
        if left[0] == 0:
            raise Killed
        left[0] -= 1
        point(*args)
    return run


@pytest.mark.parametrize("swapped", [0, 1, 2])
@pytest.mark.parametrize("replace", [True, False])
def test_a_load_that_dies_loses_no_period(session, named, monkeypatch, swapped, replace):
    name, rows = named
    tables.load_table(rows, name)
    later = rows.selectExpr("id + 100 as id", "ano_mes")
    with monkeypatch.context() as m:
        m.setattr(tables, "_point", dying_after(swapped))
        with pytest.raises(Killed):
            tables.load_table(later, name, replace_partitions=replace)
    session.catalog.refreshTable(name)
    seen = session.table(name).collect()
    assert len(seen) == 30 and len({r["ano_mes"] for r in seen}) == 3
    # each period is wholly old or wholly new
    news = {r["ano_mes"] for r in seen if r["id"] >= 100}
    assert len(news) == swapped and not news & {r["ano_mes"] for r in seen if r["id"] < 100}
    assert {r["id"] for r in tables.load_table(later, name, replace_partitions=replace).collect()} == set(range(100, 130))


def test_odd_and_null_periods(session, tmp_dir):
    name = f"t_{uuid.uuid4().hex[:10]}"
    rows = session.createDataFrame([(1, "a b/c=d"), (2, "it's"), (3, None), (4, "50%"), (5, "x\\y")], "n int, p string")
    tables.create_table_if_absent(session, name, rows.schema, f"{tmp_dir}/{name}", partition_by="p")
    tables.load_table(rows, name)
    more = rows.selectExpr("n * 10 as n", "p")
    got = tables.load_table(more, name, replace_partitions=True).collect()
    assert sorted((r["n"], r["p"] or "") for r in got) == sorted((r["n"] * 10, r["p"] or "") for r in rows.collect())
    assert {r["n"] for r in tables.load_table(more.where("p is null"), name).collect()} == {30}
    session.sql(f"DROP TABLE {name}")


def test_replaced_files_are_removed_when_asked(session, named, tmp_dir):
    name, rows = named
    tables.load_table(rows, name)
    before = session.table(name)
    tables.load_table(rows.where("ano_mes = '2024-02'"), name, replace_partitions=True)
    assert before.count() == 30  # a reader of the earlier state still has its files
    assert tables.remove_replaced(session, name) == 0  # two periods of the first load are read
    tables.load_table(rows.where("id < 20"), name)
    assert tables.remove_replaced(session, name) == 2
    assert session.table(name).count() == 20


def test_a_table_without_partitions(session, tmp_dir):
    name = f"t_{uuid.uuid4().hex[:10]}"
    rows = session.range(5).toDF("id")
    tables.create_table_if_absent(session, name, rows.schema, f"{tmp_dir}/{name}")
    for n in (5, 3, 4):
        assert tables.load_table(rows.limit(n), name, replace_partitions=True).count() == n
    assert tables.load_table(rows, name, mode="WRITE_APPEND").count() == 9
    assert tables.remove_replaced(session, name) == 2 and session.table(name).count() == 9
    session.sql(f"DROP TABLE {name}")
