"""Snapshot tables: whole loads, each once, over crashes, retries and loads side by side."""

import pytest
from pyspark.sql import functions as F

from tessera.sinks import snapshots

SCHEMA = "p string, n long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(spark, table, version=None):
    return sorted((r["p"] or "", r["n"]) for r in snapshots.read(spark, table, version).collect())


def test_loads_add_and_replace(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    assert snapshots.commit(frame(spark, ("a", 1), ("b", 2), (None, 3)), t, "one", "p") == 1
    assert snapshots.commit(frame(spark, ("a", 4)), t, "two", "p") == 2
    assert rows(spark, t) == [("", 3), ("a", 1), ("a", 4), ("b", 2)]
    snapshots.commit(frame(spark, ("a", 5)), t, "three", "p", replace=True)
    snapshots.commit(frame(spark, ("c", 6)), t, "four", "p", replaced=["b", "z"])
    assert rows(spark, t) == [("", 3), ("a", 5), ("c", 6)]
    assert rows(spark, t, 2) == [("", 3), ("a", 1), ("a", 4), ("b", 2)]  # older versions stay as they were
    assert snapshots.read(spark, t).schema == frame(spark, ("a", 1)).schema


def test_a_load_is_added_once(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    assert [snapshots.commit(frame(spark, ("a", 1)), t, "one", "p") for _ in range(2)] == [1, 1]
    snapshots.commit(frame(spark, ("a", 2)), t, "two", "p")
    assert snapshots.commit(frame(spark, ("a", 1)), t, "one", "p") == 1
    assert rows(spark, t) == [("a", 1), ("a", 2)]


def test_a_load_that_dies_is_not_seen_and_can_be_run_again(spark, tmp_dir, monkeypatch):
    t = f"{tmp_dir}/t"
    snapshots.commit(frame(spark, ("a", 1)), t, "one", "p")
    put = snapshots._Folder.put_new

    def crash(*_):
        raise OSError("lost")
    monkeypatch.setattr(snapshots._Folder, "put_new", crash)
    with pytest.raises(OSError):
        snapshots.commit(frame(spark, ("a", 2), ("b", 2)), t, "two", "p", replace=True)
    assert rows(spark, t) == [("a", 1)]
    monkeypatch.setattr(snapshots._Folder, "put_new", put)
    snapshots.commit(frame(spark, ("a", 7)), t, "two", "p", replace=True)
    assert rows(spark, t) == [("a", 7)]


def test_two_loads_that_end_together_are_both_kept(spark, tmp_dir, monkeypatch):
    t = f"{tmp_dir}/t"
    snapshots.commit(frame(spark, ("a", 1)), t, "one", "p")
    put, other = snapshots._Folder.put_new, []

    def late(folder, name, text):
        if not other:  # another load takes the version just before
            other.append(1)
            snapshots.commit(frame(spark, ("b", 2)), t, "other", "p")
        return put(folder, name, text)
    monkeypatch.setattr(snapshots._Folder, "put_new", late)
    assert snapshots.commit(frame(spark, ("a", 3)), t, "two", "p") == 3
    assert rows(spark, t) == [("a", 1), ("a", 3), ("b", 2)]


def test_a_reader_keeps_its_version(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    snapshots.commit(frame(spark, ("a", 1)), t, "one", "p")
    reader = snapshots.read(spark, t)
    snapshots.commit(frame(spark, ("a", 2)), t, "two", "p", replace=True)
    assert [r["n"] for r in reader.collect()] == [1]


def test_vacuum_deletes_what_no_kept_version_reads(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    snapshots.commit(frame(spark, ("a", 1), ("b", 2)), t, "one", "p")
    snapshots.commit(frame(spark, ("a", 3)), t, "two", "p", replace=True)
    assert snapshots.vacuum(spark, t, keep=2) == []
    assert snapshots.vacuum(spark, t) == ["one/p=a"]
    assert snapshots.versions(spark, t) == [2] and rows(spark, t) == [("a", 3), ("b", 2)]


def test_odd_values_empty_loads_and_no_table(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    with pytest.raises(ValueError):
        snapshots.read(spark, t)
    snapshots.commit(frame(spark).where("n > 0"), t, "none", "p")
    assert rows(spark, t) == []
    odd = [("x/y", 1), ("a+b c", 2), ("50%", 3), ("{k}*[z]", 4), ("p=q", 5), ("ção", 6)]
    snapshots.commit(frame(spark, *odd), t, "odd", "p")
    assert rows(spark, t) == sorted(odd)
    snapshots.commit(frame(spark, ("a+b c", 9)), t, "more", "p", replace=True)
    assert rows(spark, t) == sorted([("a+b c", 9), *(r for r in odd if r[1] != 2)])
    assert snapshots.read(spark, t).where(F.col("p") == "50%").count() == 1
