"""Files that land again under their name with other content."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.sinks import snapshots
from tessera.streaming import by_content


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w", encoding="latin-1") as f:
            f.write(text)


def reader(spark):
    return lambda paths: spark.read.schema("k string, n int").csv(paths).withColumn("_path", F.col("_metadata.file_path"))


def rows(spark, table):
    return sorted((r["arquivo"], r["k"], r["n"]) for r in by_content.loaded(spark, table).collect())


def load(spark, tmp_dir, **more):
    got = by_content.load_changed(spark, f"{tmp_dir}/in", f"{tmp_dir}/t", reader(spark), "*.csv", **more)
    return tuple(got[s] for s in ("novo", "alterado", "igual", "ausente"))


def test_a_replaced_file_is_read_again(spark, tmp_dir):
    put(f"{tmp_dir}/in", a="x,1\ny,2\n", b="z,3\n", empty="")
    assert load(spark, tmp_dir) == (2, 0, 0, 0)
    assert load(spark, tmp_dir) == (0, 0, 2, 0)
    put(f"{tmp_dir}/in", a="x,1\ny,9\n", c="w,4\n")  # as long as before
    assert load(spark, tmp_dir) == (1, 1, 1, 0)
    want = [("a.csv", "x", 1), ("a.csv", "y", 9), ("b.csv", "z", 3), ("c.csv", "w", 4)]
    assert rows(spark, f"{tmp_dir}/t") == want
    os.remove(f"{tmp_dir}/in/b.csv")
    assert load(spark, tmp_dir) == (0, 0, 2, 1) and rows(spark, f"{tmp_dir}/t") == want
    assert load(spark, tmp_dir, gone=True) == (0, 0, 2, 1)
    assert rows(spark, f"{tmp_dir}/t") == [w for w in want if w[0] != "b.csv"]
    put(f"{tmp_dir}/in", b="z,3\n")  # and back as it was
    assert load(spark, tmp_dir, gone=True) == (1, 0, 2, 0) and rows(spark, f"{tmp_dir}/t") == want


def test_a_load_that_dies_before_its_manifest_is_completed(spark, tmp_dir, monkeypatch):
    put(f"{tmp_dir}/in", a="x,1\n")
    commit = snapshots.commit

    def crash(frame, table, *args, **more):
        if table.endswith("manifest"):
            raise OSError("lost")
        return commit(frame, table, *args, **more)
    monkeypatch.setattr(snapshots, "commit", crash)
    with pytest.raises(OSError):
        load(spark, tmp_dir)
    monkeypatch.setattr(snapshots, "commit", commit)
    assert load(spark, tmp_dir) == (1, 0, 0, 0) and rows(spark, f"{tmp_dir}/t") == [("a.csv", "x", 1)]
    assert snapshots.versions(spark, f"{tmp_dir}/t/rows") == [1]
    assert load(spark, tmp_dir) == (0, 0, 1, 0)


def test_the_digest_of_a_split_file_and_of_repeated_lines(spark, tmp_dir):
    put(f"{tmp_dir}/in", a="".join(f"{k},1\n" for k in range(3000)), b="x,1\nx,1\n", c="x,1\ny,1\n", d="x,1\r\n", e="é,1\n")
    whole = by_content.content_manifest(spark, f"{tmp_dir}/in").collect()
    assert len({r["resumo"] for r in whole}) == 5
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        parts = by_content.content_manifest(spark, f"{tmp_dir}/in")
        assert sorted(map(str, parts.collect())) == sorted(map(str, whole))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
