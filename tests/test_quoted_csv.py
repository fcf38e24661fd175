"""Files with quoted line breaks, cut into many blocks, against the same files read whole."""

import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from tessera.sources.quoted_csv import read_quoted_csv

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])


def text_of(seed, rows, header=False):
    rng = random.Random(seed)
    out = ["a;b;c"] if header else []
    for k in range(rows):
        kind = rng.randrange(9)
        if kind == 0:
            out.append(f'"{k}";"first\nsecond\n\nfourth";"x"')
        elif kind == 1:
            out.append(f'"{k}";"says ""yes""\n""";"é;ç"')
        elif kind == 2:
            out.append(f"{k};short")
        elif kind == 3:
            out.append(f'{k};"";c;extra;"more\nthan asked"')
        elif kind == 4 and rows > 50:
            out.append(f'"{k}";"' + "\n".join("long line of a long field" for _ in range(rng.randrange(60))) + '";z')
        elif kind == 5:
            out.append("")
        else:
            out.append(f'{k};"plain";"{rng.random()}"')
    return "\n".join(out) + ("\n" if seed % 2 else "")


def whole(spark, path, encoding, header, corrupt):
    schema = T.StructType([*SCHEMA.fields, *([T.StructField("bad", T.StringType())] if corrupt else [])])
    return spark.read.schema(schema).options(sep=";", quote='"', escape='"', multiLine="true", encoding=encoding,
                                             header=header, enforceSchema="true", columnNameOfCorruptRecord="bad",
                                             mode="PERMISSIVE").csv(path)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(params=["97b", "1k", "128m"])
def blocks(spark, request):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("encoding", "header", "corrupt"), [("ISO-8859-1", False, True), ("UTF-8", True, False)])
def test_blocks_give_the_rows_of_whole_files(spark, tmp_path, blocks, encoding, header, corrupt):
    small = blocks == "97b"
    for k in range(3):
        (tmp_path / f"{k}.csv").write_bytes(text_of(k, (20, 9, 1)[k] if small else (400, 90, 3)[k], header).encode(encoding))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(b"not;read;\"")
    path = f"{tmp_path}/*.csv"
    got = read_quoted_csv(spark, path, SCHEMA, ";", encoding, header, corrupt_column="bad" if corrupt else None)
    columns = ["a", "b", "c", *(["bad"] if corrupt else [])]
    assert rows_of(got.select(columns)) == rows_of(whole(spark, path, encoding, header, corrupt).select(columns))
    if blocks == "1k":
        assert spark.read.text(path).rdd.getNumPartitions() >= 4


def test_a_field_over_many_blocks(spark, tmp_path, blocks):
    field = "\n".join(f"line {k}" for k in range(300))
    (tmp_path / "a.csv").write_text(f'1;"{field}";x\n2;y;"{field}"\n')
    got = read_quoted_csv(spark, str(tmp_path), SCHEMA).select("a", "b", "c").collect()
    assert sorted(map(tuple, got)) == [("1", field, "x"), ("2", "y", field)]


def test_a_stray_quote_reads_its_file_whole(spark, tmp_path, blocks):
    (tmp_path / "odd.csv").write_text('1;5" pipe;x\n2;"two\nlines";y\n')
    (tmp_path / "even.csv").write_text('3;"more\nlines";z\n')
    got = read_quoted_csv(spark, str(tmp_path), SCHEMA)
    assert rows_of(got.select("a", "b", "c")) == rows_of(whole(spark, str(tmp_path), "UTF-8", False, False))
    assert {r["_path"].rsplit("/", 1)[1] for r in got.collect()} == {"odd.csv", "even.csv"}
