"""The pipeline's stages one after another against their plain versions, and the registered queries against SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import quality_rules
from tessera.llm.oracle import ORACLE

from . import brute
from .conftest import SCHEMA, corpus, row
from .test_operators import check_packing, items_of, key, sims_of


def plain(rows, items, hash_of):
    rows = [r for r in rows if brute.quality(r[1], quality_rules.RUN_LIMITS)["kept"]]
    gone = brute.lost_lines([(r[0], hash_of(r[1]), r[1]) for r in rows], sims_of)
    left = []
    for r in rows:
        own = gone.get((r[0], hash_of(r[1])))
        text = r[1] if not own else "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in own)
        if not own or text.split():
            left.append((r[0], text))
    prints = [(d, brute.simhash(t)) for d, t in left]
    left = [r for r, c in zip(left, brute.components(prints), strict=True) if r[0] is None or r[0] == c]
    return [r for r, (n, h, _) in zip(left, brute.hits([t for _, t in left], items, 13), strict=True)
            if not h or 20 * len(h) < n]


def test_pipeline_against_plain_stages(spark, tmp_path):
    rows = [r for r in corpus(8, 60) if r[0] != 8] + [row(500 + k, f"unique{k} " * 3) for k in range(3)]
    items = items_of(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = spark.createDataFrame([(t,) for t in {r[1] for r in rows}], "text string")
    hashes = {r["text"]: r["h"] for r in texts.selectExpr("text", "xxhash64(text) h").collect()}
    want = plain(rows, items, hashes.get)
    assert 3 < len(want) < len(rows)
    check_packing(want, corpus_pipeline.run(spark, str(tmp_path)).collect())


def test_stages_keep_the_columns(small, tmp_path):
    _, docs = small
    spark = docs.sparkSession
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).schema.simpleString() == docs.schema.simpleString()


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert {"pipeline"} <= names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    got = entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert sorted(got.columns) == sorted(columns)
    assert key(cur.fetchall()) == key(tuple(r[c] for c in columns) for r in got.collect())
