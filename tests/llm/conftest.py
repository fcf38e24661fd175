import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    T.StructField("length", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("label", T.StringType()), T.StructField("gone", T.LongType()), T.StructField("lines", T.LongType()),
    T.StructField("text_hash", T.StringType())])


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", len(text or ""), "x", None, "y", "z", 1, None, "h")


def corpus(seed=3, n=40):
    """Prose with nulls, empty and very long texts, copies, near copies, repeated lines and rows, odd characters."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ba", "Do", "ké", "ÑU", "x9", "it's", "日本") for b in ("n", "LO", "", "ra,", "t.")]

    def prose(k):
        out = [rng.choice(vocabulary) for _ in range(k)]
        return "".join(w + rng.choice([" ", " ", " ", "  ", "\t", "\n"]) for w in out).strip()

    shared, line = prose(70), "Every page of this site ends with the same words"
    rows = [row(0, None), row(1, ""), row(2, " \n\t "), row(3, "!!! ... ###"), row(4, "one"), row(5, "One two THREE"),
            row(6, "   x y \x1c z"), row(None, prose(60)), row(None, shared), row(8, prose(9000)), row(9, "z" * 3000)]
    for k in range(10, n):
        kind = k % 6
        if kind == 0:
            rows.append(row(k, shared if k % 4 else shared.replace(" ", "  ")))
        elif kind == 1:
            rows.append(row(k, prose(30) + " " + shared + "\n" + prose(20)))
        elif kind == 2:
            rows.append(row(k, line + f" {k % 3}\n" + prose(90) + "\n" + line))
        elif kind == 3:
            own = shared.split(" ")
            own[k % len(own)] = "changed"
            rows.append(row(k, " ".join(own)))
        else:
            rows.append(row(k, prose(rng.choice([20, 60, 200]))))
    rows += [rows[12], rows[12], row(12, "another text of the same id " + shared), row(-5, shared), row(n, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """The tables here are tiny and some operators run many short stages."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def small(spark):
    rows = corpus()
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
