"""Exact quantiles, row positions and links against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import dataset, manifest
from tessera.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles(spark, accuracy):
    rng = random.Random(2)
    rows = [(rng.choice([None, 0.0, 0.0, rng.gauss(0, 5), 7.0]), float(k), None, rng.choice([1.5, float("nan")]))
            for k in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.731, 0.999, 1.0]
    got = exact_quantiles(df, ["a", "b", "c", "d"], probs, accuracy)
    for i, c in enumerate("abcd"):
        own = sorted((r[i] for r in rows if r[i] is not None), key=lambda v: (math.isnan(v), v))
        for p, v in zip(probs, got[c], strict=True):
            if not own:
                assert v is None
                continue
            at = p * (len(own) - 1)
            lo, hi = own[math.floor(at)], own[math.ceil(at)]
            want = lo if math.floor(at) == math.ceil(at) or lo == hi else lo + (hi - lo) * (at - math.floor(at))
            assert v == pytest.approx(want, nan_ok=True), (c, p)
    assert exact_quantiles(df.limit(0), ["a"], [0.5]) == {"a": [None]}
    assert exact_quantiles(df.where("b = 5"), ["b"], [0.3]) == {"b": [5.0]}


@pytest.mark.parametrize("hot", [3, 100_000])
def test_row_index(spark, hot):
    rng = random.Random(3)
    rows = [(rng.choice([None, "2020-01", "2020-02", "2020-02", f"20{rng.randrange(10, 99)}"]),
             rng.choice([None, f"c{rng.randrange(90)}"]), rng.randrange(3)) for _ in range(700)]
    df = spark.createDataFrame(rows, "p string, e string, n int").repartition(4)
    got = dataset.row_index(df, ["p", "e"], buckets=8, hot_rows=hot).collect()
    assert sorted(r["row_index"] for r in got) == list(range(1, 701))
    assert sorted(map(repr, ((r["p"], r["e"], r["n"]) for r in got))) == sorted(map(repr, rows))
    order = [(r["p"] is not None, r["p"] or "", r["e"] is not None, r["e"] or "") for r in sorted(got, key=lambda r: r["row_index"])]
    assert order == sorted(order)
    again = dataset.row_index(df.repartition(2), ["p", "e"], buckets=5, hot_rows=50).collect()
    key = lambda r: (r["row_index"], r["p"], r["e"], r["n"])
    assert set(map(key, again)) == set(map(key, got))
    assert dataset.row_index(df.limit(0), ["p", "e"]).count() == 0


def test_links_of_html(spark):
    pages = [
        (1, '<a href="x">1</a> <A\nclass="q" HREF = \'y\'>2</A> <a href=z>3</a> <a href=z/>4</a>'),
        (2, '<!-- <a href="no"> --> <link href="no"> <abbr href="no"> <a data-href="no"> <a title=\'href="no"\' id=a>'),
        (3, '<script>"<a href=\'no\'>"</script><style>a{}<a href="no"></style><a href="one" href="no"><a title="a > b" href="two">'),
        (4, '<a href="?a=1&amp;b=2&#47;&#x2F;&lt;&amp;lt;">x</a><a href="">e</a><a href>n</a>'),
        (5, None), (6, ""), (7, "<a href='un closed <b>"), (8, "<a " + "x " * 20_000 + 'href="far">' + "<p>" * 50_000)]
    df = spark.createDataFrame(pages, "id int, html string")
    got = {}
    for r in manifest.links(df, keep=["id"]).orderBy("id", "pos").collect():
        got.setdefault(r["id"], []).append(r["link"])
    assert got == {1: ["x", "y", "z", "z/"], 3: ["one", "two"], 4: ["?a=1&b=2//<&lt;", "", ""], 8: ["far"]}
    assert manifest.links(df.where(F.lit(False))).count() == 0
