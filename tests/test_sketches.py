"""Distinct counts from sketches that are kept by period."""

from pyspark.sql import functions as F

from tessera.operators import profile as pr

COLS = ["few", "many", "empty"]


def rows(spark):
    return spark.range(60_000).select(
        F.concat(F.lit("2024-0"), (F.col("id") % 6 + 1).cast("string")).alias("ano_mes"), (F.col("id") % 12).alias("few"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 20_011).alias("many"), F.lit(None).cast("string").alias("empty"))


def got(frame):
    return {r["column_name"]: r["n_distinct"] for r in frame.collect()}


def test_ranges_of_periods_are_within_the_error(spark):
    df = rows(spark)
    for lg_k in (10, 14):
        kept = pr.period_sketches(df, COLS, lg_k=lg_k)
        assert kept.count() == 6
        for first, last in ((None, None), ("2024-02", "2024-03"), ("2024-05", None)):
            own = df.where((F.col("ano_mes") >= (first or "")) & (F.col("ano_mes") <= (last or "9")))
            exact, guess = got(pr.distinct_counts(own, COLS)), got(pr.distinct_from_sketches(kept, COLS, first=first, last=last))
            assert exact["few"] == guess["few"] and guess["empty"] == 0
            assert abs(guess["many"] - exact["many"]) <= pr.sketch_error(lg_k) * exact["many"]


def test_a_new_period_joins_the_kept_ones(spark):
    df = rows(spark)
    kept = pr.period_sketches(df.where("ano_mes < '2024-06'"), COLS).unionByName(
        pr.period_sketches(df.where("ano_mes = '2024-06'"), COLS))
    assert got(pr.distinct_from_sketches(kept, COLS)) == got(pr.distinct_from_sketches(pr.period_sketches(df, COLS), COLS))


def test_no_periods(spark):
    kept = pr.period_sketches(rows(spark), COLS)
    assert got(pr.distinct_from_sketches(kept, COLS, first="2030-01")) == {"few": 0, "many": 0, "empty": 0}
