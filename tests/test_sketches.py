"""Sketched profiles of date ranges against exact ones."""

from pyspark.sql import functions as F

from vialens.operators import sketches


def events(spark, n=60_000):
    day = F.expr("date_add(date'2026-01-01', cast(id % 10 as int))").alias("ingestion_date")
    number = F.when(F.col("id") % 100 != 0, F.pmod(F.xxhash64("id"), F.lit(100_000)) ** 2).alias("price")
    return spark.range(n).select(day, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(30_000)).cast("string").alias("customer"), number, F.lit("x").alias("constant"))


def test_any_range_of_dates(spark):
    rows = events(spark).cache()
    kept = sketches.date_sketches(rows, ["customer", "constant"], ["price"]).cache()
    assert kept.count() == 10
    for since in ("2026-01-01", "2026-01-04", "2026-01-10"):
        where = F.col("ingestion_date") >= F.lit(since).cast("date")
        got = sketches.range_profile(kept, where).first()
        part = rows.where(where)
        exact = part.agg(F.count("*").alias("n"), F.countDistinct("customer").alias("c"), F.count("price").alias("p")).first()
        assert (got.n_rows, got.n_constant) == (exact.n, 1)
        assert abs(got.n_customer - exact.c) <= 0.025 * exact.c
        for q, value in zip(sketches.QUARTILES, got.quartiles_price, strict=True):
            below = part.where(F.col("price") <= value).count() / exact.p
            assert abs(below - q) <= 0.02


def test_a_date_replaces_its_row(spark):
    rows = events(spark, 2000)
    kept = sketches.date_sketches(rows, ["customer"])
    day = F.col("ingestion_date") == "2026-01-03"
    changed = rows.where(day).withColumn("customer", F.concat(F.lit("new"), "customer"))
    renewed = kept.where(~day).union(sketches.date_sketches(changed, ["customer"]))
    got = sketches.range_profile(renewed).first()
    want = rows.where(~day).union(changed).agg(F.countDistinct("customer")).first()[0]
    assert got.n_customer == want  # few values are counted exactly


def test_no_rows_and_nulls(spark):
    none = events(spark, 0)
    got = sketches.range_profile(sketches.date_sketches(none, ["customer"], ["price"])).first()
    assert (got.n_rows, got.n_customer or 0, got.quartiles_price) == (0, 0, None)
    nulls = spark.range(5).select(F.lit("2026-01-01").alias("ingestion_date"), F.lit(None).cast("string").alias("customer"), F.lit(None).cast("double").alias("price"))
    got = sketches.range_profile(sketches.date_sketches(nulls, ["customer"], ["price"])).first()
    assert (got.n_rows, got.n_customer, got.quartiles_price) == (5, 0, None)
