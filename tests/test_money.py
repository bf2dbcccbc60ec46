"""Averages are rounded once, from exact sums."""

from decimal import Decimal

from pyspark.sql import functions as F

from txnlake.functions.money import mean_money, mean_scaled


def test_means_of_ten_thousand_rows(spark):
    cents = "cast(case when id < 5000 then 0.02 else 0.01 end as decimal(14,2))"
    rows = spark.range(10_001).selectExpr(f"{cents} as v", f"-{cents} as w")
    got = rows.agg(mean_money(F.col("v")).alias("v"), mean_money(F.col("w")).alias("w")).first()
    assert (got.v, got.w) == (Decimal("0.01"), Decimal("-0.01"))


def test_halves_go_away_from_zero_and_nulls_do_not_count(spark):
    rows = spark.sql(
        "select cast(v as decimal(14,2)) as v, -cast(v as decimal(14,2)) as w "
        "from values (0.01), (0.02), (null) as t(v)"
    )
    got = rows.agg(mean_money(F.col("v")).alias("v"), mean_money(F.col("w")).alias("w")).first()
    assert (got.v, got.w) == (Decimal("0.02"), Decimal("-0.02"))
    assert rows.where("v > 1").agg(mean_money(F.col("v")).alias("v")).first().v is None


def test_means_of_scores(spark):
    scores = spark.range(10_001).selectExpr("cast(60 + cast(id < 50 as int) as int) as s")
    assert scores.agg(mean_scaled(F.col("s"), 6).alias("m")).first().m == Decimal("60.00")
