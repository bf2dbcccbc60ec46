import random
from decimal import Decimal

from pyspark.sql import functions as F

from txnlake.operators import ordering


def test_rank_matches_competition_rank_across_ranges(spark):
    rng = random.Random(3)
    # A third of the rows share one key; the others span many key ranges.
    keys = [5 if i % 3 == 0 else rng.choice([rng.randrange(50), rng.randrange(10**16)])
            for i in range(900)]
    df = spark.createDataFrame(list(enumerate(keys)), "id long, key long")
    got = {r["id"]: r["rnk"] for r in ordering.rank_descending(df, F.col("key"), "rnk").collect()}
    assert got == {i: 1 + sum(other > k for other in keys) for i, k in enumerate(keys)}


def test_rank_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, 9), (4, None)], "id long, key long")
    ranked = ordering.rank_descending(df, F.col("key"), "rnk").collect()
    assert {r["id"]: r["rnk"] for r in ranked} == {3: 1, 2: 2, 1: 3, 4: 3}


def test_rank_by_risk_orders_by_score_then_amount(spark):
    rows = [(1, 60, "9999.99"), (2, 75, "0.01"), (3, 75, "10.00"), (4, 75, "10.00")]
    df = spark.createDataFrame(
        [(i, s, Decimal(a)) for i, s, a in rows], "alert_id long, risk_score int, amount decimal(14,2)"
    )
    got = {r["alert_id"]: r["risk_rank"] for r in ordering.rank_by_risk(df).collect()}
    assert got == {3: 1, 4: 1, 2: 3, 1: 4}


def test_sample_has_exactly_the_size_and_repeats(spark):
    df = spark.range(5000).withColumnRenamed("id", "pk")
    for size in (0, 1, 137, 5000, 9000):
        rows = ordering.sample_exact(df, "pk", F.lit(size).cast("bigint")).collect()
        assert len({r["pk"] for r in rows}) == len(rows) == min(size, 5000)
    pick = lambda seed: {
        r["pk"] for r in ordering.sample_exact(df, "pk", F.lit(100).cast("bigint"), seed).collect()
    }
    assert pick(1) == pick(1) != pick(2)


def test_pages_by_offset_and_by_key_agree(spark):
    df = spark.range(0, 100, 1, 7).selectExpr("id * 3 as pk")
    last = None
    for page in range(11):
        by_offset = [r["pk"] for r in ordering.page_by_key(df, "pk", 10, page * 10).collect()]
        by_key = [r["pk"] for r in ordering.page_after(df, "pk", 10, last).collect()]
        assert by_offset == by_key
        last = by_key[-1] if by_key else last
