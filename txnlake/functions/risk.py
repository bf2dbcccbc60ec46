"""Risk score and rule expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnlake import fixed_values as fixed

# Score by amount band, and the top of the scale.
BANDS = [(1000, 60), (3000, 75)]
TOP_BAND = 90
MAX_SCORE = 100
HIGH_AMOUNT = 3000


def risk_band(amount: Column) -> Column:
    score = F.lit(TOP_BAND)
    for limit, value in reversed(BANDS):
        score = F.when(amount < limit, value).otherwise(score)
    return score.cast("int")


def capped_score(score: Column) -> Column:
    return F.least(F.lit(MAX_SCORE), score).cast("int")


def _labels(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rule_candidates(amount: Column, channel: Column, is_international: Column) -> Column:
    """Distinct rule labels a flagged transaction may carry."""
    none = F.array().cast("array<string>")
    return F.array_distinct(
        F.concat(
            _labels(fixed.GENERIC_RULES),
            F.when(amount > HIGH_AMOUNT, _labels(fixed.HIGH_AMOUNT_RULES)).otherwise(none),
            F.when(channel.isin("ONLINE", "MOBILE"), _labels(fixed.ONLINE_RULES)).otherwise(none),
            F.when(is_international == 1, _labels(fixed.INTERNATIONAL_RULES)).otherwise(none),
        )
    )


def alert_outcome(is_confirmed: Column) -> Column:
    return (
        F.when(is_confirmed == 1, fixed.CONFIRMED)
        .when(is_confirmed == 0, fixed.FALSE_POSITIVE)
        .otherwise(fixed.PENDING_REVIEW)
    )
