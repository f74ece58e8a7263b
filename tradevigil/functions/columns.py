"""Column expressions shared by the operators; all built-in, all null-safe under ANSI."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_point(c: ColumnLike, kind: str) -> Column:
    """Cast to a decimal (half up); what does not fit or parse becomes NULL."""
    return _col(c).try_cast(kind)


def exposure(c: ColumnLike = "notional1") -> Column:
    """A traded amount as a decimal wide enough for every amount, so that sums are exact."""
    return fixed_point(c, "decimal(30,2)")


def as_day(c: ColumnLike) -> Column:
    return _col(c).try_cast("date")


def as_double(c: ColumnLike) -> Column:
    return _col(c).try_cast("double")


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def at_least(c: ColumnLike, limit: float) -> Column:
    return flag(_col(c) >= F.lit(limit))


def above(c: ColumnLike, limit: float) -> Column:
    return flag(_col(c) > F.lit(limit))


def same_word(c: ColumnLike, word: str) -> Column:
    return F.upper(_col(c)) == F.lit(word.upper())


def mentions(c: ColumnLike, word: str) -> Column:
    return F.upper(_col(c)).contains(word.upper())


def or_zero(c: ColumnLike) -> Column:
    return F.coalesce(_col(c), F.lit(0))


# Rating words and their scores (fixed values); any other text, or none, scores 1.
RATING_SCORES = {"HIGH": 3, "MEDIUM": 2}


def rating_score(c: ColumnLike) -> Column:
    scored = F
    for word, score in RATING_SCORES.items():
        scored = scored.when(same_word(c, word), F.lit(score))
    return scored.otherwise(F.lit(1))


# Weights of the heuristic surveillance score (fixed values, at most 110 points).
SCORE_WEIGHTS = {
    "notional_ge_1bn": 25,
    "event_within_7d": 20,
    "has_1hop_link": 15,
    "in_three_hop_loop": 20,
    "jurisdiction_risk_score": 5,
    "kyc_risk_score": 5,
}
MAX_HEURISTIC_SCORE = 110


def heuristic_score() -> Column:
    return reduce(lambda a, b: a + b, (or_zero(c) * F.lit(w) for c, w in SCORE_WEIGHTS.items()))


# Limits of the investigation rules (fixed values).
LARGE_TRADE = 200_000_000
HALF_BILLION = 500_000_000
ONE_BILLION = 1_000_000_000
NEAR_EVENT_DAYS = 2


def anomaly_score() -> Column:
    """1 near an event, 1 for a large trade, plus the jurisdiction score."""
    return (
        flag(F.col("days_to_next_event") <= NEAR_EVENT_DAYS)
        + above("notional1", LARGE_TRADE)
        + or_zero("jurisdiction_risk_score")
    )


def insider_label() -> Column:
    return flag(same_word("risk_flag", "INSIDER"))


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    return F.try_divide(_col(a), _col(b))
