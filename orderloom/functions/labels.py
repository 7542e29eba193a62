"""Readable buckets: delivery, review, value tier, order-count tail, customer segments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from orderloom.functions.clean import col

# The labels charts group by, in display order.
DELIVERY_BUCKETS = ("1 · Early / on-time", "2 · 1-3 days late", "3 · 4-7 days late", "4 · 8+ days late")
REVIEW_BUCKETS = ("1-2 ★ detractor", "3 ★ passive", "4-5 ★ promoter")
OUTCOMES = ("on time", "late", "not delivered")
RULE_SEGMENTS = (
    "Champions / Loyal",
    "Lapsing repeat",
    "New / recent (one-off)",
    "Cooling one-off",
    "Dormant one-off",
)


def right_closed(c: Column | str, edges: list[float], labels: list[str]) -> Column:
    """Label of the interval ``(edge, next edge]``; NULL outside the first and last edge."""
    c = col(c)
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges, edges[1:], labels))):
        out = F.when((c > lo) & (c <= hi), F.lit(label)).otherwise(out)
    return out


def delivery_bucket(days_late: Column | str) -> Column:
    d = col(days_late)
    on_time, few, week, more = DELIVERY_BUCKETS
    return (
        F.when(d.isNull(), None).when(d <= 0, on_time).when(d <= 3, few).when(d <= 7, week).otherwise(more)
    )


def review_bucket(score: Column | str) -> Column:
    s = col(score)
    low, mid, high = REVIEW_BUCKETS
    return F.when(s.isNull(), None).when(s <= 2, low).when(s == 3, mid).otherwise(high)


def review_grade(score: Column | str) -> Column:
    """Mean score on ``(0,2] (2,3] (3,4] (4,5]``."""
    return right_closed(score, [0, 2, 3, 4, 5], ["Bad", "Okay", "Good", "Excellent"])


def delivery_outcome(delivered: Column | str, estimated: Column | str) -> Column:
    d, e = col(delivered), col(estimated)
    on_time, late, never = OUTCOMES
    return F.when(d.isNull(), never).when(d <= e, on_time).otherwise(late)


def value_tier(amount: Column | str) -> Column:
    a = col(amount)
    return (
        F.when(a >= 1000, "high_value")
        .when(a >= 100, "medium_value")
        .when(a > 0, "low_value")
        .otherwise("no_amount")
    )


def tail_label(n: Column | str, cap: int = 5) -> Column:
    n = col(n)
    return F.when(n >= cap, F.lit(f"{cap}+")).otherwise(n.cast("string"))


def rule_segment(frequency: Column | str, recency: Column | str) -> Column:
    f, r = col(frequency), col(recency)
    loyal, lapsing, recent, cooling, dormant = RULE_SEGMENTS
    return (
        F.when((f >= 2) & (r <= 120), loyal)
        .when(f >= 2, lapsing)
        .when(r <= 90, recent)
        .when(r <= 240, cooling)
        .otherwise(dormant)
    )


def value_segment(frequency: Column | str, recency: Column | str, monetary: Column | str) -> Column:
    """Segments that also ask for a minimum spend."""
    f, r, m = col(frequency), col(recency), col(monetary)
    return (
        F.when((r <= 90) & (f >= 3) & (m >= 500), "Champion")
        .when((r <= 180) & (f >= 2), "Loyal")
        .when(r <= 90, "Recent")
        .when(r > 365, "Churned")
        .otherwise("At Risk")
    )


def quintile_segment(r: Column | str, f: Column | str, m: Column | str) -> Column:
    r, f, m = col(r), col(f), col(m)
    return (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r >= 4) & (f <= 2), "New / promising")
        .when((r <= 2) & (m >= 4), "At-risk high-value")
        .when(r <= 2, "Lost / dormant")
        .otherwise("Need attention")
    )


def quartile_segment(r: Column | str, f: Column | str) -> Column:
    r, f = col(r), col(f)
    return (
        F.when((r == 4) & (f == 4), "Champion")
        .when((r >= 3) & (f >= 3), "Loyal Customer")
        .when(r == 4, "Recent Customer")
        .when((r == 2) & (f >= 2), "At Risk")
        .when(r <= 1, "Lost")
        .otherwise("Potential Loyalist")
    )


def mart_segment(r: Column | str, f: Column | str, m: Column | str) -> Column:
    """The five names the customer mart accepts, from quintile scores."""
    r, f, m = col(r), col(f), col(m)
    return (
        F.when((r >= 4) & (f >= 4), "champions")
        .when((r >= 3) & (f >= 3), "loyal")
        .when((r <= 2) & ((f >= 3) | (m >= 4)), "at_risk")
        .when(r <= 1, "lost")
        .otherwise("hibernating")
    )
