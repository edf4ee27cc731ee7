"""Thresholds, exceedance flags, colours, status string, level and score as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainmark.constants import STATUS_METRICS, STATUS_PARAMS, STATUS_SCORES, THRESHOLDS

TRACKS = ["w", "e"]


def rail_side(hand: Column, track: str) -> Column:
    """Inside (lo) or outside (hi) rail; null when the hand is not known."""
    lo_hand, hi_hand = ("RH", "LH") if track == "w" else ("LH", "RH")
    return F.when(hand.isNull() | (hand == lo_hand), "lo").when(hand == hi_hand, "hi")


def limit_of(class_name: Column, param: str, hand: Column, track: str) -> Column:
    """Limit of a parameter for a class, hand and rail; null for an unknown class or hand."""
    side = rail_side(hand, track)
    expr = None
    for name, limits in THRESHOLDS.items():
        value = limits[param]
        if isinstance(value, dict):
            value = F.when(side == "lo", float(value["lo"])).when(side == "hi", float(value["hi"]))
        else:
            value = F.lit(float(value))
        expr = F.when(class_name == name, value) if expr is None else expr.when(class_name == name, value)
    return expr


def exceeds(stat: Column, limit: Column) -> Column:
    """Text flag, strictly above the limit; a missing statistic is not above, a missing limit gives null."""
    return F.when(limit.isNull(), F.lit(None).cast("string")).when(stat > limit, "exceeds").otherwise("")


def flag_columns(class_name: Column, hand: Column, digits: int | None = None) -> dict[str, Column]:
    """The 24 flags, in a fixed order, from columns named metric_track_param.

    Statistics are compared as they are. With ``digits`` they are rounded first, for those who would rather have
    a mean at its limit come out the same in every order of summation.
    """
    def value(name: str) -> Column:
        return F.col(name) if digits is None else F.round(F.col(name), digits)

    limits = {(t, p): limit_of(class_name, p, hand, t) for t in TRACKS for p in STATUS_PARAMS}
    return {
        f"status_{metric}_{track}_{param}": exceeds(value(f"{metric}_{track}_{param}"), limits[track, param])
        for metric in STATUS_METRICS for track in ["e", "w"] for param in STATUS_PARAMS
    }


def colour(track: str, param: str) -> Column:
    """T4: R when p90 and p75 exceed, A when only p90 does, else G."""
    p90, p75 = F.col(f"status_p90_{track}_{param}"), F.col(f"status_p75_{track}_{param}")
    return (
        F.when(p90.isNull() | p75.isNull(), F.lit(None).cast("string"))
        .when((p90 == "exceeds") & (p75 == "exceeds"), "R")
        .when(p90 == "exceeds", "A")
        .otherwise("G")
    )


def status_string() -> Column:
    """T5: west rail first, then east; head loss, vertical wear, side wear."""
    west, east = [[colour(t, p) for p in STATUS_PARAMS] for t in TRACKS]
    return F.concat(*west, F.lit("-"), *east)


def status_level(status: Column) -> Column:
    """Worst colour in the string."""
    return (
        F.when(status.contains("R"), "R").when(status.contains("A"), "A").when(status.isNotNull(), "G")
    )


def status_score(status: Column) -> Column:
    """Scores of the colours, added up."""
    total = F.lit(0)
    for letter, score in STATUS_SCORES.items():
        if score:
            total = total + (F.length(status) - F.length(F.replace(status, F.lit(letter), F.lit("")))) * score
    return total.cast("int")
