"""Bands, guarded ratios, clipping, weighted sums and rule lists as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def band(
    value: Column | str,
    cuts: Sequence[float],
    labels: Sequence,
    closed: str = "left",
    null_label=None,
) -> Column:
    """Label of the interval ``value`` falls in; ``labels`` has one entry more than ``cuts``.

    ``closed="left"`` puts a value equal to a cut into the upper interval, ``"right"`` into the
    lower one. A null value gets ``null_label``, or the lowest label when that is not given.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError(f"{len(cuts)} cuts need {len(cuts) + 1} labels, got {len(labels)}")
    if closed not in ("left", "right"):
        raise ValueError(f"closed must be 'left' or 'right', not {closed!r}")
    if list(cuts) != sorted(cuts):
        raise ValueError("cuts must ascend")
    value = as_column(value)
    floor_label = F.lit(labels[0] if null_label is None else null_label)
    result = F.when(value.isNull(), floor_label)
    for cut, label in reversed(list(zip(cuts, labels[1:]))):
        result = result.when(value >= cut if closed == "left" else value > cut, F.lit(label))
    return result.otherwise(F.lit(labels[0]))


def guarded_ratio(numerator: Column | str, divisor: Column | str, default: float = 0.0) -> Column:
    """``numerator / divisor`` where the divisor is positive, ``default`` elsewhere (also for null)."""
    numerator, divisor = as_column(numerator), as_column(divisor)
    return F.when(divisor > 0, numerator / divisor).otherwise(F.lit(default))


def clip(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; null stays null (``least``/``greatest`` alone would replace it)."""
    value = as_column(value)
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def round_half_up(value: Column | str, digits: int) -> Column:
    """Rounding by ``floor(x * 10^d + 0.5) / 10^d``: the same bits in every IEEE engine."""
    scale = float(10**digits)
    return F.floor(as_column(value) * scale + 0.5) / F.lit(scale)


def weighted_sum(terms: Iterable[tuple[str, float]]) -> Column:
    """Sum of ``column * weight``, added from left to right."""
    total = None
    for name, weight in terms:
        term = F.col(name) * F.lit(weight)
        total = term if total is None else total + term
    return total


# --------------------------------------------------------------------------- additive rule lists

Rules = Sequence[tuple[str, float, str]]


def rule_score(rules: Rules, base: float = 0.0, low: float = 0.0, high: float = 1.0) -> Column:
    """Base plus the weight of every rule that fires, clipped; a null input never fires a rule."""
    total = F.lit(float(base))
    for _, weight, predicate in rules:
        total = total + F.when(F.expr(predicate), F.lit(weight)).otherwise(F.lit(0.0))
    return F.least(F.greatest(total, F.lit(low)), F.lit(high))


def fired_rules(rules: Rules, limit: int | None = None, order: str = "rule") -> Column:
    """Names of the rules that fire, in rule order or by falling weight (ties in rule order)."""
    if order not in ("rule", "weight"):
        raise ValueError(f"order must be 'rule' or 'weight', not {order!r}")
    ranked = sorted(rules, key=lambda r: -r[1]) if order == "weight" else rules
    named = F.array(*[F.when(F.expr(test), F.lit(name)) for name, _, test in ranked])
    names = F.filter(named, lambda n: n.isNotNull())
    return names if limit is None else F.slice(names, 1, limit)


def failed_checks(checks: Sequence[tuple[str, Column]]) -> Column:
    """Names of the checks whose violation column is true."""
    named = F.array(*[F.when(bad, F.lit(name)) for name, bad in checks])
    return F.filter(named, lambda n: n.isNotNull())


# --------------------------------------------------------------------------- scores and bands in use


def vip_score_linear(terms) -> Column:
    """Unbounded VIP score; a null term makes the score null."""
    total = None
    for name, weight, divisor in terms:
        term = F.col(name) * F.lit(weight) / F.lit(divisor)
        total = term if total is None else total + term
    return total.cast("double")


def vip_score_capped(terms) -> Column:
    """VIP score with every term capped at its weight; a null input counts as zero."""
    total = None
    for name, level, weight in terms:
        share = F.least(F.coalesce(F.col(name), F.lit(0)) / F.lit(level), F.lit(1.0))
        total = share * F.lit(weight) if total is None else total + share * F.lit(weight)
    return round_half_up(total, 4)


def text_intent_proxy(score: Column | str, text: Column | str, slope: float, shift: float) -> Column:
    """Linear proxy of text intent from a churn score; null when there is no text."""
    raised = F.least(as_column(score) * F.lit(slope) + F.lit(shift), F.lit(1.0))
    return F.when(F.length(as_column(text)) > 0, round_half_up(raised, 4))


def contains_any(text: Column | str, keywords: Sequence[str]) -> Column:
    """True when the lower-cased text contains one of the keywords.

    One pattern, so that a long text is lower-cased and scanned once.
    """
    if not keywords:
        return F.lit(False)
    return F.lower(as_column(text)).rlike("|".join(re.escape(k) for k in keywords))


def hash_bucket(key: Column | str, buckets: int, salt: str = "") -> Column:
    """Bucket 0..buckets-1 of a key from its md5, independent of partitioning."""
    text = F.concat(F.lit(salt), as_column(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def monotone_bin(value: Column | str, per_octave: int = 2048) -> Column:
    """Order-preserving bin number with logarithmic width.

    Deterministic, so two passes over the data agree on it, and of the same relative width at every magnitude: 2048
    bins for each doubling, down to the smallest double. Zero has a bin of its own, infinities are outermost, NaN
    is above all numbers, as in Spark's order, and null stays null.
    """
    value = as_column(value).cast("double")
    size = F.abs(value)
    widest = 1 << 40
    scaled = F.when(size == float("inf"), F.lit(widest)).otherwise(F.floor((F.log2(size) + 1080.0) * per_octave))
    return (
        F.when(F.isnan(value), F.lit(widest + 1))
        .when(value == 0, F.lit(0).cast("bigint"))
        .when(value.isNotNull(), F.signum(value).cast("bigint") * scaled)
    )
