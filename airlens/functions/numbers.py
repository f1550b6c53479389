"""Numbers: cleaning, bucketing, interpolation, rounding, correlation."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from airlens import config as C


def is_number(value: Column) -> Column:
    """Neither NULL nor NaN. Never NULL itself."""
    return value.isNotNull() & ~F.isnan(value)


def to_double(text: Column) -> Column:
    """``try_cast`` to double for text that often is no number.

    A failed cast is an exception inside Spark; text with a character no number has is sorted out
    by a cheap test first.
    """
    return F.when(text.rlike(r"^[\s\d+\-.eEdDfFxXpPaAnNiItTyY]+$"), text.try_cast("double"))


def clean_number(text: Column, sentinels: Sequence[str] = tuple(C.NUMBER_SENTINELS)) -> Column:
    """Double from a messy cell: a sentinel is NULL, other symbols are stripped, the rest is cast.

    What is left after stripping and still is no number (``"1-2"``) becomes NULL.
    """
    digits = F.regexp_replace(text, r"[^0-9+\-.]", "")
    number = F.when(digits.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), digits.try_cast("double"))
    return F.when(~F.trim(text).isin(*sentinels), number)


def first_match(cases: Sequence[tuple[Column, Column]], default: Column | None = None) -> Column:
    """``CASE WHEN`` over (condition, value) pairs; the first condition that holds decides."""
    (condition, value), *others = cases
    chain = F.when(condition, value)
    for condition, value in others:
        chain = chain.when(condition, value)
    return chain if default is None else chain.otherwise(default)


def bucketize(value: Column, cuts: Sequence[float], labels: Sequence) -> Column:
    """``labels[i]`` for the first ``cuts[i] >= value``, the last label above all cuts, NULL for NULL."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("bucketize needs one more label than cuts")
    steps = [(value <= cut, F.lit(label)) for cut, label in zip(cuts, labels)]
    return first_match([*steps, (value.isNotNull(), F.lit(labels[-1]))])


def piecewise(value: Column, segments: Sequence[tuple], contiguous: bool = False) -> Column:
    """Linear interpolation over ``(low, high, index_low, index_high)`` segments.

    Below the first segment the first index is returned, above the last one the top index.
    A value between two segments is NULL, unless ``contiguous``: then it takes the upper index
    of the segment beneath it.
    """
    bottom, top = segments[0], segments[-1]
    cases = [
        (value < bottom[0], F.lit(float(bottom[2]))),
        (value > top[1], F.lit(float(top[3]))),
    ]
    for low, high, index_low, index_high in segments:
        slope = (index_high - index_low) / (high - low)
        cases.append((value.between(low, high), slope * (value - low) + index_low))
    if contiguous:
        for (_, high, _, index_high), (low, *_) in zip(segments, segments[1:]):
            cases.append(((value > high) & (value < low), F.lit(float(index_high))))
    return first_match(cases)


def stable_round(value: Column, digits: int, half: str = "up") -> Column:
    """Round an aggregate of doubles so that summation order cannot flip the last digit.

    Floating-point sums differ in their last bits between runs (partitions arrive in any order);
    rounding at 9 digits first removes that noise. ``half="even"`` ties to the even digit.
    """
    finish = {"up": F.round, "even": F.bround}[half]
    return finish(F.round(value, 9), digits)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation; NULL (not an error) for constant or one-row groups."""
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)
