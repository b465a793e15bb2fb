"""Column functions shared by the plans: statistics, intervals, sequences, codecs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_mean(x: Column, w: Column) -> Column:
    return F.sum(x * w) / F.sum(w)


def normal_cdf(x: Column) -> Column:
    """The normal law below ``x`` by a rational approximation, within 1e-7."""
    t = 1 / (1 + 0.2316419 * F.abs(x))
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(x > 0, 1 - tail).otherwise(tail)


def chi2_tail(x: Column, degrees: int) -> Column:
    """The chi-square law above ``x`` for an even number of degrees of freedom."""
    term = total = F.lit(1.0)
    for k in range(1, degrees // 2):
        term = term * x / (2 * k)
        total = total + term
    return F.exp(-x / 2) * total


def overlap(a_from: Column, a_to: Column, b_from: Column, b_to: Column) -> Column:
    """Whether the half-open intervals share a point."""
    return (a_from < b_to) & (b_from < a_to)


def saturating_linear(x: Column, low: float, high: float) -> Column:
    """0 up to ``low``, 1 from ``high``, straight between."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / (high - low)))


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, "ACGT", "TGCA"))


def letters_of(s: Column) -> Column:
    """Only the letters A, C, G and T of the text, in upper case."""
    return F.regexp_replace(F.upper(s), "[^ACGT]+", "")


def compress_runs(s: Column) -> Column:
    """One letter for each run of equal letters."""
    return F.regexp_replace(s, r"(.)\1+", "$1")


def varint_bytes(x: Column) -> Column:
    """Bytes of a non-negative number in groups of seven bits."""
    size = F.lit(1)
    for k in range(1, 9):
        size = size + (x >= (1 << (7 * k))).cast("int")
    return size


def horner(x: Column, coefficients: list[float]) -> Column:
    """A polynomial by its coefficients, the highest power first."""
    total = F.lit(0.0)
    for c in coefficients:
        total = total * x + c
    return total
