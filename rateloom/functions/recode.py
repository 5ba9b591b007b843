"""Recoding of categorical columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from rateloom.coverages import CLAIM_COVERAGE_CODES


def transaction_type(raw: Column) -> Column:
    """A bound submission is new business; every other type keeps its name."""
    return F.when(raw == "Submission", "New Business").otherwise(raw)


def term_type(term: Column, transaction: Column) -> Column:
    """NB or RN; the transaction decides where it can, then the stored term type.

    A missing stored type counts as new business.
    """
    return (
        F.when(transaction == "New Business", "NB")
        .when(transaction == "Renewal", "RN")
        .when(term.isNull() | (term == "New Business"), "NB")
        .when(term == "Renewal", "RN")
        .otherwise(term)
    )


def channel(raw: Column) -> Column:
    """PC, Web or Agent. A missing channel stays missing and is in no channel's count."""
    return (
        F.when(raw.isNull(), None)
        .when(raw == "PriceComparison", "PC")
        .when(raw == "WebOnly", "Web")
        .otherwise("Agent")
    )


def catastrophe_coverage(coverage: Column, catastrophe: Column) -> Column:
    """Comprehensive claims with a catastrophe key other than 1 become COMP_CAT."""
    return F.when((catastrophe != 1) & (coverage == "Comprehensive"), "COMP_CAT").otherwise(coverage)


def lookup(value: Column, mapping: Mapping) -> Column:
    """``mapping[value]``, NULL where the value has no entry."""
    pairs = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.try_element_at(pairs, value)


def coverage_code(name: Column) -> Column:
    return lookup(name, CLAIM_COVERAGE_CODES)


def one_against_rest(value: Column, kept: str, rest: str = "CW") -> Column:
    """Two-way regrouping: one value kept, every other (missing ones too) pooled."""
    return F.when(value == kept, kept).otherwise(rest)


# Bands of the difference between two drivers' ages, closed on both
# sides. The edges are whole numbers, so a fraction between two bands is in none.
AGE_DIFFERENCE_BANDS = (
    ("b) -25 to -13", -25, -13),
    ("c) -12 to -8", -12, -8),
    ("d) -7 to -6", -7, -6),
    ("e) -5 to -4", -5, -4),
    ("f) -3 to -2", -3, -2),
    ("g) -1 to 0", -1, 0),
    ("h) 1 to 2", 1, 2),
    ("i) 3 to 5", 3, 5),
    ("j) 6 to 7", 6, 7),
    ("k) 8 to 12", 8, 12),
    ("l) 13 to 25", 13, 25),
)
AGE_DIFFERENCE_BELOW = ("a) Less than -25", -25)
AGE_DIFFERENCE_FROM = ("m) More than 25", 26)
AGE_DIFFERENCE_MISSING = "z) Single Driv"


def band(
    value: Column,
    bands: Sequence[tuple] = AGE_DIFFERENCE_BANDS,
    below: tuple | None = AGE_DIFFERENCE_BELOW,
    at_least: tuple | None = AGE_DIFFERENCE_FROM,
    missing: str | None = AGE_DIFFERENCE_MISSING,
) -> Column:
    """Label of the closed band ``[low, high]`` the value lies in, NULL if in none."""
    label = F.when(value.isNull(), missing)
    if below:
        label = label.when(value < below[1], below[0])
    for name, low, high in bands:
        label = label.when(value.between(low, high), name)
    if at_least:
        label = label.when(value >= at_least[1], at_least[0])
    return label
