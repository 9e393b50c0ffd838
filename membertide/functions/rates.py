"""Churn and retention as column arithmetic inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def retention_rate(before: str, within: str) -> Column:
    """``within / before`` to two decimals, 0 when nobody was active before."""
    return F.expr(f"CASE WHEN {before} = 0 THEN 0D ELSE {_two_decimals(within, before)} END")


def churn_rate(before: str, within: str) -> Column:
    """``(before - within) / before`` to two decimals; negative when activity grew."""
    size = _two_decimals(f"abs({before} - {within})", before)
    # 0 - x rather than -x: a rate that rounds to nothing is 0.0, never -0.0.
    return F.expr(
        f"CASE WHEN {before} = 0 THEN 0D WHEN {within} > {before} THEN 0D - {size} ELSE {size} END"
    )


def _two_decimals(part: str, whole: str) -> str:
    """SQL that rounds the double ``part / whole`` by its exact binary value, ties to even.

    Spark's ``round`` and ``bround`` look at the shortest decimal form of a double, so 3/40
    (0.075, but 0.07499.. in binary) would go up. Here integers round the quotient, and only
    where they say "exactly half" does the binary error of the double decide. For that,
    200 * x is compared with the odd number 2 * cents + 1: with 200 = 128 + 64 + 8 the products
    are exact, and each difference is between doubles within a factor of two of each other,
    hence exact as well.
    """
    whole = f"nullif({whole}, 0L)"
    cents, rest = f"(100 * {part} div {whole})", f"(100 * {part} % {whole})"
    x, odd = f"({part} / {whole})", f"(2 * {cents} + 1)"
    error = f"({x} * 128D - {odd} + {x} * 64D + {x} * 8D)"
    tie_goes_up = f"{error} > 0D OR {error} = 0D AND {cents} % 2 = 1"
    return (
        f"(CASE WHEN 2 * {rest} > {whole} OR 2 * {rest} = {whole} AND ({tie_goes_up}) "
        f"THEN {cents} + 1 ELSE {cents} END / 100D)"
    )
