"""Numeric helpers shared by the statistical operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal number text; keeps out the Java-only forms ('1d', '0x1p3') and NaN/inf.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# The helpers mention their argument as rarely as possible: filters are pushed below
# projections by repeating expressions, and nested repetition multiplies.


def to_number(text: Column) -> Column:
    """Text to double, NULL when it is not a plain finite number."""
    return finite(F.regexp_extract(text, NUMBER, 0).try_cast("double"))


def finite(x: Column) -> Column:
    """NaN and both infinities become NULL."""
    return F.when(F.abs(x) < F.lit(math.inf), x)  # NaN sorts above infinity


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where the whole is 0."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))
