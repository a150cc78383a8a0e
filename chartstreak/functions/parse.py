"""Strict field parsing as Column expressions (JVM side, no UDF).

Each parser returns NULL where the reference's parser would throw, so a
row-level failure becomes "row not parsed" and never fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted text forms -------------------------------------
# Java trim: strip code points <= U+0020 at both ends.
TRIM_PATTERN = r"^[\x00-\x20]+|[\x00-\x20]+$"
# Integer.parseInt: optional sign, decimal digits.
INT_PATTERN = r"^[+-]?[0-9]+$"
# Float.parseFloat: NaN / Infinity (exact case), decimal with optional
# exponent and type suffix, or hexadecimal with binary exponent.
FLOAT_PATTERN = (r"^[+-]?(NaN|Infinity|"
                 r"(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)|"
                 r"(0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?))$")
# ISO local date: four-digit year, two-digit month and day.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# String.isBlank: empty or only whitespace code points.
BLANK_PATTERN = r"^\p{javaWhitespace}*$"
# ---------------------------------------------------------------------------


def java_trim(c: Column) -> Column:
    """trim characters <= U+0020 on both ends (Spark's trim keeps tabs)."""
    return F.regexp_replace(c, TRIM_PATTERN, "")


def is_blank(c: Column) -> Column:
    """NULL, empty or whitespace only."""
    return c.isNull() | c.rlike(BLANK_PATTERN)


def strict_int(c: Column) -> Column:
    """int or NULL; out-of-range values are NULL (try_cast)."""
    t = java_trim(c)
    return F.when(t.rlike(INT_PATTERN), t.try_cast("int"))


def strict_float(c: Column) -> Column:
    """single-precision parse widened to double, or NULL."""
    t = java_trim(c)
    return F.when(t.rlike(FLOAT_PATTERN), t.try_cast("float").cast("double"))


def java_bool(c: Column) -> Column:
    """only 'true' in any case is true; never NULL for a present field."""
    return F.lower(java_trim(c)) == F.lit("true")


def strict_date(c: Column) -> Column:
    """ISO yyyy-MM-dd or NULL (impossible days like Feb 30 are NULL)."""
    t = java_trim(c)
    return F.when(t.rlike(DATE_PATTERN), F.try_to_date(t, "yyyy-MM-dd"))
