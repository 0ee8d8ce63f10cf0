"""Text cleaning expressions. All stay inside JVM codegen; none raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import codes


def strip_trailing_underscore(c: Column) -> Column:
    return F.regexp_replace(c, codes.TRAILING_UNDERSCORE, "")


def strip_outer_underscores(c: Column) -> Column:
    return F.regexp_replace(c, codes.OUTER_UNDERSCORES, "")


def keep_if_match(c: Column, pattern: str, default: str) -> Column:
    """`c` when it matches; `default` when it does not match or is NULL."""
    return F.when(c.rlike(pattern), c).otherwise(F.lit(default))


def default_if_no_match(c: Column, pattern: str, default: str) -> Column:
    """`default` for non-NULL values that do not match; NULL stays NULL."""
    return F.when(c.rlike(pattern) | c.isNull(), c).otherwise(F.lit(default))


def replace_value(c: Column, placeholder: str, default: str) -> Column:
    return F.when(c == F.lit(placeholder), F.lit(default)).otherwise(c)


def mask_ssn(c: Column) -> Column:
    """Only the last four digits survive; the unknown marker passes through."""
    masked = F.regexp_replace(c, codes.SSN_KEEP_LAST_FOUR, codes.SSN_MASK)
    return F.when(c == F.lit(codes.SSN_UNKNOWN), c).otherwise(masked)


def split_list(c: Column) -> Column:
    """'A, B, and C' or 'A and B' -> array; NULL stays NULL."""
    return F.split(c, codes.LOAN_LIST_SEPARATOR)


def list_count(c: Column) -> Column:
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(split_list(c)))


def reconciled_count(count_text: Column, list_text: Column) -> Column:
    """The stated count unless it disagrees with the list, then the list's own length.

    Text that is no integer is left alone, so that typing can report it.
    """
    stated = strip_outer_underscores(count_text)
    actual = list_count(list_text)
    return F.when(stated.try_cast("int") != actual, actual.cast("string")).otherwise(stated)


def duration_months(c: Column) -> Column:
    """'12 Years and 3 Months' -> 147; an absent part counts as zero, NULL stays NULL."""

    def part(unit: str) -> Column:
        digits = F.regexp_extract(c, rf"(\d+)\s+{unit}", 1)
        return F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("int"))

    return part("Years") * 12 + part("Months")
