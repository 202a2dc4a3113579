"""Text normalisation and ANSI-safe casts.

Every helper maps Column -> Column, uses only Spark built-ins and gives the
same answer whether ``spark.sql.ansi.enabled`` is on or off: text is never
passed to a plain ``cast`` that could throw.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# An integer count parses from text when it looks like a plain decimal
# number (legacy cast semantics: "20.0" -> 20, "20.9" -> 20, "+7" -> 7,
# ".5" -> 0; "1e2", "abc", blank -> null).
INT_TEXT_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d*)\s*$"
# Its sign and the digits before the point.
INT_PARTS_PATTERN = r"^\s*([+-]?)(\d*)"
# Month prefix of a date-like text.
MONTH_PATTERN = r"^(\d{4}-\d{2})"
# Tokens that a pandas-based CSV reader treats as missing values.
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                  "n/a", "nan", "null")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_key(c: Column | str) -> Column:
    """Identifier normaliser: upper(trim(x))."""
    return F.upper(F.trim(_col(c)))


def lower_key(c: Column | str) -> Column:
    """Category normaliser: lower(trim(x))."""
    return F.lower(F.trim(_col(c)))


def trimmed(c: Column | str) -> Column:
    return F.trim(_col(c))


def null_missing_tokens(c: Column | str) -> Column:
    """Map the missing-value tokens of a pandas CSV read to null (S1 parity)."""
    c = _col(c)
    return F.when(c.isin(*MISSING_TOKENS), F.lit(None).cast("string")).otherwise(c)


def safe_month(c: Column | str) -> Column:
    """C6: 'yyyy-MM' prefix, '' when no match, null stays null."""
    return F.regexp_extract(_col(c), MONTH_PATTERN, 1)


def int_from_text(c: Column | str) -> Column:
    """Whole part of a plain decimal number as bigint, without ever throwing.

    Numeric input is accepted too (its text form is parsed), so a bigint
    column from a unit-test frame and a string column from CSV agree. The
    digits are parsed as they stand, so large counts are exact.
    """
    s = _col(c).cast("string")
    whole = F.concat(F.regexp_extract(s, INT_PARTS_PATTERN, 1), F.lit("0"), F.regexp_extract(s, INT_PARTS_PATTERN, 2))
    return F.when(s.rlike(INT_TEXT_PATTERN), whole.try_cast("bigint"))


def beyond_range(c: Column | str) -> Column:
    """A plain number that is larger than any bigint (negative ones are
    clamped like all negatives)."""
    s = _col(c).cast("string")
    return F.coalesce(s.rlike(INT_TEXT_PATTERN) & ~F.startswith(F.ltrim(s), F.lit("-")) & int_from_text(c).isNull(), F.lit(False))


def positive_count(c: Column | str) -> Column:
    """Count > 0, else 1 (null, bad text, 0, negatives); null beyond bigint, not a wrong count."""
    n = int_from_text(c)
    return F.when(n > 0, n).when(~beyond_range(c), F.lit(1).cast("bigint"))


def non_negative_int(c: Column | str) -> Column:
    """Value >= 0, else 0; null beyond bigint."""
    n = int_from_text(c)
    return F.when(n >= 0, n).when(~beyond_range(c), F.lit(0).cast("bigint"))


def money_decimal(c: Column | str) -> Column:
    """Money text (or number) -> decimal(38,2), null on bad text (which
    ``analytics.unparsable_amount_counts`` counts).

    Inputs with more than two decimals are rounded half-up to the cent
    (stated deviation: the reference keeps the raw double).
    """
    return _col(c).try_cast("decimal(38,2)")


def money_double(c: Column | str) -> Column:
    return money_decimal(c).cast("double")


def status_with_default(c: Column | str, default: str) -> Column:
    """Null -> default, else lower(trim(x)); blank is kept as ''."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(default)).otherwise(F.lower(F.trim(c)))
