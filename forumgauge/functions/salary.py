"""Pay mentions in free text, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS_PER_YEAR = 2080
LOWEST = 30_000
HIGHEST = 1_000_000
SMALLEST_PLAIN_NUMBER = 1000

# --- Fixed values: what marks an hourly rate, and retirement plans that look like pay ---
HOUR_MARKS = ("/hr", "/hour", "per hour", "an hour", "/h")
NOT_PAY = ("401k", "403b")
# --- End of fixed values ------------------------------------------------------------------

# A number begins and ends as a whole: not inside a word, nor inside a longer number.
_START = r"(?<![\p{L}\p{N}_])(?<!\p{N}[.,])"
_END = r"(?![\p{L}\p{N}_])(?![.,]\p{N})"
# Looked at first: nearly every position fails here, at the cost of one test.
_FIRST = r"(?i)(?=[$0-9])"
_GROUPED = r"\d{1,3}(?:,\d{3})+"
_MARK = "|".join(m + r"(?![\p{L}\p{N}_])" * (m == "/h") for m in HOUR_MARKS)

# $45/hr, 45.50 an hour, 1,000 per hour.
HOURLY = rf"{_FIRST}\$?{_START}((?:{_GROUPED}|\d+)(?:\.\d{{1,2}})?)\s*(?:{_MARK})"

# 120k, $120.5k, 120,000, $120,000.00, $120000.  Bare digits are not pay.
ANNUAL = (rf"{_FIRST}((?:\$|{_START})(?:\d+(?:\.\d+)?k|{_GROUPED}(?:\.\d{{1,2}})?){_END}"
          rf"|\$\d{{4,}}(?:\.\d{{1,2}})?{_END})")


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _number(text: Column) -> Column:
    return F.regexp_replace(text, r"[$,hkHK]", "").try_cast("double")


def salary_mentions(text: Column, not_pay: tuple[str, ...] = NOT_PAY) -> Column:
    """Raw pay mentions: hourly ones first, tagged with a trailing ``h``.

    ``not_pay`` lists numbers, as written in lower case, that never are pay.

    Hourly mentions are taken out before yearly ones are looked for, so no
    number counts twice.  A text without a digit, or without an hourly marker,
    skips the pattern that could not match.
    """
    none = F.array().cast("array<string>")
    lowered = F.lower(text)
    may_be_hourly = lowered.contains("/h") | lowered.contains("hour")
    hourly = F.when(may_be_hourly, F.transform(_matches(text, HOURLY), lambda m: F.concat(m, F.lit("h"))))
    rest = F.when(may_be_hourly, F.regexp_replace(text, HOURLY, " ")).otherwise(text)
    kept = F.filter(_matches(rest, ANNUAL), lambda m: ~F.lower(m).isin(*not_pay) & (
        m.startswith("$") | F.lower(m).endswith("k") | (_number(m) > SMALLEST_PLAIN_NUMBER)))
    annual = F.transform(kept, lambda m: F.ltrim(m, F.lit("$")))
    return F.when(text.rlike(r"\d"), F.concat(F.coalesce(hourly, none), annual)).otherwise(none)


def annual_pay(mention: Column, hours_per_year: float = HOURS_PER_YEAR) -> Column:
    """A raw mention as yearly pay; NULL when it is not a plausible number."""
    value = _number(mention)
    lowered = F.lower(mention)
    return (F.when(lowered.endswith("h"), F.when(value > 0, value * F.lit(float(hours_per_year))))
            .when(lowered.endswith("k"), value * F.lit(1000.0))
            .when(value > SMALLEST_PLAIN_NUMBER, value))


def annual_pays(mentions: Column, hours_per_year: float = HOURS_PER_YEAR) -> Column:
    """Yearly pay of every mention that has one."""
    return F.filter(F.transform(mentions, lambda m: annual_pay(m, hours_per_year)),
                    lambda v: v.isNotNull())


def bounded_pay(pay: Column, lowest: float = LOWEST, highest: float = HIGHEST) -> Column:
    """Yearly pay if it lies in the accepted range, else NULL."""
    return F.when(pay.between(F.lit(float(lowest)), F.lit(float(highest))), pay)
