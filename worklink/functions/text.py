"""Scalar text, phone, number, date and list functions (FN-01..07, FN-15..33)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# every character Python's str.strip() removes
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
TRUE_WORDS = ["t", "true", "1", "yes"]
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
TIMESTAMP_FORMATS = ("yyyy-M-d H:m:s.SSSSSS", "yyyy-M-d H:m:s", "yyyy-M-d")
PLAIN_TIMESTAMP = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}( [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,6})?)?$"


def as_text(c: Column) -> Column:
    """FN-15: text of any value, null as the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def trimmed(c: Column) -> Column:
    """FN-16: trimmed text, null as the empty string."""
    return F.coalesce(strip(c), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_str(c: Column) -> Column:
    """FN-01: trimmed text, null when blank."""
    return blank_to_null(strip(c))


def non_blank(c: Column) -> Column:
    """FLT-04: the value holds something other than white space."""
    return clean_str(c).isNotNull()


def first_non_blank(*cols: Column) -> Column:
    """PRJ-16, PRJ-17: first operand that is not blank, trimmed."""
    return F.coalesce(*[clean_str(c) for c in cols])


def is_empty_value(c: Column) -> Column:
    """FLT-10: text that stands for no value."""
    return F.lower(trimmed(c)).isin("", "none", "n/a", "na", "null")


def digits(c: Column) -> Column:
    """FN-04: decimal digits of any script, '' when there is none."""
    return F.coalesce(F.regexp_replace(c.cast("string"), r"(?U)\D", ""), F.lit(""))


def clean_phone(c: Column) -> Column:
    """FN-02: +91 form for local numbers, '+digits' otherwise, null without digits."""
    d = digits(c)
    n = F.length(d)
    return (
        F.when(n == 0, F.lit(None).cast("string"))
        .when(n == 10, F.concat(F.lit("+91"), d))
        .when((n == 13) & d.startswith("091"), F.concat(F.lit("+91"), F.substring(d, 4, 10)))
        .otherwise(F.concat(F.lit("+"), d))
    )


def display_phone(c: Column) -> Column:
    """FN-03: FN-02 with '' for null."""
    return F.coalesce(clean_phone(c), F.lit(""))


def phone_key(c: Column) -> Column:
    """FN-05: phone used as a join key; a trailing '.0' is dropped, blank is null."""
    return blank_to_null(strip(F.regexp_replace(c.cast("string"), r"\.0$", "")))


def clean_bool(c: Column) -> Column:
    """FN-06 on text: true words are true, any other text false, null stays null."""
    return F.lower(strip(c)).isin(TRUE_WORDS)


def join_items(items: Column, sep: str = "|") -> Column:
    """FN-07 on an array of text: trimmed non-blank items joined, null if none is left."""
    kept = F.filter(F.transform(items, strip), lambda x: x != "")
    return blank_to_null(F.array_join(kept, sep))


def split_parts(c: Column, sep: str = "|") -> Column:
    """FN-28: trimmed non-blank parts of a separated text."""
    return F.filter(F.transform(F.split(c, "\\" + sep), strip), lambda x: x != "")


def number(c: Column) -> Column:
    """FN-18: number held by a text, null when there is none."""
    text = c.cast("string")
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def to_num_text(c: Column) -> Column:
    """FN-17: integral numbers without a fraction, other text as it is, null as ''."""
    value = number(c)
    whole = F.when(value == F.floor(value), value.try_cast("decimal(38,0)").cast("string"))
    return F.coalesce(whole, value.cast("string"), as_text(c))


def timestamp_of(c: Column) -> Column:
    """FN-19: timestamp in one of three text formats, anything else is null.

    A format that does not fit costs an exception per row. Texts with four digits of a year are read by the
    cast, which knows their three shapes; any other is tried with the one format that has its punctuation.
    """
    text = strip(c)
    exact, seconds, day = [F.try_to_timestamp(text, F.lit(f)) for f in TIMESTAMP_FORMATS]
    return (
        F.when(text.rlike(PLAIN_TIMESTAMP), text.try_cast("timestamp"))
        .when(text.contains("."), exact).when(text.contains(":"), seconds).otherwise(day)
    )


def fmt_date(ts: Column) -> Column:
    """FN-20: M/D/YYYY without leading zeros, '' for null."""
    return F.coalesce(F.date_format(ts, "M/d/yyyy"), F.lit(""))


def fmt_date_text(ts: Column) -> Column:
    """FN-21: 9-Dec-2025, '' for null."""
    return F.coalesce(F.date_format(ts, "d-MMM-yyyy"), F.lit(""))


def age_days(ts: Column, as_of: Column) -> Column:
    """FN-22: whole days between the date of a timestamp and as_of."""
    return F.datediff(as_of, F.to_date(ts))


def sheet_serial(ts: Column) -> Column:
    """FN-25: days since 1899-12-30 as a fraction."""
    epoch = F.lit("1899-12-30 00:00:00").cast("timestamp")
    seconds = F.unix_seconds(ts.cast("timestamp")) - F.unix_seconds(epoch)
    return seconds / F.lit(86400.0)


def fmt_salary(low: Column, high: Column) -> Column:
    """FN-23: 'min - max', the one bound given, or ''."""

    def given(c: Column) -> Column:
        return ~as_text(c).isin("", "nan")

    def whole(c: Column) -> Column:
        return number(c).try_cast("bigint").cast("string")

    text = (
        F.when(given(low) & given(high), F.concat(whole(low), F.lit(" - "), whole(high)))
        .when(given(low), whole(low))
        .when(given(high), whole(high))
    )
    return F.coalesce(text, F.lit(""))


def percent(score: Column) -> Column:
    """FN-26: share as a percentage with one decimal, rounded by its exact binary value.

    Taking the whole part off first is exact and shows what the short form of
    82.35 hides: it is 82.349999999999994, which rounds to 82.3.
    """
    value = score * 100
    return F.floor(value) + F.bround(value - F.floor(value), 1)


def percent_even(score: Column) -> Column:
    """FN-26 for whole columns of scores: halves go to the even digit, as array libraries round."""
    return F.rint(score * 100 * 10) / 10


def percent_text(score: Column) -> Column:
    """FN-26 for display: 'N/A' when the score is not available."""
    return F.coalesce(percent(score).cast("string"), F.lit("N/A"))


def contains_either(a: Column, b: Column) -> Column:
    """FN-29: one text holds the other, ignoring case and outer blanks."""
    a, b = F.lower(trimmed(a)), F.lower(trimmed(b))
    return a.contains(b) | b.contains(a)


def email_domain(c: Column) -> Column:
    """FN-31: text after the last '@'."""
    return F.substring_index(c, "@", -1)


def completion(cols: list[Column], slots: int | None = None) -> Column:
    """AGG-14: share of fields that are not empty, 4 decimals."""
    filled = sum((F.when(as_text(c) != "", 1).otherwise(0) for c in cols), F.lit(0))
    return F.round(filled / F.lit(slots or len(cols)), 4)


def labels(sep: str, *pairs: tuple[Column, str]) -> Column:
    """Labels whose condition holds, joined in order."""
    return F.concat_ws(sep, *[F.when(cond, F.lit(text)) for cond, text in pairs])
