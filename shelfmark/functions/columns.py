"""Column functions.  All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def variant_price(variants: Column | str = "variants") -> Column:
    """Price of the first variant; NULL when there is none or it is not a number."""
    return F.get(_col(variants), F.lit(0))["price"].try_cast("decimal(10,2)")


def product_url(base: Column | str, handle: Column | str = "handle") -> Column:
    """Listing URL; ``base`` as text is taken literally.  NULL for a NULL handle."""
    return F.concat(F.lit(base), _col(handle))


def zone_local_date(iso: Column | str) -> Column:
    """Date of an ISO-8601 text in the zone the text itself carries.

    Parsing to a timestamp first would move late-evening values to the session zone.
    """
    return F.try_to_date(F.substring(_col(iso), 1, 10))


def days_on_market(published_at: Column | str, as_of: Column | str) -> Column:
    """Whole days from publication to ``as_of`` (text ``yyyy-MM-dd`` or a date Column)."""
    end = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return F.datediff(end, zone_local_date(published_at))


def no_match_is_null(extracted: Column) -> Column:
    """NULL for the '' that ``regexp_extract`` gives without a match.

    No pattern used here can match an empty group, so '' always means "no match".
    """
    return F.nullif(extracted, F.lit(""))


def extract_attribute(source: Column | str, pattern: str, group: int = 1) -> Column:
    """Regex group, NULL when nothing matches."""
    return no_match_is_null(F.regexp_extract(_col(source), pattern, group))


def weekday_name(day: Column | str) -> Column:
    """English weekday name."""
    return F.date_format(_col(day), "EEEE")


def date_label(day: Column | str, two_lines: bool = False) -> Column:
    """``2024-12-09 (Monday)``; the weekday on a second line with ``two_lines``."""
    separator = "\n" if two_lines else " "
    return F.date_format(_col(day), f"yyyy-MM-dd'{separator}'(EEEE)")


def currency_label(amount: Column | str) -> Column:
    """Axis label: ``$1.2M`` from a million, ``$35K`` from a thousand, else ``$999``.

    Rounds the binary double half to even.  ``format_string`` and ``bround`` round the
    shortest decimal text instead and turn 1,150,000 (a double just below 1.15 million)
    into 1.2M, so tenths of a million are taken from the fraction bits in whole numbers.
    """
    x = _col(amount).cast("double")

    millions = x / F.lit(1e6)
    whole = F.floor(millions)
    # 2^52 times the fraction of a double >= 1 is a whole number.
    fraction = ((millions - whole) * F.lit(float(2**52))).cast("bigint") * F.lit(10)
    tenth = F.shiftright(fraction, 52)
    rest = fraction - F.shiftleft(tenth, 52)
    half = F.lit(2**51)
    up = (rest > half) | ((rest == half) & (tenth % 2 == 1))
    tenths = whole * 10 + tenth + up.cast("int")
    label_m = F.concat(
        F.lit("$"), F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("M")
    )

    label_k = F.concat(F.lit("$"), F.rint(x / F.lit(1e3)).cast("bigint").cast("string"), F.lit("K"))
    label = F.format_string("$%.0f", F.rint(x))
    return F.when(x >= 1_000_000, label_m).when(x >= 1_000, label_k).when(x.isNotNull(), label)
