"""Timestamp parsing and calendar keys (UTC, whole seconds)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressline.functions.rates import iso
from pressline.functions.titles import strip

# --- fixed values: accepted shapes of a published date ------------------------------------------
DATE_SHAPES = [
    ("^\\d{4}-\\d{1,2}-\\d{1,2}T\\d{1,2}:\\d{1,2}:\\d{1,2}Z$", "yyyy-M-d'T'H:m:s'Z'"),
    ("^\\d{4}-\\d{1,2}-\\d{1,2} \\d{1,2}:\\d{1,2}:\\d{1,2}$", "yyyy-M-d H:m:s"),
    ("^\\d{4}-\\d{1,2}-\\d{1,2}$", "yyyy-M-d"),
    ("^\\d{1,2} [A-Za-z]{3} \\d{4} \\d{1,2}:\\d{1,2}:\\d{1,2} (GMT|UTC)$", "d MMM yyyy H:m:s z"),
    ("^\\d{1,2} [A-Za-z]{3} \\d{4} \\d{1,2}:\\d{1,2}:\\d{1,2} [+-]\\d{4}$", "d MMM yyyy H:m:s xx"),
    ("^\\d{1,2} [A-Za-z]{3} \\d{4} \\d{1,2}:\\d{1,2}:\\d{1,2} [+-]\\d{2}:\\d{2}$",
     "d MMM yyyy H:m:s xxx"),
    ("^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}[+-]\\d{2}:\\d{2}$", "yyyy-MM-dd'T'HH:mm:ssxxx"),
    ("^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    ("^\\d{1,2} [A-Za-z]{3} \\d{4} \\d{1,2}:\\d{1,2}:\\d{1,2}$", "d MMM yyyy H:m:s"),
]
# Zone names of the mail date format, by offset.
ZONE_OFFSETS = {"-0400": "EDT", "-0500": "EST|CDT", "-0600": "CST|MDT", "-0700": "MST|PDT",
                "-0800": "PST", "+0000": "UT|Z"}


def published_at(raw: Column) -> Column:
    """Feed date text to a UTC timestamp, NULL when no accepted shape fits.

    The weekday, with or without a comma, and fractions of a second are dropped. In the mail format
    the seconds may be missing, years may have two digits (69 to 99 are of the last century), zones
    may be named, and no zone means UTC.
    """
    text = F.regexp_replace(strip(raw), "^[A-Za-z]{3,9},?\\s+(?=[0-9])", "")
    text = F.regexp_replace(text, "([0-9]{2}:[0-9]{2}:[0-9]{2})\\.[0-9]+", "$1")
    text = F.regexp_replace(text, "^([0-9]{1,2} [A-Za-z]{3}) ([0-5][0-9]|6[0-8]) ", "$1 20$2 ")
    text = F.regexp_replace(text, "^([0-9]{1,2} [A-Za-z]{3}) (69|[7-9][0-9]) ", "$1 19$2 ")
    text = F.regexp_replace(text, "^([0-9]{1,2} [A-Za-z]{3} [0-9]{4} [0-9]{1,2}:[0-9]{2})( |$)", "$1:00$2")
    for offset, zones in ZONE_OFFSETS.items():
        text = F.regexp_replace(text, f" ({zones})$", f" {offset}")

    def first_fit(c: Column) -> Column:
        return F.coalesce(*[F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(pattern)))
                            for shape, pattern in DATE_SHAPES])

    # The cleaned text is made once, not once per shape.
    return F.get(F.transform(F.array(text), first_fit), F.lit(0))


def expires_at(fetched: Column, days: int) -> Column:
    return fetched + F.make_interval(days=F.lit(days))


def archive_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def archive_file(month: Column) -> Column:
    return F.concat(F.lit("archive_"), F.replace(month, F.lit("-"), F.lit("_")), F.lit(".json"))


def minute_text(c: Column) -> Column:
    """``YYYY-MM-DD HH:mm UTC`` for ISO text, or the text itself when it is no date."""
    return F.coalesce(F.concat(F.date_format(F.try_to_timestamp(c), "yyyy-MM-dd HH:mm"),
                               F.lit(" UTC")), c)


def valid_iso(c: Column) -> Column:
    """Right shape and a real calendar moment."""
    from pressline.fixed_values import ISO_PATTERN
    return F.coalesce(c.rlike(ISO_PATTERN), F.lit(False)) & F.try_to_timestamp(
        F.when(c.rlike(ISO_PATTERN), c), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).isNotNull()


__all__ = ["DATE_SHAPES", "archive_file", "archive_month", "expires_at", "iso", "minute_text",
           "published_at", "valid_iso"]
