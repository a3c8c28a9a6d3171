"""Lenient date and time parsing. Nothing here raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Zone names of RFC 822 mail dates, as offsets.
ZONE_OFFSETS = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "AST": "-0400", "ADT": "-0300", "EST": "-0500", "EDT": "-0400",
    "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600",
    "PST": "-0800", "PDT": "-0700",
}

_RFC822 = (
    r"(?i)^\s*(?:[a-z]{3,9},?\s+)?(\d{1,2})\s+([a-z]{3})[a-z]*\s+(\d{4}|\d{2})\s+"
    r"(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([+-]\d{4}|[a-z]+)?"
)
_ISO_DAY = r"^\d{4}-\d{2}-\d{2}"
_ISO_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{2}:?\d{2}$"


def _rfc822_local(value: Column) -> Column:
    """Wall-clock reading of a mail date, null for other input."""
    part = lambda n: F.regexp_extract(value, _RFC822, n)
    # Years of two digits: up to 68 they are of this century, as mail readers take them.
    century = F.when(F.length(part(3)) == 4, "").when(part(3) <= "68", "20").otherwise("19")
    text = F.concat(
        part(1), F.lit(" "), F.initcap(part(2)), F.lit(" "), century, part(3), F.lit(" "),
        F.lpad(part(4), 2, "0"), F.lit(":"), part(5), F.lit(":"),
        F.coalesce(F.nullif(part(6), F.lit("")), F.lit("00")),
    )
    return F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss"))


def _rfc822_offset(value: Column) -> Column:
    """``+hhmm`` of a mail date; null where no zone is given."""
    zone = F.upper(F.regexp_extract(value, _RFC822, 7))
    table = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])
    return F.when(zone.rlike(r"^[+-]\d{4}$"), zone).otherwise(F.try_element_at(table, zone))


def rfc822_timestamp(value: Column) -> Column:
    """Mail date to timestamp; a date without zone is read as UTC."""
    offset = F.coalesce(_rfc822_offset(value), F.lit("+0000"))
    minutes = F.substring(offset, 2, 2).cast("int") * 60 + F.substring(offset, 4, 2).cast("int")
    minutes = F.when(offset.startswith("-"), -minutes).otherwise(minutes)
    return _rfc822_local(value) - F.make_dt_interval(mins=minutes)


def rfc822_iso(value: Column) -> Column:
    """Mail date as ISO text in its own zone; without offset if it has none."""
    offset = _rfc822_offset(value)
    text = F.date_format(_rfc822_local(value), "yyyy-MM-dd'T'HH:mm:ss")
    colon = F.concat(F.substring(offset, 1, 3), F.lit(":"), F.substring(offset, 4, 2))
    return F.concat(text, F.coalesce(colon, F.lit("")))


def publication_iso(feed_date: Column, page_date: Column) -> Column:
    """ISO text of the feed's date, else of the page's; both must be mail dates."""
    return F.coalesce(rfc822_iso(feed_date), rfc822_iso(page_date))


def lenient_timestamp(value: Column) -> Column:
    """ISO text to UTC timestamp, null where it is not one."""
    return F.when(value.rlike(_ISO_DAY), value.try_cast("timestamp"))


def lenient_date(value: Column) -> Column:
    return F.when(value.rlike(_ISO_DAY), value.try_cast("date"))


def feed_timestamp(moment: Column, day: Column) -> Column:
    """Timestamp of a feed article.

    The text of the moment wins over the day before parsing, and only text
    with an offset is read; so a moment without offset gives null.
    """
    text = F.coalesce(moment, F.concat(day, F.lit("T00:00:00+00:00")))
    return F.when(text.rlike(_ISO_WITH_OFFSET), text.try_cast("timestamp"))


def month_start(value: Column) -> Column:
    return F.date_trunc("month", value)


def partition_year(value: Column) -> Column:
    return F.date_format(F.coalesce(value, F.current_date()), "yyyy")


def partition_month(value: Column) -> Column:
    return F.date_format(F.coalesce(value, F.current_date()), "MM")
