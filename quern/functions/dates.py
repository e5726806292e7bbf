"""Dates that may be known to the year, the month or the day, and which of several to trust."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The type of a partial date.
PARTIAL = "struct<y: int, m: int, d: int>"


def partial(y: Column, m: Column | None = None, d: Column | None = None) -> Column:
    """A date as far as it is known and in the calendar; without a year there is none, and no day without a month."""
    none = F.lit(None).cast("int")
    year, month = y.cast("int"), none if m is None else F.when(m.between(1, 12), m.cast("int"))
    day = none if d is None else F.when(month.isNotNull() & d.between(1, F.day(F.last_day(F.make_date(year, month, F.lit(1))))), d.cast("int"))
    return F.when(y.isNotNull(), F.struct(year.alias("y"), month.alias("m"), day.alias("d")))


def _number(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast("int")


def parse(text: Column) -> Column:
    """2026, 2026-09, 2026-09-15 and 2026년 as partial dates; a bare year never becomes a day, and of what the calendar lacks the month or the year stays."""
    pattern = "^\\s*([0-9]{4})(?:[-/.]([0-9]{1,2}))?(?:[-/.]([0-9]{1,2}))?\\s*년?\\s*$"
    return partial(_number(text, pattern, 1), _number(text, pattern, 2), _number(text, pattern, 3))


def from_url_path(url: Column) -> Column:
    """Year, month and perhaps day of a path such as /2025/11/; year and month must each be a whole part of the path."""
    path = F.regexp_replace(url, "[?#].*$", "")
    pattern = "/(20[0-9]{2})/(0[1-9]|1[0-2])(?:/(0[1-9]|[12][0-9]|3[01]))?(?=/|$)"
    return partial(_number(path, pattern, 1), _number(path, pattern, 2), _number(path, pattern, 3))


def from_html_meta(html: Column) -> Column:
    """The publication day that a page states about itself: of the first meta element that names and holds one.

    Attributes may stand in any order and in either kind of quotes, or none.
    """
    named = "(?i)\\s(?:name|property|itemprop)\\s*=\\s*[\"']?(?:[\\w:.-]*published_time|datePublished|date)[\"'\\s/>]"
    held = "(?i)\\scontent\\s*=\\s*[\"']?\\s*([0-9]{4})-([0-9]{2})(?:-([0-9]{2}))?"
    elements = F.regexp_extract_all(html, F.lit("(?is)<meta\\b[^>]*>"), F.lit(0))
    first = F.get(F.filter(elements, lambda x: x.rlike(named) & x.rlike(held)), F.lit(0))
    return partial(_number(first, held, 1), _number(first, held, 2), _number(first, held, 3))


def precision(date: Column) -> Column:
    """0 unknown, 1 year, 2 month, 3 day."""
    return F.when(date["d"].isNotNull(), 3).when(date["m"].isNotNull(), 2).when(date["y"].isNotNull(), 1).otherwise(0)


def sort_key(date: Column) -> Column:
    """A number by which later dates come last, and of one year or month the less exact first."""
    return F.coalesce(date["y"], F.lit(0)) * 10000 + F.coalesce(date["m"], F.lit(0)) * 100 + F.coalesce(date["d"], F.lit(0))


def label(date: Column) -> Column:
    """2026년, 2026년 9월 or 2026-09-15."""
    month = F.concat(date["y"].cast("string"), F.lit("년 "), date["m"].cast("string"), F.lit("월"))
    return F.when(precision(date) == 3, F.format_string("%04d-%02d-%02d", date["y"], date["m"], date["d"])).when(precision(date) == 2, month).when(precision(date) == 1, F.concat(date["y"].cast("string"), F.lit("년")))


def month_bucket(date: Column) -> Column:
    """The month where it is known, else the year; day and month dates share their month."""
    return label(F.when(date["y"].isNotNull(), F.struct(date["y"].alias("y"), date["m"].alias("m"), F.lit(None).cast("int").alias("d"))))


def not_bulk(date: Column, days: list[tuple[int, int, int]]) -> Column:
    """A date that isn't a day on which a collection was uploaded as a whole."""
    bulk = F.lit(False)
    for y, m, d in days:
        bulk = bulk | F.coalesce((date["y"] == y) & (date["m"] == m) & (date["d"] == d), F.lit(False))
    return F.when(~bulk, date)


def confirmed_or_added(original: Column, added_on: Column) -> Column:
    """An original date confirmed to the day, else the day on which a catalogue added the document."""
    return F.coalesce(F.when(precision(original) == 3, original), added_on)


def most_exact(*dates: Column) -> Column:
    """The most exact of several dates; of equally exact ones the first."""
    best = dates[0]
    for other in dates[1:]:
        best = F.when(precision(other) > precision(best), other).otherwise(best)
    return best
