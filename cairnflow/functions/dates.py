"""Dates in articles: relative phrases, repair against a publication day, timelines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
NUMBERS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12}


def relative_day(text: Column, anchor: Column) -> Column:
    """struct(day, precision) of the first phrase, in this order, seen from ``anchor``; null without one.

    `last Monday` or `past Monday` (a week back on a Monday), `yesterday`, `3 weeks ago` in
    digits or words up to twelve, `last week`, `last month`, `last year`, `earlier this month`,
    `earlier this year`. Years name their first day; months keep the day where there is one.
    """
    # What several branches read is made once for a row: an array of one, told by functions of its element.
    once = lambda value, told: F.get(F.transform(F.array(value), told), F.lit(0))
    return once(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), lambda low: _told(low, anchor, once))


def _told(low: Column, anchor: Column, once: Callable) -> Column:
    says = lambda phrase: F.regexp_like(low, F.lit(rf"\b{phrase}\b"))
    ago = r"\b(\d+|" + "|".join(NUMBERS) + r") (day|week|month|year)s? ago\b"
    numbers = F.create_map(*[F.lit(x) for pair in NUMBERS.items() for x in pair])
    parts = F.struct(F.regexp_extract(low, r"\b(?:last|past) (" + "|".join(DAYS) + r")\b", 1).alias("weekday"), F.regexp_extract(low, ago, 1).alias("count"), F.regexp_extract(low, ago, 2).alias("unit"))
    counted = lambda p: F.struct(p["weekday"].alias("weekday"), p["unit"].alias("unit"), F.coalesce(F.try_element_at(numbers, p["count"]), p["count"].try_cast("int")).alias("n"))
    return once(parts, lambda p: once(counted(p), lambda q: _day(q["weekday"], q["n"], F.when(q["n"] > 0, q["unit"]), anchor, says)))


def _day(weekday: Column, n: Column, unit: Column, anchor: Column, says: Callable) -> Column:
    back = F.pmod(F.weekday(anchor) - (F.array_position(F.array(*[F.lit(d) for d in DAYS]), weekday) - 1), F.lit(7)).cast("int")
    new_year = lambda years: F.make_date(F.year(anchor) - years, F.lit(1), F.lit(1))
    found = lambda day, precision: F.struct(day.alias("day"), F.lit(precision).alias("precision"))
    return F.when(
        anchor.isNotNull(),
        F.when(weekday != "", found(F.date_sub(anchor, F.when(back == 0, 7).otherwise(back)), "approximate"))
        .when(says("yesterday"), found(F.date_sub(anchor, 1), "day"))
        .when((unit == "day") & (n == 1), found(F.date_sub(anchor, 1), "day"))
        .when(unit == "day", found(F.date_sub(anchor, n), "approximate"))
        .when(unit == "week", found(F.date_sub(anchor, n * 7), "approximate"))
        .when(unit == "month", found(F.add_months(anchor, -n), "month_only"))
        .when(unit == "year", found(new_year(n), "year_only"))
        .when(says("last week"), found(F.date_sub(anchor, 7), "approximate"))
        .when(says("last month"), found(F.add_months(anchor, -1), "month_only"))
        .when(says("last year"), found(new_year(1), "year_only"))
        .when(says("earlier this month"), found(F.trunc(anchor, "month"), "month_only"))
        .when(says("earlier this year"), found(new_year(0), "year_only")),
    )


def relative_date(text: Column, anchor: Column) -> Column:
    """The day alone of ``relative_day``."""
    return relative_day(text, anchor)["day"]


def safe_date(value: Column, newest: Column, first: str = "1990-01-01", ahead: int = 1) -> Column:
    """``value`` if it lies between ``first`` and a day or so after ``newest``; else null."""
    return F.when((value >= F.lit(first).cast("date")) & (value <= F.date_add(newest, ahead)), value)


def repaired(value: Column, published: Column, most_late: int = 90, most_early: int = 330) -> Column:
    """struct(value, reason): a day that can't belong to its publication is shifted by a year or dropped."""
    gap = F.datediff(value, published)
    year_back = F.add_months(value, -12)
    late, near = gap > most_late, F.abs(F.datediff(year_back, published)) <= most_early
    ok = value.isNull() | published.isNull() | (gap <= most_late)
    return F.struct(
        F.when(ok, value).when(late & near, year_back).alias("value"),
        F.when(ok, None).when(late & near, "year shifted").otherwise("after publication").alias("reason"),
    )


def guarded(events: Column, published: Column, most_late: int = 90) -> Column:
    """A timeline (array of structs with a `date`) in which days long after publication are null."""
    return F.transform(events, lambda e: e.withField("date", F.when(published.isNull() | (F.datediff(e["date"], published) <= most_late), e["date"])))


def filled(events: Column, anchors: dict[str, Column]) -> Column:
    """A timeline in which undated events of a kind take the anchor of that kind."""

    def fill(e: Column) -> Column:
        day = e["date"]
        for kind, anchor in anchors.items():
            day = F.coalesce(day, F.when(e["event_type"] == kind, anchor))
        return e.withField("date", day)

    return F.transform(events, fill)


def first_of_kind(events: Column, kind: str) -> Column:
    return F.array_min(F.transform(F.filter(events, lambda e: e["event_type"] == kind), lambda e: e["date"]))


def disclosure_level(delay: Column) -> Column:
    """immediate within 3 days, prompt within 30, delayed within 90, else late."""
    return F.when(delay.isNull(), None).when(delay <= 3, "immediate").when(delay <= 30, "prompt").when(delay <= 90, "delayed").otherwise("late")


def more_precise(a_day: Column, a_rank: Column, b_day: Column, b_rank: Column) -> Column:
    """The date of the higher precision; the first one on a tie, the other where one is missing."""
    return F.when(a_day.isNull(), b_day).when(b_day.isNull(), a_day).when(b_rank > a_rank, b_day).otherwise(a_day)


def precision_rank(c: Column) -> Column:
    return F.when(c == "day", 3).when(c == "month", 2).when(c == "year", 1).otherwise(0)
