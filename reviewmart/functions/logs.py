"""Log attributes: operating system, browser, dates and seasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_DATE_FORMAT = "MM-dd-yyyy"

# The months of each season.
SEASONS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "autumn": (9, 10, 11),
}


def _is_pair(agent: Column) -> Column:
    """Exactly one space in ``agent``."""
    spaces = F.length(agent) - F.length(F.replace(agent, F.lit(" "), F.lit("")))
    return spaces == 1


def browser_of(agent: Column) -> Column:
    """First word of a two-word agent, else NULL."""
    return F.when(_is_pair(agent), F.substring_index(agent, " ", 1))


def os_of(agent: Column) -> Column:
    """Second word of a two-word agent, else its first word."""
    first = F.substring_index(agent, " ", 1)
    return F.when(_is_pair(agent), F.substring_index(agent, " ", -1)).otherwise(first)


def log_date(text: Column) -> Column:
    """Date of a month-day-year text; NULL when it does not parse."""
    return F.try_to_date(text, LOG_DATE_FORMAT)


def season_of(day: Column) -> Column:
    """Season name of a date; NULL for NULL."""
    month = F.month(day)
    branches = [F.when(month.isin(*ms), F.lit(name)) for name, ms in SEASONS.items()]
    return F.coalesce(*branches)
