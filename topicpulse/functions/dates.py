"""Date expressions and day arithmetic on 'yyyy-MM-dd' strings."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted publication formats after the weekday name is removed.
PUBLICATION_FORMATS = (
    "d MMM yyyy HH:mm:ss xx", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm xx",
    "d MMM yyyy HH:mm z",
)
ISO_START = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def shift_day(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def day_number(col: Column) -> Column:
    return F.unix_date(F.to_date(col))


def publication_time(col: Column, mode: str = "timestamp") -> Column:
    """Comparable publication value, NULL when absent.

    ``timestamp`` parses ISO and RFC-822 text; ``lexical`` compares the raw text.
    """
    text = F.trim(F.coalesce(col.cast("string"), F.lit("")))
    if mode == "lexical":
        return F.when(text != "", col.cast("string"))
    if mode != "timestamp":
        raise ValueError(f"unknown date mode: {mode}")
    rest = F.regexp_replace(text, r"^[A-Za-z]{3,9},?\s+", "")
    iso = F.when(text.rlike(ISO_START), F.try_to_timestamp(text))
    return F.coalesce(iso, *[F.try_to_timestamp(rest, F.lit(f)) for f in PUBLICATION_FORMATS])
