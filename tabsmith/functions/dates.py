"""Dates held as text in several formats, and durations held as text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions.text import literal_map, strip, to_number

MONTHS = {
    name: str(i + 1)
    for i, name in enumerate(
        ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
    )
}
_FIELDS = {"%Y": "([0-9]{4})", "%m": "([0-9]{1,2})", "%d": "([0-9]{1,2})", "%b": "([A-Za-z]{3})"}


def _parse_one(text: Column, fmt: str) -> Column:
    """The date where `text` has exactly the shape of `fmt`, else NULL.

    The fields are moved into ISO order and cast once: a formatter would throw
    and catch an exception for every value that is in one of the other formats.
    """
    tokens = re.findall(r"%[A-Za-z]|\s+|.", fmt)
    order = [t for t in tokens if t in _FIELDS]
    pattern = "^" + "".join(
        _FIELDS[t] if t in _FIELDS else r"\s+" if t.isspace() else re.escape(t) for t in tokens
    ) + "$"
    if fmt == "%Y-%m-%d":
        iso = text
    elif "%b" in order:
        def field(name: str) -> Column:
            return F.regexp_extract(text, pattern, order.index(name) + 1)

        month = F.element_at(literal_map(MONTHS), F.lower(field("%b")))
        iso = F.concat(field("%Y"), F.lit("-"), month, F.lit("-"), field("%d"))
    else:
        moved = "-".join(f"${order.index(f) + 1}" for f in ("%Y", "%m", "%d"))
        iso = F.regexp_replace(text, pattern, moved)
    return F.when(text.rlike(pattern), iso.try_cast("date"))


def parse_dates(text: Column, formats: Sequence[str], bounds: tuple[str, str] | None = None) -> Column:
    """The date by the first format (%Y %m %d %b) that fits; NULL when none does, or outside `bounds`."""
    parsed = F.coalesce(*[_parse_one(text, f) for f in formats])
    if bounds is None:
        return parsed
    return F.when(parsed.between(*[F.lit(b).cast("date") for b in bounds]), parsed)


def date_parts(date: Column) -> dict[str, Column]:
    """Year, month, day of week (Monday is 0) and quarter."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day_of_week": F.weekday(date),
        "quarter": F.quarter(date),
    }


def days_since(date: Column, reference: str) -> Column:
    return F.date_diff(date, F.lit(reference).cast("date"))


def months_of_term(text: Column) -> Column:
    """`5 years` as 60, `36` as 36, anything else NULL."""
    # no digits extract as '', which does not cast
    years = F.regexp_extract(text, "([0-9]+)", 1).try_cast("double")
    # the strip runs only for text that is no number as it stands
    months = F.coalesce(to_number(text), to_number(strip(text)))
    return F.when(F.lower(text).contains("year"), years * 12).otherwise(months)
