"""Date column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrato.fixed import DATE_FORMATS, NO_MONTH


def _shape(fmt: str) -> str:
    """Regular expression every text of date format ``fmt`` matches."""
    return "^" + fmt.replace("yyyy", r"\+?\d{4,}").replace("MM", r"\d{2}").replace("dd", r"\d{2}") + "$"


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date from text in mixed formats; the first format that fits wins.

    A failed parse costs an exception per row on the JVM, so each format is only
    tried on texts of its shape.
    """
    text = text.cast("string")
    tries = [F.when(text.rlike(_shape(f)), F.try_to_timestamp(text, F.lit(f))) for f in formats]
    return F.coalesce(*tries).cast("date")


def month_label(day: Column, null_label: str | None = NO_MONTH) -> Column:
    """``yyyy-MM``; a missing date becomes ``null_label`` (None keeps it NULL)."""
    label = F.date_format(day, "yyyy-MM")
    return label if null_label is None else F.coalesce(label, F.lit(null_label))


def day_part(hour: Column, evening_from: int = 18, night_from: int = 24) -> Column:
    """Part of the day: night until 6, morning until 12, afternoon until 18, evening.

    ``night_from=20`` gives the other convention, in which late evening counts
    as night.
    """
    return (
        F.when((hour < 6) | (hour >= night_from), "night")
        .when(hour < 12, "morning")
        .when(hour < evening_from, "afternoon")
        .when(hour.isNotNull(), "evening")
    )
