"""Display labels for months and amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations of the reports.
MONTH_NAMES = ("jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez")


def month_label(day: Column) -> Column:
    """nov/10"""
    names = F.array(*[F.lit(name) for name in MONTH_NAMES])
    year = F.lpad((F.year(day) % 100).cast("string"), 2, "0")
    return F.concat(F.element_at(names, F.month(day)), F.lit("/"), year)


def money_label(amount: Column) -> Column:
    """£1,2 mi / £838 mil / £45. Ties go to the even digit, as format_number rounds."""
    value = amount.cast("double")
    size = F.abs(value)

    def number(scaled: Column, places: int) -> Column:
        return F.translate(F.format_number(scaled, places), ".,", ",")

    return (
        F.when(size >= 1_000_000, F.concat(F.lit("£"), number(value / 1_000_000, 1), F.lit(" mi")))
        .when(size >= 1_000, F.concat(F.lit("£"), number(value / 1_000, 0), F.lit(" mil")))
        .otherwise(F.concat(F.lit("£"), number(value, 0)))
    )
