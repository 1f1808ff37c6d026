"""Multi-select answers, stored as JSON arrays of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def choices(answer: Column) -> Column:
    """Array of the options picked; null when the text is not a JSON array."""
    return F.from_json(answer, "array<string>")


def choices_text(answer: Column) -> Column:
    """One option per line, without quotation marks."""
    return F.replace(F.array_join(choices(answer), "\n"), F.lit('"'), F.lit(""))
