"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def today_in(zone: str) -> Column:
    """Civil date in a time zone. Pass a literal ``as_of`` instead to repeat a run."""
    return F.to_date(F.convert_timezone(None, F.lit(zone), F.localtimestamp()))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``; negative when the order is reversed."""
    return F.datediff(later, earlier)


def readable_days(days: Column) -> Column:
    """'Today', 'Yesterday', or 'n days ago'."""
    return (
        F.when(days == 0, "Today")
        .when(days == 1, "Yesterday")
        .otherwise(F.concat(days.cast("string"), F.lit(" days ago")))
    )
