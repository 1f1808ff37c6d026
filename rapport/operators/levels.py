"""Reporting levels: the same report over several grouping keys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Level:
    name: str
    keys: tuple[str, ...]

    @property
    def narrow(self) -> Level:
        """The same groups by fewer columns: a user's id settles the other keys' rows."""
        return Level(self.name, ("user_id",)) if "user_id" in self.keys else self

    def all_known(self) -> Column:
        """Whether no key is null; a group with a null key matches nothing."""
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])


LEVELS = (
    Level("cm", ("user_id", "user_name", "rmm", "pod", "email_address", "phone_number")),
    Level("rmm", ("rmm", "pod")),
    Level("pod", ("pod",)),
    Level("program", ("program",)),
)


def per_level(build: Callable[[Level], DataFrame], levels=LEVELS) -> dict[str, DataFrame]:
    """One DataFrame per level, by name."""
    return {level.name: build(level) for level in levels}
